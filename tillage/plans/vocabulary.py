"""The search vocabularies of a discovery run.

FIXED VALUES: a hit's score and status follow from these words, so they are stated as they must be.
A run can be given others (tillage.plans.search.Vocabulary).
"""

from __future__ import annotations

#: Terms of each crop and crop group.
CROP_TERMS = {
    "cai_xanh": ("cải xanh", "cải bẹ xanh", "cải canh", "brassica juncea", "mustard green", "mustard greens", "leaf mustard", "indian mustard"),
    "ngo": ("ngò", "ngò rí", "rau mùi", "coriandrum sativum", "coriander", "cilantro"),
    "cai_cuc": ("cải cúc", "tần ô", "glebionis coronaria", "chrysanthemum coronarium", "edible chrysanthemum", "crown daisy", "garland chrysanthemum"),
    "rau_muong": ("rau muống", "ipomoea aquatica", "water spinach", "kang kong", "kangkong"),
    "xa_lach": ("xà lách", "rau xà lách", "lactuca sativa", "lettuce"),
    "leafy_vegetable": ("rau ăn lá", "leafy vegetable", "leafy vegetables", "leaf vegetable", "leaf vegetables"),
    "herb_vegetable": ("rau gia vị", "culinary herb", "culinary herbs", "herb vegetable", "herb vegetables"),
    "short_cycle_vegetable": ("rau ngắn ngày", "rau màu ngắn ngày", "short duration vegetable", "short duration vegetables", "short cycle vegetable", "short cycle vegetables"),
    "general_vegetable": ("rau", "cây rau", "rau màu", "vegetable crop", "vegetable crops", "vegetables"),
}

#: Terms of each weather scenario.
SCENARIO_TERMS = {
    "heavy_rain": ("mưa lớn", "mưa to", "mưa nhiều", "mưa bão", "ngập", "úng", "ngập úng", "heavy rain", "heavy rainfall", "rainfall", "precipitation", "flooding", "flood", "waterlogging", "excess water", "excess rainfall", "inundation", "rainstorm"),
    "prolonged_rain": ("mưa kéo dài", "mưa liên tục", "ẩm kéo dài", "ngập úng", "độ ẩm cao", "prolonged rain", "prolonged rainfall", "continuous rain", "rainfall", "flooding", "waterlogging", "excess moisture", "excessive moisture", "wet spell"),
    "post_rain": ("sau mưa", "sau khi mưa", "ẩm ướt", "thoát nước", "bệnh sau mưa", "after rain", "post-rain", "post rain", "rainfall", "wetness", "waterlogging", "disease", "moisture", "wet soil"),
    "waterlogging": ("ngập úng", "ngập nước", "úng nước", "đọng nước", "thoát nước", "waterlogging", "waterlogged", "flooding", "flood", "excess water", "inundation", "soil saturation", "saturated soil", "anaerobic"),
    "wet_soil": ("đất ướt", "đất ẩm", "ẩm đất", "độ ẩm đất", "ngập úng", "wet soil", "soil moisture", "moisture", "saturated soil", "soil water content", "waterlogging"),
    "dry_spell": ("khô hạn", "hạn", "thiếu nước", "đất khô", "mùa khô", "dry spell", "drought", "water deficit", "water stress", "soil moisture deficit", "dry season", "limited irrigation"),
    "hot_weather": ("nắng nóng", "nắng gắt", "nhiệt độ cao", "sốc nhiệt", "stress nhiệt", "heat", "high temperature", "heat stress", "thermal stress", "temperature stress", "hot weather"),
    "strong_sun": ("nắng gắt", "ánh nắng mạnh", "bức xạ mặt trời", "che nắng", "cháy lá", "solar radiation", "sunlight", "light intensity", "shade", "shading", "photoinhibition", "sun scorch", "irradiance"),
    "hot_dry_wind": ("gió khô nóng", "gió nóng", "khô nóng", "mất nước", "bốc thoát hơi", "hot dry wind", "dry wind", "desiccation", "evapotranspiration", "vapor pressure deficit", "wind stress", "hot wind"),
    "high_humidity": ("độ ẩm cao", "ẩm độ cao", "ẩm ướt", "bệnh", "nấm bệnh", "thối", "humidity", "relative humidity", "moisture", "leaf wetness", "disease", "fungal", "mildew", "rot"),
    "leaf_wetness": ("ướt lá", "lá ướt", "ẩm lá", "bệnh lá", "nấm bệnh", "leaf wetness", "wet leaves", "leaf moisture", "humidity", "foliar disease", "fungal disease", "pathogen"),
    "strong_wind": ("gió mạnh", "gió lớn", "đổ ngã", "dập lá", "mưa bão", "wind", "strong wind", "wind damage", "lodging", "mechanical damage", "storm", "typhoon"),
    "rainy_season": ("mùa mưa", "vụ mưa", "mưa mùa", "mưa nhiều", "ẩm ướt", "rainy season", "wet season", "monsoon", "seasonal rainfall", "rainfed", "rainfall"),
    "cold_weather": ("trời lạnh", "rét", "nhiệt độ thấp", "lạnh", "sương giá", "cold", "low temperature", "chilling", "cold stress", "cool temperature", "frost"),
    "weather_change": ("thời tiết thay đổi", "biến động thời tiết", "thời tiết thất thường", "biến đổi khí hậu", "thời tiết cực đoan", "weather variability", "climate variability", "temperature fluctuation", "rainfall variability", "climate change", "extreme weather"),
}

#: Terms of each action.
ACTION_TERMS = {
    "NONE": (),
    "irrigation": ("tưới", "tưới nước", "quản lý nước", "irrigation", "watering", "water management"),
    "drainage": ("thoát nước", "tiêu nước", "rút nước", "drainage", "drain", "water removal"),
    "post_rain_care": ("sau mưa", "chăm sóc sau mưa", "xử lý sau mưa", "after rain", "post-rain", "post rain", "field management"),
    "field_inspection": ("kiểm tra", "theo dõi", "quan sát", "field inspection", "monitoring", "assessment"),
    "disease_monitoring": ("bệnh", "nấm bệnh", "theo dõi bệnh", "disease", "pathogen", "fungal", "monitoring"),
    "crop_protection": ("bảo vệ cây", "bảo vệ thực vật", "phòng trừ", "sâu bệnh", "crop protection", "plant protection", "disease management", "pest management"),
    "spray_window": ("phun thuốc", "phun xịt", "thời điểm phun", "spray", "spraying", "pesticide application", "application timing"),
    "fertilization": ("bón phân", "phân bón", "dinh dưỡng", "fertilization", "fertilizer", "nutrient management"),
    "planting": ("gieo", "trồng", "gieo trồng", "planting", "sowing", "transplanting"),
    "shade": ("che nắng", "che phủ", "lưới che", "shade", "shading", "net house"),
    "soil_moisture_management": ("giữ ẩm", "ẩm đất", "quản lý ẩm", "soil moisture", "mulch", "mulching", "water management"),
    "mulching": ("phủ luống", "che phủ đất", "mulch", "mulching"),
    "cultivation": ("canh tác", "kỹ thuật trồng", "chăm sóc", "cultivation", "crop management", "agronomy"),
    "disease_management": ("phòng bệnh", "trị bệnh", "quản lý bệnh", "disease management", "pathogen", "fungal disease", "control"),
}

#: Effects on a crop, the same for all queries.
EFFECT_TERMS = (
    "héo", "vàng lá", "cháy lá", "thối", "bệnh", "nấm bệnh", "sâu bệnh", "úng", "ngập", "ngập úng", "thiếu nước", "mất nước", "ẩm ướt", "dập lá", "crop response", "crop effect", "crop effects", "plant response", "plant stress", "water stress", "heat stress",
    "waterlogging", "flooding", "agronomic effect", "agronomic effects", "disease", "stress", "wilting", "chlorosis", "rot",
)

#: What the most general fallback query of a scenario adds.
GENERAL_TERMS = {
    "heavy_rain": "mưa ngập úng bệnh",
    "prolonged_rain": "mùa mưa chăm sóc",
    "post_rain": "sau mưa chăm sóc",
    "waterlogging": "ngập úng thoát nước",
    "wet_soil": "đất ẩm thoát nước",
    "dry_spell": "khô hạn tưới nước",
    "hot_weather": "nắng nóng chăm sóc",
    "strong_sun": "nắng gắt che nắng",
    "hot_dry_wind": "gió khô nóng giữ ẩm",
    "high_humidity": "độ ẩm cao bệnh",
    "leaf_wetness": "ướt lá nấm bệnh",
    "strong_wind": "gió mạnh chăm sóc",
    "rainy_season": "mùa mưa chăm sóc",
    "cold_weather": "trời lạnh chăm sóc",
    "weather_change": "thời tiết thay đổi chăm sóc",
}

#: Terms of records that are about a crop but not about its care.
NOISE_TERMS = ("genetic diversity", "aflp", "marker", "molecular marker", "microsatellite", "population structure", "phylogenetic", "genome", "genetic", "row spacing", "nitrogen dose", "nitrogen rate", "storage", "postharvest storage", "antioxidant")
