"""The taxonomy of the query bank.

FIXED VALUES: ids, terms and templates below decide the bank's rows and their hashed ids, so they
are stated as they must be. Crops and crop groups are no part of it: they come from a YAML file.
"""

from __future__ import annotations

#: (language, id, text, priority)
REGIONS = (
    ("vi", "NONE", "", 1),
    ("vi", "VIETNAM", "Việt Nam", 1),
    ("vi", "BINH_DINH_LEGACY", "Bình Định", 1),
    ("vi", "GIA_LAI_CURRENT", "Gia Lai", 1),
    ("en", "GLOBAL", "", 2),
    ("en", "VIETNAM", "Vietnam", 2),
)
#: Regions of crop-group queries, and the priority of those queries.
GROUP_REGIONS = {"vi": ("NONE", "VIETNAM"), "en": ("GLOBAL",)}
GROUP_PRIORITY = {"vi": 2, "en": 3}
CHANNELS = {"vi": "web", "en": "scholarly"}
EFFECT_PHRASE = {"vi": "ảnh hưởng chăm sóc", "en": "agronomic effects management"}
#: Reported for later rounds, never generated.
REGIONAL_FALLBACKS = ("SOUTH_CENTRAL_COAST", "MEKONG_DELTA", "SOUTHEAST_VIETNAM", "CENTRAL_HIGHLANDS", "NORTH_CENTRAL_VIETNAM", "RED_RIVER_DELTA", "SOUTHEAST_ASIA", "TROPICAL", "GLOBAL")
TARGET_CROPS = ("cai_xanh", "ngo", "cai_cuc", "rau_muong", "xa_lach")
NO_ACTION = "NONE"

#: (id, Vietnamese, English)
ACTIONS = (
    ("cultivation", "chăm sóc", "crop management"),
    ("irrigation", "tưới nước", "irrigation"),
    ("drainage", "thoát nước", "drainage"),
    ("fertilization", "bón phân", "fertilization"),
    ("disease_management", "sâu bệnh", "disease management"),
    ("disease_monitoring", "theo dõi bệnh", "disease monitoring"),
    ("shade", "che nắng", "shade management"),
    ("crop_protection", "bảo vệ cây", "crop protection"),
    ("mulching", "phủ đất giữ ẩm", "mulching"),
    ("soil_moisture_management", "quản lý độ ẩm đất", "soil moisture management"),
    ("field_inspection", "kiểm tra cây", "field inspection"),
    ("post_rain_care", "chăm sóc sau mưa", "post rain care"),
    ("spray_window", "thời điểm phun", "spray timing"),
    ("planting", "gieo trồng", "planting"),
)

#: (id, factor, Vietnamese, English, effects, actions)
SCENARIOS = (
    ("heavy_rain", "rainfall", "mưa lớn", "heavy rainfall", ("excess_water", "nutrient_loss", "physical_damage", "disease_risk"), ("irrigation", "drainage", "fertilization", "disease_management", "crop_protection", "spray_window")),
    ("prolonged_rain", "rainfall", "mưa kéo dài", "prolonged rainfall", ("waterlogging", "root_stress", "nutrient_loss", "disease_risk"), ("irrigation", "drainage", "fertilization", "disease_management", "disease_monitoring", "post_rain_care")),
    ("rainy_season", "rainfall", "mùa mưa", "rainy season", ("excess_water", "disease_risk"), ("cultivation", "drainage", "fertilization", "disease_management", "crop_protection")),
    ("post_rain", "rainfall", "sau mưa", "after heavy rain", ("wet_soil", "nutrient_loss", "root_stress", "disease_risk"), ("irrigation", "drainage", "fertilization", "field_inspection", "disease_monitoring", "post_rain_care")),
    ("hot_weather", "temperature", "nắng nóng", "heat stress", ("heat_stress", "water_loss", "wilting", "leaf_damage"), ("irrigation", "shade", "mulching", "fertilization", "crop_protection", "field_inspection")),
    ("strong_sun", "solar_radiation", "nắng gắt", "intense sunlight", ("leaf_heat", "water_loss", "leaf_damage"), ("irrigation", "shade", "mulching", "crop_protection")),
    ("dry_spell", "rainfall", "nhiều ngày không mưa", "dry spell", ("soil_dryness", "water_stress", "wilting"), ("irrigation", "mulching", "soil_moisture_management", "field_inspection")),
    ("high_humidity", "relative_humidity", "độ ẩm cao", "high humidity", ("leaf_wetness", "disease_risk"), ("disease_management", "disease_monitoring", "field_inspection", "spray_window")),
    ("leaf_wetness", "leaf_wetness", "lá ướt lâu", "prolonged leaf wetness", ("leaf_wetness", "disease_risk"), ("disease_management", "disease_monitoring", "field_inspection")),
    ("cold_weather", "temperature", "trời lạnh", "cold weather", ("cold_stress", "slow_growth"), ("irrigation", "crop_protection", "planting", "field_inspection")),
    ("strong_wind", "wind", "gió mạnh", "strong wind", ("physical_damage", "water_loss"), ("irrigation", "crop_protection", "field_inspection", "spray_window")),
    ("hot_dry_wind", "wind", "gió nóng khô", "hot dry wind", ("water_loss", "plant_stress", "flower_damage"), ("irrigation", "crop_protection", "field_inspection")),
    ("waterlogging", "soil_water", "ngập úng", "waterlogging", ("root_stress", "root_rot_risk", "oxygen_stress"), ("irrigation", "drainage", "fertilization", "disease_management", "field_inspection")),
    ("wet_soil", "soil_water", "đất quá ướt", "excess soil moisture", ("excess_water", "root_stress", "disease_risk"), ("irrigation", "drainage", "fertilization", "disease_monitoring")),
    ("weather_change", "weather_transition", "thời tiết thay đổi đột ngột", "sudden weather change", ("plant_stress", "disease_risk"), ("irrigation", "crop_protection", "disease_monitoring", "field_inspection")),
)

#: (scenario, action) pairs that questions may have beside those of SCENARIOS.
QUESTION_PAIRS = (
    ("prolonged_rain", "planting"),
    ("prolonged_rain", "field_inspection"),
    ("rainy_season", "planting"),
    ("hot_weather", "planting"),
    ("weather_change", "planting"),
    ("heavy_rain", "post_rain_care"),
    ("post_rain", "spray_window"),
)
ORIGINS = ("observed", "transformed", "synthetic")
INTENTS = ("irrigation_water", "rain_effect", "heat_sunlight", "humidity_disease", "fertilizer_weather", "spraying_weather", "planting_weather", "weather_recovery")

#: (intent, template, scenario, action, scope, crop or group keys, regions)
QUESTIONS = (
    ("irrigation_water", "hôm nay có cần tưới {crop} không", "dry_spell", "irrigation", "crop_group", ("general_vegetable", "leafy_vegetable"), ("NONE", "VIETNAM")),
    ("irrigation_water", "mưa rồi có cần tưới {crop} nữa không", "post_rain", "irrigation", "crop_specific", TARGET_CROPS, ("NONE", "VIETNAM")),
    ("irrigation_water", "đất còn ướt có tưới {crop} được không", "wet_soil", "irrigation", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "rau_muong"), ("NONE", "BINH_DINH_LEGACY")),
    ("irrigation_water", "nắng quá nên tưới {crop} lúc nào", "hot_weather", "irrigation", "crop_specific", TARGET_CROPS, ("NONE", "GIA_LAI_CURRENT")),
    ("irrigation_water", "{crop} bị úng sau mưa phải làm sao", "waterlogging", "drainage", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "rau_muong"), ("NONE", "VIETNAM")),
    ("irrigation_water", "mưa liên tục mấy ngày {crop} có bị úng không", "prolonged_rain", "drainage", "crop_group", ("general_vegetable", "leafy_vegetable"), ("NONE", "BINH_DINH_LEGACY")),
    ("rain_effect", "mưa nhiều {crop} bị vàng lá phải làm sao", "prolonged_rain", "field_inspection", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach"), ("NONE", "VIETNAM")),
    ("rain_effect", "mưa lớn {crop} có bị chết không", "heavy_rain", "crop_protection", "crop_specific", TARGET_CROPS, ("NONE",)),
    ("rain_effect", "{crop} mới trồng gặp mưa lớn thì làm sao", "heavy_rain", "crop_protection", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "ngo"), ("NONE", "BINH_DINH_LEGACY")),
    ("rain_effect", "sau mưa nên chăm {crop} thế nào", "post_rain", "post_rain_care", "crop_group", ("general_vegetable", "short_cycle_vegetable"), ("NONE", "GIA_LAI_CURRENT")),
    ("rain_effect", "mưa kéo dài ảnh hưởng {crop} thế nào", "prolonged_rain", "NONE", "crop_group", ("leafy_vegetable", "herb_vegetable"), ("NONE", "VIETNAM")),
    ("heat_sunlight", "trời nắng nóng {crop} bị héo phải làm sao", "hot_weather", "irrigation", "crop_specific", TARGET_CROPS, ("NONE", "VIETNAM")),
    ("heat_sunlight", "nắng gắt có nên tưới {crop} giữa trưa không", "strong_sun", "irrigation", "crop_group", ("leafy_vegetable", "general_vegetable"), ("NONE", "BINH_DINH_LEGACY")),
    ("heat_sunlight", "{crop} bị cháy lá do nắng xử lý sao", "strong_sun", "crop_protection", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach"), ("NONE", "GIA_LAI_CURRENT")),
    ("heat_sunlight", "nắng nóng có cần che lưới cho {crop} không", "hot_weather", "shade", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "ngo"), ("NONE", "VIETNAM")),
    ("heat_sunlight", "nắng kéo dài ảnh hưởng {crop} thế nào", "hot_weather", "NONE", "crop_group", ("leafy_vegetable", "short_cycle_vegetable"), ("NONE", "GIA_LAI_CURRENT")),
    ("humidity_disease", "trời ẩm {crop} dễ bị bệnh gì", "high_humidity", "disease_monitoring", "crop_specific", TARGET_CROPS, ("NONE", "VIETNAM")),
    ("humidity_disease", "mưa nhiều {crop} bị nấm phải làm sao", "prolonged_rain", "disease_management", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "ngo"), ("NONE", "BINH_DINH_LEGACY")),
    ("humidity_disease", "độ ẩm cao có làm {crop} bị thối không", "high_humidity", "disease_monitoring", "crop_group", ("leafy_vegetable", "general_vegetable"), ("NONE", "GIA_LAI_CURRENT")),
    ("humidity_disease", "sau mưa {crop} dễ bị sâu bệnh gì", "post_rain", "disease_monitoring", "crop_specific", TARGET_CROPS, ("NONE", "VIETNAM")),
    ("humidity_disease", "{crop} bị ướt lá lâu có dễ bị bệnh không", "leaf_wetness", "disease_monitoring", "crop_group", ("leafy_vegetable", "herb_vegetable"), ("NONE",)),
    ("fertilizer_weather", "mưa xong có bón phân cho {crop} được không", "post_rain", "fertilization", "crop_specific", TARGET_CROPS, ("NONE", "VIETNAM")),
    ("fertilizer_weather", "bón phân cho {crop} trước khi mưa có bị trôi không", "heavy_rain", "fertilization", "crop_group", ("general_vegetable", "short_cycle_vegetable"), ("NONE", "BINH_DINH_LEGACY")),
    ("fertilizer_weather", "sau mưa bao lâu thì bón phân cho {crop}", "post_rain", "fertilization", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "rau_muong"), ("NONE", "GIA_LAI_CURRENT")),
    ("fertilizer_weather", "trời nắng nóng có nên bón phân cho {crop} không", "hot_weather", "fertilization", "crop_group", ("leafy_vegetable", "herb_vegetable"), ("NONE", "VIETNAM")),
    ("spraying_weather", "sắp mưa có nên phun thuốc cho {crop} không", "heavy_rain", "spray_window", "crop_group", ("general_vegetable", "leafy_vegetable"), ("NONE", "VIETNAM")),
    ("spraying_weather", "phun thuốc xong gặp mưa có cần phun lại cho {crop} không", "post_rain", "spray_window", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach"), ("NONE", "BINH_DINH_LEGACY")),
    ("spraying_weather", "sau mưa bao lâu thì phun thuốc cho {crop}", "post_rain", "spray_window", "crop_group", ("general_vegetable", "short_cycle_vegetable"), ("NONE", "GIA_LAI_CURRENT")),
    ("spraying_weather", "trời gió có phun thuốc cho {crop} được không", "strong_wind", "spray_window", "crop_group", ("general_vegetable", "leafy_vegetable"), ("NONE", "VIETNAM")),
    ("spraying_weather", "trời ẩm có nên phun thuốc phòng bệnh cho {crop} không", "high_humidity", "spray_window", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "ngo"), ("NONE",)),
    ("planting_weather", "tháng này trồng {crop} có phù hợp không", "weather_change", "planting", "crop_specific", TARGET_CROPS, ("NONE", "VIETNAM")),
    ("planting_weather", "mưa nhiều có nên xuống giống {crop} không", "prolonged_rain", "planting", "crop_group", ("general_vegetable", "short_cycle_vegetable"), ("NONE", "BINH_DINH_LEGACY")),
    ("planting_weather", "trời nóng quá có nên trồng {crop} không", "hot_weather", "planting", "crop_specific", ("xa_lach", "cai_xanh", "cai_cuc", "ngo"), ("NONE", "GIA_LAI_CURRENT")),
    ("planting_weather", "mùa mưa nên trồng {crop} thế nào", "rainy_season", "planting", "crop_group", ("leafy_vegetable", "herb_vegetable"), ("NONE", "VIETNAM")),
    ("planting_weather", "trời lạnh gieo {crop} có được không", "cold_weather", "planting", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "ngo"), ("NONE",)),
    ("weather_recovery", "{crop} bị ngập nước phải xử lý sao", "waterlogging", "drainage", "crop_specific", ("cai_xanh", "cai_cuc", "xa_lach", "rau_muong"), ("NONE", "VIETNAM")),
    ("weather_recovery", "{crop} bị héo sau nắng nóng phải làm gì", "hot_weather", "irrigation", "crop_specific", TARGET_CROPS, ("NONE", "GIA_LAI_CURRENT")),
    ("weather_recovery", "sau mưa lớn cần làm gì cho {crop}", "heavy_rain", "post_rain_care", "crop_group", ("general_vegetable", "short_cycle_vegetable"), ("NONE", "BINH_DINH_LEGACY")),
    ("weather_recovery", "{crop} bị đổ do gió có cứu được không", "strong_wind", "crop_protection", "crop_group", ("general_vegetable", "leafy_vegetable"), ("NONE", "VIETNAM")),
    ("weather_recovery", "thời tiết thay đổi đột ngột chăm {crop} thế nào", "weather_change", "field_inspection", "crop_specific", TARGET_CROPS, ("NONE",)),
)

#: What a summary calls this form of the bank.
VERSION = "discovery_query_bank_v2_round1_a2"
STRATEGY = "a1_systematic_coverage_plus_a2_natural_public_questions"
#: Changes of wording that a summary reports.
REVIEW_CHANGES = (
    "Changed A2 region text from direct 'ở <region>' suffix to search-keyword suffix.",
    "Changed awkward leaf-wetness group wording to '<crop> bị ướt lá lâu...'.",
    "Changed heat impact wording from 'có nặng không' to 'thế nào'.",
    "Changed hot-weather planting wording to 'có nên trồng'.",
    "Changed cold-weather planting wording to 'có được không'.",
    "Changed weather-change recovery wording to 'chăm <crop> thế nào'.",
    "Changed heavy-rain mortality wording to 'có bị chết không'.",
)

#: What each representative systematic query must have: (language, scope, crop or group, scenario, kind, action, region)
SYSTEMATIC_CRITERIA = (
    ("vi", "crop_specific", "cai_xanh", "heavy_rain", "action", "irrigation", "NONE"),
    ("vi", "crop_specific", "cai_xanh", "heavy_rain", "action", "irrigation", "VIETNAM"),
    ("vi", "crop_specific", "xa_lach", "hot_weather", "action", "shade", "BINH_DINH_LEGACY"),
    ("vi", "crop_specific", "ngo", "high_humidity", "action", "disease_management", "GIA_LAI_CURRENT"),
    ("vi", "crop_specific", "cai_cuc", "prolonged_rain", "action", "drainage", "VIETNAM"),
    ("vi", "crop_specific", "rau_muong", "wet_soil", "effect", NO_ACTION, "NONE"),
    ("vi", "crop_specific", "xa_lach", "strong_sun", "effect", NO_ACTION, "BINH_DINH_LEGACY"),
    ("vi", "crop_specific", "cai_xanh", "waterlogging", "action", "drainage", "GIA_LAI_CURRENT"),
    ("en", "crop_specific", "xa_lach", "hot_weather", "action", "irrigation", "GLOBAL"),
    ("en", "crop_specific", "ngo", "high_humidity", "action", "disease_management", "VIETNAM"),
    ("en", "crop_specific", "cai_cuc", "prolonged_rain", "effect", NO_ACTION, "GLOBAL"),
    ("en", "crop_specific", "rau_muong", "waterlogging", "action", "drainage", "VIETNAM"),
    ("vi", "crop_group", "leafy_vegetable", "rainy_season", "action", "cultivation", "VIETNAM"),
    ("vi", "crop_group", "herb_vegetable", "hot_weather", "action", "shade", "NONE"),
    ("en", "crop_group", "short_cycle_vegetable", "heavy_rain", "effect", NO_ACTION, "GLOBAL"),
    ("en", "crop_group", "general_vegetable", "dry_spell", "action", "irrigation", "GLOBAL"),
    ("vi", "crop_specific", "xa_lach", "dry_spell", "action", "soil_moisture_management", "GIA_LAI_CURRENT"),
    ("vi", "crop_specific", "ngo", "cold_weather", "action", "planting", "VIETNAM"),
    ("en", "crop_specific", "cai_xanh", "strong_wind", "action", "crop_protection", "GLOBAL"),
    ("vi", "crop_group", "general_vegetable", "post_rain", "action", "post_rain_care", "VIETNAM"),
)
#: What each representative question must have: (intent, scope, crop or group, region)
QUESTION_CRITERIA = (
    ("irrigation_water", "crop_group", "general_vegetable", "NONE"),
    ("irrigation_water", "crop_specific", "cai_xanh", "VIETNAM"),
    ("irrigation_water", "crop_specific", "xa_lach", "BINH_DINH_LEGACY"),
    ("rain_effect", "crop_specific", "cai_cuc", "NONE"),
    ("rain_effect", "crop_group", "short_cycle_vegetable", "GIA_LAI_CURRENT"),
    ("rain_effect", "crop_specific", "cai_xanh", "VIETNAM"),
    ("heat_sunlight", "crop_specific", "xa_lach", "VIETNAM"),
    ("heat_sunlight", "crop_group", "leafy_vegetable", "BINH_DINH_LEGACY"),
    ("heat_sunlight", "crop_specific", "cai_cuc", "GIA_LAI_CURRENT"),
    ("humidity_disease", "crop_specific", "ngo", "VIETNAM"),
    ("humidity_disease", "crop_group", "general_vegetable", "GIA_LAI_CURRENT"),
    ("fertilizer_weather", "crop_specific", "rau_muong", "NONE"),
    ("fertilizer_weather", "crop_group", "short_cycle_vegetable", "BINH_DINH_LEGACY"),
    ("fertilizer_weather", "crop_group", "leafy_vegetable", "VIETNAM"),
    ("spraying_weather", "crop_group", "general_vegetable", "VIETNAM"),
    ("spraying_weather", "crop_specific", "cai_xanh", "BINH_DINH_LEGACY"),
    ("spraying_weather", "crop_group", "leafy_vegetable", "NONE"),
    ("planting_weather", "crop_specific", "xa_lach", "GIA_LAI_CURRENT"),
    ("planting_weather", "crop_group", "leafy_vegetable", "VIETNAM"),
    ("planting_weather", "crop_specific", "ngo", "NONE"),
    ("weather_recovery", "crop_specific", "cai_xanh", "VIETNAM"),
    ("weather_recovery", "crop_specific", "ngo", "GIA_LAI_CURRENT"),
    ("weather_recovery", "crop_group", "general_vegetable", "BINH_DINH_LEGACY"),
    ("weather_recovery", "crop_group", "leafy_vegetable", "VIETNAM"),
)
