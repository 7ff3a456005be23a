import os

from tillage.__main__ import main
from tillage.plans.search import Vocabulary, audit_relevance_rules

ROOT = os.path.dirname(os.path.abspath(__file__))


def test_bank_then_dry_run(spark, tmp_path, capsys):
    crops = os.path.join(ROOT, "data/crops.yaml")
    assert main(["bank", "--config", crops, "--bank", str(tmp_path)]) == 0
    assert sum(1 for p in tmp_path.glob("versions/*/combined/part*") for _ in p.open()) == 3732
    assert main(["dry-run", "--config", crops, "--bank", str(tmp_path)]) == 0
    out = capsys.readouterr().out
    assert "selected   : 96" in out and "DRY_RUN_READY" in out and "01. [CQ-" in out


def test_weather_only_hits_are_rejected(spark, config):
    assert audit_relevance_rules(spark, Vocabulary.of(config)).count() == 0
    v = Vocabulary({"cai_xanh": ["ngập úng"]}, {"prolonged_rain": ["mưa kéo dài", "ngập úng"]}, {}, [])
    kinds = {r.type for r in audit_relevance_rules(spark, v).collect()}
    assert kinds == {"A3_SCENARIO_TERM_MATCHED_AS_CROP", "A3_WEATHER_ONLY_RESULT_NOT_REJECTED", "A3_CROP_KEYWORD_OVERLAPS_SCENARIO_KEYWORD"}


def test_a_live_run_without_a_provider_ends_with_its_summary(spark, tmp_path, capsys, monkeypatch):
    import json

    from tillage import __main__ as cli
    from tillage.sources.providers import SearchProviderUnavailable
    from tillage.sources.publish import published

    rows = spark.createDataFrame([(f"CQ-{i}", "A2", f"A2Q-{i}", f"q {i}", "vi", "public_query", "natural_question", "crop_specific", "cai_xanh", "heavy_rain", "NONE", "NONE", "synthetic") for i in range(3)], cli.BANK)
    rows.coalesce(1).write.json(f"{tmp_path}/bank/combined")

    def none(*args, **more):
        raise SearchProviderUnavailable("no provider")

    monkeypatch.setattr(cli, "discover", none)
    assert main(["live", "--config", os.path.join(ROOT, "data/crops.yaml"), "--bank", f"{tmp_path}/bank", "--output", f"{tmp_path}/out"]) == 2
    assert "Search error: no provider" in capsys.readouterr().out
    summary = json.loads("\n".join(r.value for r in spark.read.text(published(spark, f"{tmp_path}/out", "summary")).collect()))
    assert summary["status"] == "SEARCH_PROVIDER_UNAVAILABLE" and summary["errors"] == ["no provider"] and summary["selected_queries"] == 3
