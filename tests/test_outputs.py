import json
import os

import pytest
from pyspark.sql import functions as F

from tillage.operators.audits import audit_questions, audit_systematic
from tillage.plans import fixed, outputs, report
from tillage.plans.search import issue_list
from tillage.sources import files
from tillage.sources.publish import Publication, manifest, published


def test_a_failed_run_leaves_the_old_outputs_whole(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    for n in (3, 5):
        with Publication(spark, folder) as out:
            files.write_jsonl(spark.range(n), out.path("rows"), single=True)
            files.write_summary(spark, {"n": n}, out.path("summary"))
    read = lambda name: spark.read.json(published(spark, folder, name)) if name == "rows" else json.loads("\n".join(r.value for r in spark.read.text(published(spark, folder, name)).collect()))
    assert read("rows").count() == 5 and read("summary") == {"n": 5}
    before = sorted(os.listdir(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)divide"):
        with Publication(spark, folder) as out:
            files.write_jsonl(spark.range(9), out.path("rows"))
            files.write_jsonl(spark.range(1).select((F.lit(1) / F.col("id")).alias("x")), out.path("broken"))
    with pytest.raises(FileNotFoundError):
        with Publication(spark, folder) as out:
            out.path("never written")
    assert read("rows").count() == 5 and sorted(os.listdir(tmp_path / "out")) == before and len(os.listdir(tmp_path / "out/versions")) == 2
    assert set(manifest(spark, folder)["outputs"]) == {"rows", "summary"} and all(n > 0 for n in manifest(spark, folder)["outputs"]["rows"].values())
    for n in (6, 7):
        with Publication(spark, folder) as out:
            files.write_jsonl(spark.range(n), out.path("rows"))
    assert read("rows").count() == 7 and len(os.listdir(tmp_path / "out/versions")) == 2
    assert published(spark, str(tmp_path), "plain") == f"{tmp_path}/plain"


def test_malformed_lines_are_named(spark, tmp_path):
    """In files of many splits and in folders of several files: the line's number is that of its file."""
    good = [json.dumps({"id": i, "t": "é" * (i % 50)}, ensure_ascii=False) for i in range(5000)]
    lines = [*good[:1000], "", "   ", *good[1000:4321], '{"id": 7,', *good[4321:], "{bad"]
    folder = tmp_path / "rows"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join(good) + "\n", encoding="utf-8")
    (folder / "b.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    want = lines.index('{"id": 7,') + 1
    for size in ("4k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            with pytest.raises(ValueError, match=rf"b\.jsonl:{want}: \{{\"id\": 7,"):
                files.read_jsonl(spark, str(folder), "id int, t string")
            assert files.read_jsonl(spark, str(folder / "a.jsonl"), "id int, t string").agg(F.sum("id")).first()[0] == sum(range(5000))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert files.read_jsonl(spark, str(folder), "id int, t string", check=False).where("id is null").count() == 2
    with pytest.raises(Exception, match="(?i)path"):
        files.read_jsonl(spark, str(tmp_path / "none"), "id int")


def test_csv_has_a_mark(spark, tmp_path):
    files.write_csv(spark.createDataFrame([("a", 'x "y", z')], "id string, text string"), f"{tmp_path}/c", single=True)
    data = next(tmp_path.glob("c/part*")).read_bytes()
    assert data == '﻿id,text\r\na,"x ""y"", z"\r\n'.encode()


def test_criteria_find_their_rows(bank):
    _, a1, a2, _ = bank
    for rows, stage in ((a1, "A1"), (a2, "A2")):
        wanted, got = outputs.criteria(stage), outputs.representatives(rows, stage).collect()
        assert len(got) == len(wanted) == {"A1": 20, "A2": 24}[stage] and len({r.query_id for r in got}) == len(got)
        every, taken, at = sorted(rows.collect(), key=lambda r: (r.ord, r.query_id)), [], 0
        for c in wanted:
            first = next((r for r in every if r.query_id not in taken and all(r[k] == v for k, v in c.items())), None)
            taken += [first.query_id] if first else []
            at += first is not None
        rest = [r.query_id for r in every if r.query_id not in taken]
        assert [r.query_id for r in got] == [*taken, *rest][: len(got)] and at >= 15


def test_summary_of_a_bank(spark, config, tmp_path):
    summary, one, two = outputs.write_bank(spark, config, str(tmp_path), "2024-01-01T00:00:00Z")
    assert (summary["a1_query_count"], summary["a2_query_count"], summary["combined_unique_query_count"], summary["status"]) == (3486, 246, 3732, "READY_FOR_A3")
    a1, a2 = summary["a1"], summary["a2"]
    assert a1["status"] == "READY_FOR_DISCOVERY" and all(sum(v.values()) == 3486 for k, v in a1.items() if k.startswith("by_"))
    assert a2["queries_with_region"] + a2["queries_without_region"] == 246 and list(a2["by_query_origin"].items()) == [("observed", 0), ("transformed", 0), ("synthetic", 246)]
    assert summary["round_1_search_regions"]["en"] == ["GLOBAL", "VIETNAM"] and summary["audit"] == {"issue_count": 0, "issues": []}
    written = json.loads("\n".join(r.value for r in spark.read.text(published(spark, str(tmp_path), "summary")).collect()))
    assert written == json.loads(json.dumps(summary)) and set(manifest(spark, str(tmp_path))["outputs"]) == {"a1", "a1_csv", "a2", "a2_csv", "combined", "summary"}
    text = report.bank(summary, one, two)
    assert "A1 by language" in text and "Representative A2 queries:\n01. [A2Q-" in text and "  none" in text and fixed.REVIEW_CHANGES[0] in text


def test_issues_show_what_is_wrong(bank, config):
    _, a1, a2, _ = bank
    one = a1.drop("ord").where("language = 'vi' and scope_type = 'crop_specific'").limit(1)
    row = one.withColumns({"language": F.lit("fr"), "crop_id": F.lit("none"), "query_id": F.lit("Q")})
    got = {x["type"]: x for x in issue_list(audit_systematic(row, config), "A1")}
    assert got["INVALID_LANGUAGE"] == {"stage": "A1", "type": "INVALID_LANGUAGE", "query_id": "Q", "language": "fr"}
    assert got["INVALID_CROP_ID"]["crop_id"] == "none"
    missing = [x for x in issue_list(audit_systematic(row, config), "A1") if x["type"] == "MISSING_WEATHER_SCENARIO"]
    assert len(missing) == 5 and all(x["missing"] == sorted(s[0] for s in fixed.SCENARIOS) for x in missing)
    empty = [x for x in issue_list(audit_systematic(row.withColumn("query_id", F.lit("")), config), "A1") if x["type"] == "EMPTY_QUERY_ID"]
    assert empty[0]["row"]["language"] == "fr" and set(empty[0]["row"]) == set(row.columns) and "query_id" not in empty[0]
    twice = a2.drop("ord").limit(1)
    again = twice.union(twice.withColumns({"query_id": F.lit("zz"), "query_text": F.concat("query_text", F.lit(" ?"))}))
    repeat = [x for x in issue_list(audit_questions(again, config), "A2") if x["type"] == "A2_DUPLICATE_NORMALIZED_QUERY"]
    assert len(repeat) == 1 and repeat[0]["query_id"] == "zz" and repeat[0]["query_text"].endswith(" ?")
