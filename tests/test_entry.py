import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_names_match():
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 40


def test_works_without_the_optional_subpackage(tmp_path):
    for p in ROOT.rglob("*.py"):
        rel = p.relative_to(ROOT)
        if "llm" not in rel.parts and rel.name != "corpus_pipeline.py" and rel.parts[0] != "tests":
            (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / rel).write_text(p.read_text())
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout.split()[0]) >= 40


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "tillage").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"^\s*(from|import) tillage\.llm", p.read_text(), re.M), p


def test_entry_and_a_few_queries_against_duckdb(spark):
    import duckdb

    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels", "nation", "region", "customer", "orders", "lineitem", "part", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    for name in ("url_canonical", "relevance_score", "merge_candidates", "coverage_summary", "audit_domain_values", "text_signature", "audit_systematic", "audit_questions", "audit_candidates", "quota_select_greedy", "bank_combined_union", "query_statistics", "bank_summary", "bank_representatives", "query_sort_places", "near_duplicate_groups", "vocabulary_matches"):
        got = e.queries()[name](spark, d).toPandas()
        want = con.execute(e.oracle_sql()[name]).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        rows = lambda f: sorted(map(repr, f[columns].astype(object).itertuples(index=False, name=None)))  # noqa: B023, E731
        assert rows(got) == rows(want), name
