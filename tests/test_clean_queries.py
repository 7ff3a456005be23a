import html

import duckdb
import pytest
from pyspark.sql import functions as F

from tillage.functions import text
from tillage.plans import catalog, registry

#: Entities that a cut left without a semicolon, at an end, before a tag, a letter and another entity.
PAGES = ["<title>x &&&amp</title> y", "cut &amp", "&ampx; &am &a; &lt;p&gt; &ltp>", "a&copy2 &copy;2 &eacute &#39;&#39 &quot&quot;", "<b>&amp;lt;</b>&amp;amp &amp&amp;", "plain", ""]


@pytest.mark.parametrize("name", ["clean_markup_text", "clean_web_text"])
def test_entities_without_a_semicolon_stay_as_in_the_sql(spark, tmp_path, name):
    spark.createDataFrame(list(enumerate(PAGES)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(catalog.ORACLES[name]).fetchall())
    assert sorted(map(tuple, registry.QUERIES[name](spark, str(tmp_path)).collect())) == want


def test_the_function_still_decodes_them(spark):
    rows = spark.createDataFrame(list(enumerate(PAGES)), "i int, v string").select("i", text.unescape(F.col("v")).alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == [html.unescape(v) for v in PAGES]
