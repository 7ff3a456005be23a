import random

from pyspark.sql import functions as F

from tillage.operators.order import positions, running


def test_running_totals_and_positions(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.random(), rng.choice([None, 1, 2, 3]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x double, v int, part int").repartition(7)
    got = {r.part: r for r in running(df, F.col("x"), F.col("v"), F.col("g"), "total").collect()}
    places = {r.part: r.position for r in positions(df, F.struct("x", "part")).collect()}
    assert len(got) == len(places) == 3000
    total, seen = {}, 0
    for g, x, v, i in sorted(rows, key=lambda r: r[1]):
        assert got[i].total == total.get(g, 0) and got[i].x == x and places[i] == seen
        total[g], seen = total.get(g, 0) + (v or 0), seen + 1


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(2, 9, 1), (1, 8, 1)], "at int, before int, row int")
    assert sorted(tuple(r) for r in running(df, F.col("at"), F.lit(5)).collect()) == [(1, 1, 0), (2, 1, 5)]
    assert positions(df.limit(0), F.col("at")).count() == 0
