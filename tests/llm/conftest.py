import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids and texts, empty, blank and long texts, repeated rows, and columns whose names clash with those that operators use."""
    long = " ".join(f"word{i % 997} und" for i in range(90_000))
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (4, " \n\t\n"), (None, "a b c"), (None, None), (5, long), (6, "ß é ñ \U0001f600 <|endoftext|> ▁ \r\n x")]
    names = "_p string, _key int, _row int, row int, key int, rest int, given_id int, copies int, chunk int, found string, new string"
    return spark.createDataFrame([(i, t, 0.5, "x", "y", 1, 2, "p", *range(8), "f", "n") for i, t in rows], "doc_id long, text string, score double, root string, line string, part int, id int, " + names)
