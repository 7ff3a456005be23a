import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


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
def config():
    from tillage.sources.config import load_config

    return load_config(os.path.join(ROOT, "tests/data/crops.yaml"))


@pytest.fixture(scope="session")
def bank(spark, config):
    from tillage.plans.bank import combined, questions, systematic, taxonomy

    t = taxonomy(spark, config)
    a1, a2 = systematic(t).cache(), questions(t).cache()
    return t, a1, a2, combined(a1, a2).cache()
