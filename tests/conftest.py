import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from gamestats.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[*]")
         .appName("gamestats-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def games_csv(spark):
    from gamestats.operators.measured import measure_games
    from gamestats.sources.files import read_games_csv

    return measure_games(read_games_csv(spark, os.path.join(FIXTURES, "games.csv")))


@pytest.fixture(scope="session")
def star_small(spark):
    from gamestats.sources.star import games_from_star

    return games_from_star(spark, SF_SMALL)
