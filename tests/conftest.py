import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("terrace-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return session


HOSPITAL = (
    "date string, province string, region string, "
    "total_in int, total_in_icu int, new_in int, new_out int"
)


@pytest.fixture(scope="session")
def hospital_rows(spark):
    def build(rows):
        return spark.createDataFrame(rows, HOSPITAL)

    return build


@pytest.fixture(scope="session")
def tidy(hospital_rows):
    return hospital_rows(
        [
            ("2024-01-22", "Capital", "Brussels", 58, 11, 4, 6),
            ("2024-01-22", "Limburg", "Flanders", 64, 7, 9, 4),
            ("2024-01-22", "Coast", "Flanders", 33, 2, 8, 1),
            ("2024-01-22", "Namur", "Wallonia", 41, 6, 5, 7),
        ]
    )


@pytest.fixture(scope="session")
def untidy(hospital_rows):
    """One negative value, one copy of a row, one row without a date."""
    return hospital_rows(
        [
            ("2024-01-22", "Capital", "Brussels", -4, 11, 4, 6),
            ("2024-01-22", "Hainaut", "Wallonia", 90, 12, 7, 3),
            ("2024-01-22", "Hainaut", "Wallonia", 90, 12, 7, 3),
            (None, "Limburg", "Flanders", 64, 7, 9, 4),
        ]
    )
