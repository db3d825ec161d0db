"""The two reference lists a bank starts with when it brings none of its own."""

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions import codes
from ledgerloom.sources import schemas

# Branch code, name, region, division.
BRANCHES = (
    ("BR001", "Boston Retail", "NE", "RB"),
    ("BR002", "Atlanta Retail", "SE", "RB"),
    ("BR003", "Chicago Retail", "MW", "RB"),
    ("BR004", "Dallas Retail", "SW", "RB"),
    ("BR005", "Denver Retail", "W", "RB"),
    ("BR006", "Seattle Retail", "NE", "RB"),
    ("BR007", "Miami Retail", "SE", "RB"),
    ("BR008", "Phoenix Retail", "MW", "RB"),
    ("BR009", "NYC Commercial", "NE", "CB"),
    ("BR010", "SF Commercial", "SE", "CB"),
    ("BR011", "Houston Commercial", "MW", "CB"),
    ("BR012", "Charlotte Commercial", "SW", "CB"),
)


def seed_branches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BRANCHES, schemas.BRANCHES)


def seed_divisions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(codes.DIVISIONS.items()), schemas.DIVISIONS)
