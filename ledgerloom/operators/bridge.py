"""Accounts widened with their customer, branch and division."""

from pyspark.sql import DataFrame

from ledgerloom.functions import codes
from ledgerloom.functions import expressions as X

ACCOUNT_DIMENSIONS = (
    "account_id",
    "customer_id",
    "branch_code",
    "division_code",
    "division_name",
)


def account_customer_bridge(
    accounts: DataFrame,
    customers: DataFrame,
    branches: DataFrame,
    divisions: DataFrame,
) -> DataFrame:
    """One row per account whose customer, branch and division all exist.

    No broadcast is forced: Spark broadcasts the reference lists when their
    measured size allows it and shuffles them when it does not.
    """
    holders = customers.withColumnsRenamed(
        {
            "is_active": "customer_is_active",
            "is_dormant": "customer_is_dormant",
            "is_closed": "customer_is_closed",
        }
    )
    locations = branches.join(divisions, "division_code").withColumn(
        "region_name", X.label("region_code", codes.REGIONS)
    )
    return (
        accounts.withColumnRenamed("is_closed", "account_is_closed")
        .join(holders, "customer_id")
        .join(locations, "branch_code")
    )


def attach_account(facts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Give each transaction or fee the owner and place of its account.

    Facts of accounts outside the bridge are dropped. The join carries five
    narrow columns; a busy account is split by Spark's skew handling, which is
    free to act because nothing downstream relies on this partitioning.
    """
    return facts.join(bridge.select(*ACCOUNT_DIMENSIONS), "account_id")


def branch_places(bridge: DataFrame) -> DataFrame:
    """Branches that hold at least one account."""
    return bridge.select(
        "branch_code",
        "branch_name",
        "region_code",
        "region_name",
        "division_code",
        "division_name",
    ).distinct()


