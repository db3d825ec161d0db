"""Bank ledgers derived from order-processing tables, for checks and benchmarks.

Each order is an account, each line item a transaction, and some line items a
fee as well. Only integer, decimal and date arithmetic is used, so any SQL
engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.sources.tables import RawTables

AS_OF = "2001-06-30"
MONEY = "decimal(18,2)"

# Columns read, so that opening a table needs no look into its files.
_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
}


def _pick(index: Column, values) -> Column:
    """The value at a zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def _cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def _branch_code(nation_key: Column) -> Column:
    return F.concat(F.lit("BR"), F.lpad((nation_key + 1).cast("string"), 3, "0"))


def _division_code(nation_key: Column) -> Column:
    return F.when(nation_key % 3 == 2, "CB").otherwise("RB")


def _divisions(nation: DataFrame) -> DataFrame:
    code = _division_code(F.col("n_nationkey"))
    name = F.when(code == "CB", codes.DIVISIONS["CB"]).otherwise(codes.DIVISIONS["RB"])
    return nation.select(code.alias("division_code"), name.alias("division_name")).distinct()


def _branches(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nation.select(
        _branch_code(key).alias("branch_code"),
        F.col("n_name").alias("branch_name"),
        _pick(F.col("n_regionkey"), codes.REGIONS).alias("region_code"),
        _division_code(key).alias("division_code"),
    )


def _customers(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    reference = F.concat_ws(
        "-",
        F.lit("CRM"),
        F.lpad(key.cast("string"), 6, "0"),
        F.lpad((key * 7919 % 10000).cast("string"), 4, "0"),
    )
    segment = F.col("c_mktsegment")
    return customer.select(
        key.alias("c_id"),
        reference.alias("c_extrn_ref"),
        _days_after("1940-01-01", key * 37 % 22000).alias("c_dob"),
        _days_after("1995-01-01", key * 13 % 2500).alias("c_onb_dt"),
        F.when(segment == "MACHINERY", "COM")
        .when(segment == "AUTOMOBILE", "PRM")
        .otherwise("RTL")
        .alias("c_seg"),
        F.when(key % 20 == 0, "CL").when(key % 20 == 1, "DM").otherwise("AC").alias("c_st_cd"),
        (key * 31 % 55 + 1).cast("int").alias("c_rsk_sc"),
        F.when(key % 67 == 0, 0).otherwise(1).alias("c_kyc_flg"),
    )


def _accounts(orders: DataFrame, customer: DataFrame) -> DataFrame:
    order = F.col("o_orderkey")
    opened = F.col("o_orderdate").cast("date")
    holder_nation = F.col("c_nationkey")
    account_type = F.when(
        _division_code(holder_nation) == "CB", _pick(order % 2, codes.COMMERCIAL_PRODUCTS)
    ).otherwise(_pick(order % 4, codes.RETAIL_PRODUCTS))
    size = (
        (_cents(F.col("o_totalprice")) % 6000000).cast(MONEY) * F.lit("0.01").cast("decimal(3,2)")
    ).cast(MONEY)
    status = F.col("o_orderstatus")
    return (
        orders.where(F.col("o_custkey") % 50 != 7)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            order.alias("a_id"),
            F.col("o_custkey").alias("c_id"),
            account_type.alias("a_typ"),
            opened.alias("a_opn_dt"),
            F.when(status == "F", F.date_add(opened, 365)).alias("a_cls_dt"),
            F.when(status == "O", "O").when(status == "F", "C").when(status == "P", "F").alias("a_st"),
            F.when(account_type.isin("CC", "LN", "COM_LN"), (-size).cast(MONEY))
            .otherwise(size)
            .alias("a_bal"),
            _branch_code(holder_nation).alias("br_cd"),
        )
    )


def _transaction_id() -> Column:
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return F.concat_ws(
        "-",
        *[F.col(part).cast("string") for part in parts],
        _cents(F.col("l_extendedprice")).cast("string"),
    )


def _transactions(lineitem: DataFrame) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    flag = F.col("l_returnflag")
    return lineitem.select(
        _transaction_id().alias("t_id"),
        F.col("l_orderkey").alias("a_id"),
        day.alias("t_dt"),
        F.date_add(day, (F.col("l_quantity").cast("bigint") % 4).cast("int")).alias("t_post_dt"),
        F.col("l_extendedprice").cast(MONEY).alias("t_amt"),
        F.when(F.col("l_linestatus") == "O", "D")
        .when(F.col("l_linestatus") == "F", "C")
        .alias("t_dr_cr"),
        _pick(F.col("l_linenumber") - 1, codes.TRANSACTION_TYPES).alias("t_typ"),
        _pick(F.col("l_partkey") % 6, codes.CHANNELS).alias("t_ch"),
        F.when(flag == "A", "S").when(flag == "N", "P").when(flag == "R", "R").alias("t_st"),
    )


def _fees(lineitem: DataFrame) -> DataFrame:
    linked = _transaction_id()
    line = F.col("l_linenumber")
    amount = F.col("l_quantity").cast("bigint").cast(MONEY) + F.lit("5.07").cast(MONEY)
    return lineitem.where(F.col("l_partkey") % 8 < 3).select(
        F.concat(F.lit("F"), linked).alias("f_id"),
        F.col("l_orderkey").alias("a_id"),
        F.when(line == 7, F.lit(None))
        .when(line.isin(5, 6), F.concat(F.lit("X"), linked))
        .otherwise(linked)
        .alias("t_id"),
        _pick(F.col("l_suppkey") % 8, codes.FEE_TYPES).alias("f_typ"),
        amount.cast(MONEY).alias("f_amt"),
        F.col("l_shipdate").cast("date").alias("f_dt"),
    )


def bank_tables(spark: SparkSession, folder: str) -> RawTables:
    """The six inputs over `<folder>/{nation,customer,orders,lineitem}.parquet`."""

    def scan(name: str) -> DataFrame:
        return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    nation, customer, lineitem = scan("nation"), scan("customer"), scan("lineitem")
    return RawTables(
        accounts=_accounts(scan("orders"), customer),
        customers=_customers(customer),
        fees=_fees(lineitem),
        transactions=_transactions(lineitem),
        branches=_branches(nation),
        divisions=_divisions(nation),
    )
