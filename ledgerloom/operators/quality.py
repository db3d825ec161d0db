"""Data checks. Each returns what is wrong; the report counts it for all checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes


@dataclass(frozen=True)
class Check:
    """One declared test on one column."""

    table: str
    column: str
    test: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""
    severity: str = "error"


def unique(table: str, column: str) -> Check:
    return Check(table, column, "unique")


def not_null(table: str, column: str) -> Check:
    return Check(table, column, "not_null")


def accepted(table: str, column: str, values: Iterable) -> Check:
    return Check(table, column, "accepted_values", values=tuple(values))


def related(
    table: str, column: str, parent: str, parent_column: str, severity: str = "error"
) -> Check:
    return Check(
        table,
        column,
        "relationships",
        parent=parent,
        parent_column=parent_column,
        severity=severity,
    )


def _key(table: str, column: str) -> tuple[Check, Check]:
    return unique(table, column), not_null(table, column)


def _list(table: str, column: str, values: Iterable) -> tuple[Check, Check]:
    return not_null(table, column), accepted(table, column, values)


# The declared checks, by layer.
RAW_CHECKS = (
    *_key("a_m", "a_id"),
    not_null("a_m", "c_id"),
    related("a_m", "c_id", "c_m", "c_id"),
    *_list("a_m", "a_typ", codes.ACCOUNT_TYPES),
    not_null("a_m", "a_opn_dt"),
    *_list("a_m", "a_st", codes.ACCOUNT_STATUSES),
    not_null("a_m", "a_bal"),
    not_null("a_m", "br_cd"),
    related("a_m", "br_cd", "branches", "branch_code"),
    *_key("c_m", "c_id"),
    *_key("c_m", "c_extrn_ref"),
    not_null("c_m", "c_dob"),
    not_null("c_m", "c_onb_dt"),
    *_list("c_m", "c_seg", codes.SEGMENTS),
    *_list("c_m", "c_st_cd", codes.CUSTOMER_STATUSES),
    not_null("c_m", "c_rsk_sc"),
    *_list("c_m", "c_kyc_flg", (0, 1)),
    *_key("f_l", "f_id"),
    not_null("f_l", "a_id"),
    related("f_l", "a_id", "a_m", "a_id"),
    related("f_l", "t_id", "t_l", "t_id", severity="warn"),
    *_list("f_l", "f_typ", codes.FEE_TYPES),
    not_null("f_l", "f_amt"),
    not_null("f_l", "f_dt"),
    *_key("t_l", "t_id"),
    not_null("t_l", "a_id"),
    related("t_l", "a_id", "a_m", "a_id"),
    not_null("t_l", "t_dt"),
    not_null("t_l", "t_post_dt"),
    not_null("t_l", "t_amt"),
    *_list("t_l", "t_dr_cr", codes.INDICATORS),
    *_list("t_l", "t_typ", codes.TRANSACTION_TYPES),
    *_list("t_l", "t_ch", codes.CHANNELS),
    *_list("t_l", "t_st", codes.SETTLEMENT_STATUSES),
)
SEED_CHECKS = (
    *_key("divisions", "division_code"),
    accepted("divisions", "division_code", codes.DIVISIONS),
    *_key("divisions", "division_name"),
    *_key("branches", "branch_code"),
    *_key("branches", "branch_name"),
    *_list("branches", "region_code", codes.REGIONS),
    *_list("branches", "division_code", codes.DIVISIONS),
    related("branches", "division_code", "divisions", "division_code"),
)
MODEL_CHECKS = (
    *_key("int_finance__accounts_decoded", "account_id"),
    *_key("int_finance__customers_decoded", "customer_id"),
    *_key("int_finance__transactions_decoded", "transaction_id"),
    *_key("int_finance__fees_decoded", "fee_id"),
    *_key("int_finance__acct_cust_bridge", "account_id"),
    *_key("fct_account_summary", "account_id"),
    *_key("fct_customer_360", "customer_id"),
)
CHECKS = RAW_CHECKS + SEED_CHECKS + MODEL_CHECKS

# The columns that identify a row of each aggregated table.
GRAINS = {
    "fct_fees_revenue": ("fee_type_code", "fee_month", "division_code"),
    "fct_channel_agg": ("transaction_channel_code", "transaction_month", "division_code"),
    "fct_daily_transactions": ("transaction_date", "division_code"),
    "fct_branch_performance": ("branch_code", "report_month"),
    "fct_division_performance": ("division_code", "report_month"),
}


def row_rules() -> dict[tuple[str, str], Column]:
    """Promises about single rows, as the condition that breaks them."""
    return {
        ("a_m", "close_date_only_when_closed"): F.col("a_cls_dt").isNotNull()
        & ~F.col("a_st").eqNullSafe("C"),
        ("f_l", "fee_amount_positive"): F.col("f_amt") <= 0,
        ("t_l", "transaction_amount_positive"): F.col("t_amt") <= 0,
        ("t_l", "posted_on_or_after_transaction"): F.col("t_post_dt") < F.col("t_dt"),
        ("c_m", "crm_reference_format"): ~F.col("c_extrn_ref").rlike(
            "^CRM-[0-9]{6}-[0-9A-Z]{4}$"
        ),
    }


def repeated_values(table: DataFrame, *columns: str) -> DataFrame:
    """Values, or combinations, that occur on more than one row; missing values are exempt."""
    return (
        table.select(*columns)
        .dropna(how="any")
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def missing_values(table: DataFrame, column: str) -> DataFrame:
    return table.where(F.col(column).isNull())


def unlisted_values(table: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their number of rows; missing values pass."""
    return (
        table.where(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def orphan_values(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Values without a parent row, with their number of rows; missing values pass.

    The child is reduced to one row per value first, so a value on a third of
    all rows costs one row in the join.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    known = parent.select(F.col(parent_column).alias("_known"))
    return values.join(known, F.col(column) == F.col("_known"), "left_anti")


def broken_rows(check: Check) -> Column:
    """Number of rows that break a check which needs no other row."""
    column = F.col(check.column)
    if check.test == "not_null":
        return F.count_if(column.isNull())
    return F.count_if(~column.isin(*check.values))


def _labelled(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Turn one row of counts into one row per check."""
    entries = [
        F.struct(
            F.lit(check.table).alias("table_name"),
            F.lit(check.column).alias("column_name"),
            F.lit(check.test).alias("test"),
            F.lit(check.severity).alias("severity"),
            F.col(f"check_{i}").alias("violations"),
        )
        for i, check in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*entries)))


def _count_row_level(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of a table in one scan."""
    counts = [broken_rows(check).alias(f"check_{i}") for i, check in enumerate(checks)]
    return _labelled(table.agg(*counts), checks)


def _count_key(table: DataFrame, column: str, checks: Sequence[Check]) -> DataFrame:
    """Repeated and missing values of a column in one pass."""
    per_value = table.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    missing = F.col(column).isNull()
    counts = {
        "unique": F.count_if(~missing & (F.col("occurrences") > 1)),
        "not_null": F.coalesce(F.sum(F.when(missing, F.col("occurrences"))), F.lit(0)),
    }
    return _labelled(
        per_value.agg(*[counts[c.test].alias(f"check_{i}") for i, c in enumerate(checks)]), checks
    )


def _count_orphans(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    orphans = orphan_values(
        tables[check.table], check.column, tables[check.parent], check.parent_column
    )
    total = F.coalesce(F.sum("occurrences"), F.lit(0))
    return _labelled(orphans.agg(total.alias("check_0")), [check])


def report(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS) -> DataFrame:
    """One row per check with its violations and outcome.

    Violations are repeated values for `unique` and rows for the other tests. `unique` and
    `not_null` of a column share a pass, and all row-level checks of a table share one.
    """
    keys = {(c.table, c.column): [] for c in checks if c.test == "unique"}
    row_level: dict[str, list[Check]] = {}
    parts = []
    for check in checks:
        if check.test == "relationships":
            parts.append(_count_orphans(tables, check))
        elif check.test != "accepted_values" and (check.table, check.column) in keys:
            keys[check.table, check.column].append(check)
        else:
            row_level.setdefault(check.table, []).append(check)
    parts += [_count_key(tables[name], column, group) for (name, column), group in keys.items()]
    parts += [_count_row_level(tables[name], group) for name, group in row_level.items()]
    return with_outcome(reduce(DataFrame.unionByName, parts))


def with_outcome(counted: DataFrame) -> DataFrame:
    outcome = (
        F.when(F.col("violations") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail")
    )
    return counted.withColumn("outcome", outcome)


def row_rule_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule with the number of rows that break it."""
    by_table: dict[str, dict[str, Column]] = {}
    for (table, rule), broken in row_rules().items():
        by_table.setdefault(table, {})[rule] = broken
    parts = []
    for table, rules in by_table.items():
        counts = tables[table].agg(*[F.count_if(b).alias(rule) for rule, b in rules.items()])
        entries = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.col(rule).alias("violations"),
            )
            for rule in rules
        ]
        parts.append(counts.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, parts)


def grain_report(
    tables: Mapping[str, DataFrame], grains: Mapping[str, Sequence[str]] = GRAINS
) -> DataFrame:
    """One row per table: rows, and grain values shared by several rows."""
    parts = []
    for name, grain in grains.items():
        per_key = tables[name].groupBy(*grain).agg(F.count(F.lit(1)).alias("occurrences"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("occurrences"), F.lit(0)).alias("row_count"),
                F.count_if(F.col("occurrences") > 1).alias("repeated_keys"),
            ).select(
                F.lit(name).alias("table_name"),
                F.lit(", ".join(grain)).alias("grain"),
                "row_count",
                "repeated_keys",
            )
        )
    return reduce(DataFrame.unionByName, parts)
