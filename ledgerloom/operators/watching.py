"""Data checks of a refresh, counted while tables are stored instead of by scans of their own.

Checks on single rows ride on the write of their table. Keys are counted once each, in a stored
table of values and their occurrences that serves uniqueness and both sides of relationships.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.operators.quality import CHECKS, Check, broken_rows, with_outcome
from ledgerloom.operators.staging import NAMES

Key = tuple[str, str]  # table and column

# Tables whose rows are those of a ledger under other names.
STAGED = {
    "a_m": "stg_finance__accounts",
    "c_m": "stg_finance__customers",
    "f_l": "stg_finance__fees",
    "t_l": "stg_finance__transactions",
}
# Published keys, and the ledger key whose values they hold unless a join lost or repeated some.
INHERITED = {
    ("int_finance__accounts_decoded", "account_id"): ("a_m", "a_id"),
    ("int_finance__customers_decoded", "customer_id"): ("c_m", "c_id"),
    ("int_finance__transactions_decoded", "transaction_id"): ("t_l", "t_id"),
    ("int_finance__fees_decoded", "fee_id"): ("f_l", "f_id"),
    ("int_finance__acct_cust_bridge", "account_id"): ("a_m", "a_id"),
    ("fct_account_summary", "account_id"): ("a_m", "a_id"),
    ("fct_customer_360", "customer_id"): ("c_m", "c_id"),
}


@dataclass(frozen=True)
class Print:
    """Number of rows and sums over the hashes of a key: equal for equal collections of values."""

    rows: int
    low: int
    high: int
    mixed: int


def print_of(column: str) -> list[Column]:
    """The parts of a `Print`. Two sums of 20 bits each stay in 64 bits for eight trillion rows."""
    value = F.xxhash64(F.col(column).cast("string"))
    low, high = value.bitwiseAND(0xFFFFF), F.shiftrightunsigned(value, 20).bitwiseAND(0xFFFFF)
    parts = {"rows": F.count(F.lit(1)), "low": F.sum(low), "high": F.sum(high), "mixed": F.bit_xor(value)}
    return [F.coalesce(part, F.lit(0)).alias(f"{column}_{name}") for name, part in parts.items()]


def row_checks(checks: Iterable[Check], table: str) -> list[Check]:
    return [c for c in checks if c.table == table and c.test in ("not_null", "accepted_values")]


def unique_columns(checks: Iterable[Check], table: str) -> list[str]:
    return [c.column for c in checks if c.table == table and c.test == "unique"]


class Watcher:
    """Collects what the writes of a refresh say about the declared checks.

    `watched(name, table)` gives the table to be written; once it has been, `counted` knows its row checks
    and `prints` its keys. A write whose observation stays empty (Spark may plan an empty table away)
    leaves its checks open, and they are counted from the stored table.
    """

    def __init__(self, checks: Sequence[Check] = CHECKS):
        self.checks = checks
        self._seen: dict[str, Observation] = {}

    def watched(self, name: str, table: DataFrame) -> DataFrame:
        own, keys = row_checks(self.checks, name), unique_columns(self.checks, name)
        if not (own or keys):
            return table
        counts = [broken_rows(check).alias(f"check_{n}") for n, check in enumerate(own)]
        prints = [part for column in keys for part in print_of(column)]
        self._seen[name] = Observation()
        return table.observe(self._seen[name], *counts, *prints)

    def counted(self) -> dict[Check, int]:
        """Rows that break each row check of the tables written so far."""
        found = {}
        for name, seen in self._seen.items():
            said = seen.get
            own = row_checks(self.checks, name)
            found |= {c: said[f"check_{n}"] for n, c in enumerate(own) if f"check_{n}" in said}
        return found

    def prints(self) -> dict[Key, Print]:
        found = {}
        for name, seen in self._seen.items():
            said = seen.get
            for column in unique_columns(self.checks, name):
                parts = [said.get(f"{column}_{part}") for part in ("rows", "low", "high", "mixed")]
                if None not in parts:
                    found[name, column] = Print(*parts)
        return found


def stored_key(key: Key, tables: Collection[str]) -> Key:
    """Where the values of a declared key are stored: ledger columns under their staged names."""
    table, column = key
    if STAGED.get(table) in tables:
        return STAGED[table], NAMES[table][column]
    return key


def keys_to_count(checks: Iterable[Check], prints: Mapping[Key, Print]) -> dict[Key, Key]:
    """Every declared key, with the one whose counts answer for it.

    A published key is answered for by its ledger key where both prints agree.
    """
    wanted: list[Key] = []
    for check in checks:
        if check.test == "unique":
            wanted.append((check.table, check.column))
        elif check.test == "relationships":
            wanted += [(check.table, check.column), (check.parent, check.parent_column)]
    answers = {}
    for key in dict.fromkeys(wanted):
        source = INHERITED.get(key)
        same = source is not None and key in prints and prints[key] == prints.get(source)
        answers[key] = source if same else key
    return answers


def key_counts(tables: Mapping[str, DataFrame], keys: Iterable[Key]) -> DataFrame:
    """table_name, column_name, key and occurrences of every value of the given keys, null included."""
    parts = [
        tables[table]
        .groupBy(F.col(column).cast("string").alias("key"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "key", "occurrences")
        for table, column in keys
    ]
    return reduce(DataFrame.unionByName, parts)


def report_of_keys(counts: DataFrame, answers: Mapping[Key, Key], checks: Iterable[Check]) -> DataFrame:
    """Uniqueness and relationships from the stored counts alone: one pass for all keys, one join for all links."""
    spark, checks = counts.sparkSession, list(checks)
    known = counts.where(F.col("key").isNotNull())
    lines = [
        (n, c.table, c.column, c.test, c.severity, *answers[c.table, c.column], *answers.get((c.parent, c.parent_column), (None, None)))
        for n, c in enumerate(checks)
    ]
    declared = spark.createDataFrame(
        lines,
        "number int, declared_table string, declared_column string, test string, severity string,"
        " table_name string, column_name string, parent_table string, parent_column string",
    )
    repeated = known.where("occurrences > 1").join(declared.where("test = 'unique'"), ["table_name", "column_name"])
    parents = known.select(
        F.col("table_name").alias("parent_table"), F.col("column_name").alias("parent_column"), "key"
    )
    children = known.join(declared.where("test = 'relationships'"), ["table_name", "column_name"])
    orphans = children.join(parents, ["parent_table", "parent_column", "key"], "left_anti")
    wrong = (
        repeated.select("number", F.lit(1).cast("bigint").alias("n"))
        .unionByName(orphans.select("number", F.col("occurrences").alias("n")))
        .groupBy("number")
        .agg(F.sum("n").alias("n"))
    )
    return declared.join(wrong, "number", "left").select(
        F.col("declared_table").alias("table_name"),
        F.col("declared_column").alias("column_name"),
        "test",
        "severity",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("violations"),
    )


def report_of_rows(spark, counted: Mapping[Check, int]) -> DataFrame:
    """Row checks that writes have counted; one row a check, so a list of the driver's."""
    rows = [(c.table, c.column, c.test, c.severity, n) for c, n in counted.items()]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, test string, severity string, violations bigint"
    )


def whole_report(parts: Iterable[DataFrame]) -> DataFrame:
    return with_outcome(reduce(DataFrame.unionByName, parts))
