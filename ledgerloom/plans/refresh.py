"""Full refresh: store every table and check it."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.expressions import AsOf
from ledgerloom.operators import quality, watching
from ledgerloom.plans.models import LAYERS, PUBLISHED, FinanceModels, ledgers
from ledgerloom.sources.tables import RawTables, TableSink, VersionedSink, publish_view

# Working tables in a folder for each month, and the month column of the ledger they come from.
MONTHLY = {"int_finance__transactions_daily": "transaction_month", "int_finance__fees_placed": "fee_month"}
# Names of the stored check report, and of the counted keys it is made from.
REPORT = "data_checks"
KEYS = "data_check_keys"


class ChecksFailed(Exception):
    """Data checks of severity `error` found violations."""


@dataclass(frozen=True)
class Refreshed:
    """Scans of the published tables, by name, and of the stored check report."""

    tables: dict[str, DataFrame]
    checks: DataFrame

    def require_passed(self) -> None:
        """Raise with the names of failed checks; warnings pass."""
        # one row per declared check at most
        failed = self.checks.where("outcome = 'fail'").collect()
        if failed:
            names = sorted(f"{r.table_name}.{r.column_name} {r.test}" for r in failed)
            raise ChecksFailed(", ".join(names))


def refresh(
    raw: RawTables,
    sink: TableSink | VersionedSink,
    as_of: AsOf = None,
    views: Collection[str] = (),
    only_passed: bool = False,
) -> Refreshed:
    """Compute and store all tables, each reading the stored ones before it.

    Storing each layer means a lost executor never recomputes more than one
    table, and the join of the ledgers with their accounts runs once for the
    facts that need it. Tables of a layer are stored side by side, so that the
    last tasks of one leave no executor idle. Names in `views` become session views instead: with
    very large ledgers, leaving the staging layer unstored saves a full copy.

    Checks on single rows are counted while their table is stored. Each key is counted
    once, into the stored table `data_check_keys`; the report is stored as `data_checks`.
    With `only_passed`, failed checks raise before anything of a `VersionedSink` is
    published. Without `as_of`, the day on which the refresh starts holds for all tables. No
    setting of the session is changed; see `session.tune`.
    """
    spark = raw.transactions.sparkSession
    if as_of is None:
        as_of = spark.range(1).select(F.current_date()).first()[0]
    watcher, target = watching.Watcher(), sink.begin(spark)

    def keep(name: str, table: DataFrame) -> DataFrame:
        if name in views:
            return publish_view(name, table)
        if name in MONTHLY:
            # months of any size, each in few files
            return target.publish(name, table.hint("rebalance", F.col(MONTHLY[name])), by=(MONTHLY[name],))
        return target.publish(name, watcher.watched(name, table))

    def ledger(name: str, table: DataFrame) -> DataFrame:
        # a ledger is read once, when its staged table is stored
        return table if watching.STAGED[name] in views else watcher.watched(name, table)

    arriving = replace(
        raw,
        accounts=ledger("a_m", raw.accounts),
        customers=ledger("c_m", raw.customers),
        fees=ledger("f_l", raw.fees),
        transactions=ledger("t_l", raw.transactions),
    )
    models = FinanceModels(arriving, as_of, keep, stored=True)
    tables = {}
    for layer in LAYERS:
        with ThreadPoolExecutor(len(layer)) as pool:
            stored = pool.map(lambda attribute: getattr(models, attribute), layer)
            tables |= zip([PUBLISHED[attribute] for attribute in layer], stored)
    known = {**tables, **ledgers(raw)}
    done = Refreshed(tables, _checked(spark, target, watcher, known, tables))
    if only_passed:
        done.require_passed()
    target.commit(spark, [name for name in [*tables, KEYS, REPORT] if name not in views])
    return done


def _checked(
    spark: SparkSession,
    target: TableSink,
    watcher: watching.Watcher,
    known: Mapping[str, DataFrame],
    tables: Mapping[str, DataFrame],
) -> DataFrame:
    """The check report, from what the writes have counted and one pass over each key."""
    counted = watcher.counted()
    open_ = [c for c in watcher.checks if c.test in ("not_null", "accepted_values") and c not in counted]
    across = [c for c in watcher.checks if c.test in ("unique", "relationships")]
    answers = {
        key: watching.stored_key(source, tables)
        for key, source in watching.keys_to_count(across, watcher.prints()).items()
    }
    keys = watching.key_counts(known, dict.fromkeys(answers.values()))
    counts = target.publish(KEYS, keys, by=("table_name", "column_name"))
    parts = [
        watching.report_of_rows(spark, counted),
        watching.report_of_keys(counts, answers, across),
    ]
    if open_:
        parts.append(quality.report(known, open_).drop("outcome"))
    return target.publish(REPORT, watching.whole_report(parts))


def restate_month(raw: RawTables, sink: TableSink, month: date) -> dict[str, DataFrame]:
    """Bring the facts of one month up to date after its rows in the ledgers have changed.

    Between two refreshes into the folder of `sink`. Of the ledgers, that month's transactions and fees are
    read (and of all transactions their ids and days: fees may refer to any, and a month is reported once
    it has one). The month's folders of the working tables are overwritten, the others are not touched; fee,
    channel, daily, branch and division facts are computed again from the working tables and returned.
    Staged and decoded ledgers, accounts and customers stay as the last refresh left them.

    Raises `ValueError` for a month without transactions or fees in the ledgers: nothing would replace
    its folders, and a refresh is needed.
    """
    spark = raw.transactions.sparkSession
    start, end = F.lit(month.replace(day=1)), F.add_months(F.lit(month.replace(day=1)), 1)

    def of_month(ledger: DataFrame, day: str) -> DataFrame:
        return ledger.where((F.col(day) >= start) & (F.col(day) < end))

    bridge = sink.stored(spark, "int_finance__acct_cust_bridge")

    def built(transactions: DataFrame, fees: DataFrame) -> FinanceModels:
        models = FinanceModels(replace(raw, transactions=transactions, fees=fees), stored=True)
        models.__dict__["int_acct_cust_bridge"] = bridge
        return models

    parts = built(of_month(raw.transactions, "t_dt"), raw.fees).daily_parts
    fees = built(raw.transactions, of_month(raw.fees, "f_dt")).placed_fees
    fresh = {"int_finance__transactions_daily": parts, "int_finance__fees_placed": fees}
    for name, table in fresh.items():
        if table.isEmpty():
            raise ValueError(f"{name} has no rows in {month:%Y-%m}")
    for name, table in fresh.items():
        sink.replace_parts(name, table.hint("rebalance", F.col(MONTHLY[name])), by=(MONTHLY[name],))
    now = built(raw.transactions, raw.fees)
    now.__dict__["daily_parts"] = sink.stored(spark, "int_finance__transactions_daily")
    now.__dict__["placed_fees"] = sink.stored(spark, "int_finance__fees_placed")
    facts = ("fct_fees_revenue", "fct_channel_agg", "fct_daily_transactions", "fct_branch_performance")
    done = {name: sink.publish(name, getattr(now, name)) for name in facts}
    now.__dict__["fct_branch_performance"] = done["fct_branch_performance"]
    done["fct_division_performance"] = sink.publish("fct_division_performance", now.fct_division_performance)
    return done


def register_views(raw: RawTables, as_of: AsOf = None) -> FinanceModels:
    """Offer every table to SQL under its published name; nothing is stored or run."""
    models = FinanceModels(raw, as_of, publish_view)
    for attribute in PUBLISHED:
        getattr(models, attribute)
    return models
