"""The sixteen tables, each defined once over the tables it reads."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from ledgerloom.functions.expressions import AsOf
from ledgerloom.operators import (
    accounts,
    activity,
    branches,
    customer_sets,
    customers,
    decode,
    divisions,
    measures,
    metrics,
    staging,
)
from ledgerloom.operators.bridge import account_customer_bridge, attach_account, branch_places
from ledgerloom.plans.columns import COLUMNS
from ledgerloom.sources.tables import RawTables

# Published name of each table.
PUBLISHED = {
    "stg_accounts": "stg_finance__accounts",
    "stg_customers": "stg_finance__customers",
    "stg_fees": "stg_finance__fees",
    "stg_transactions": "stg_finance__transactions",
    "int_accounts_decoded": "int_finance__accounts_decoded",
    "int_customers_decoded": "int_finance__customers_decoded",
    "int_transactions_decoded": "int_finance__transactions_decoded",
    "int_fees_decoded": "int_finance__fees_decoded",
    "int_acct_cust_bridge": "int_finance__acct_cust_bridge",
    "daily_parts": "int_finance__transactions_daily",
    "placed_fees": "int_finance__fees_placed",
    "fct_account_summary": "fct_account_summary",
    "fct_customer_360": "fct_customer_360",
    "fct_fees_revenue": "fct_fees_revenue",
    "fct_channel_agg": "fct_channel_agg",
    "fct_daily_transactions": "fct_daily_transactions",
    "fct_branch_performance": "fct_branch_performance",
    "fct_division_performance": "fct_division_performance",
}
# Each layer reads only the layers before it.
LAYERS = (
    ("stg_accounts", "stg_customers", "stg_fees", "stg_transactions"),
    (
        "int_accounts_decoded",
        "int_customers_decoded",
        "int_transactions_decoded",
        "int_fees_decoded",
    ),
    ("int_acct_cust_bridge",),
    ("daily_parts", "placed_fees"),
    (
        "fct_account_summary",
        "fct_customer_360",
        "fct_fees_revenue",
        "fct_channel_agg",
        "fct_daily_transactions",
        "fct_branch_performance",
    ),
    ("fct_division_performance",),
)
# Working tables: what branch, channel, daily and fee facts read, with the place of the
# account. They exist so that the join runs once for all facts.
WORKING = ("daily_parts", "placed_fees")
_PLACE = ("branch_code", "division_code", "division_name")
_TRANSACTION_FACTS = (
    "transaction_date",
    "transaction_month",
    "transaction_amount",
    "signed_amount",
    "transaction_type_code",
    "transaction_channel_code",
    "settlement_status",
    "settlement_lag_days",
)
_FEE_FACTS = ("fee_month", "fee_type_code", "fee_amount", "is_standalone_fee")

Keep = Callable[[str, DataFrame], DataFrame]


def _table(define: Callable[[FinanceModels], DataFrame]) -> cached_property:
    def build(self: FinanceModels) -> DataFrame:
        table = define(self)
        if define.__name__ in COLUMNS:
            table = table.select(*COLUMNS[define.__name__])
        return self._keep(PUBLISHED[define.__name__], table)

    return cached_property(build)


class FinanceModels:
    """Lazy tables over the inputs: reading an attribute plans it, nothing runs.

    `keep(name, table)` may store a table and return a scan of it, which every
    later table then reads. By default tables are left unevaluated. `stored` says
    that tables are kept, so that adding up by day pays.
    """

    def __init__(self, raw: RawTables, as_of: AsOf = None, keep: Keep | None = None, stored: bool = False):
        self.raw = raw
        self.as_of = as_of
        self._keep = keep or (lambda name, table: table)
        self._stored = stored

    @_table
    def stg_accounts(self):
        return staging.stage_accounts(self.raw.accounts)

    @_table
    def stg_customers(self):
        return staging.stage_customers(self.raw.customers)

    @_table
    def stg_fees(self):
        return staging.stage_fees(self.raw.fees)

    @_table
    def stg_transactions(self):
        return staging.stage_transactions(self.raw.transactions)

    @_table
    def int_accounts_decoded(self):
        return decode.decode_accounts(self.stg_accounts, self.as_of)

    @_table
    def int_customers_decoded(self):
        return decode.decode_customers(self.stg_customers, self.as_of)

    @_table
    def int_transactions_decoded(self):
        return decode.decode_transactions(self.stg_transactions)

    @_table
    def int_fees_decoded(self):
        return decode.decode_fees(self.stg_fees, self.stg_transactions)

    @_table
    def int_acct_cust_bridge(self):
        return account_customer_bridge(
            self.int_accounts_decoded,
            self.int_customers_decoded,
            self.raw.branches,
            self.raw.divisions,
        )

    @_table
    def daily_parts(self):
        facts = attach_account(self.int_transactions_decoded, self.int_acct_cust_bridge)
        parts = activity.transaction_parts(facts.select(*_TRANSACTION_FACTS, *_PLACE))
        return activity.pre_aggregated(parts) if self._stored else parts

    @_table
    def placed_fees(self):
        facts = attach_account(self.int_fees_decoded, self.int_acct_cust_bridge)
        return facts.select(*_FEE_FACTS, *_PLACE)

    @_table
    def fct_account_summary(self):
        return accounts.account_summary(
            self.int_acct_cust_bridge,
            self.int_transactions_decoded,
            self.int_fees_decoded,
            self.as_of,
        )

    @_table
    def fct_customer_360(self):
        return customers.customer_360(
            self.int_customers_decoded,
            self.int_acct_cust_bridge,
            self.int_transactions_decoded,
            self.int_fees_decoded,
            self.as_of,
        )

    @_table
    def fct_fees_revenue(self):
        return activity.fee_revenue(self.placed_fees)

    @_table
    def fct_channel_agg(self):
        return activity.channel_mix(self.daily_parts)

    @_table
    def fct_daily_transactions(self):
        return activity.daily_transactions(self.daily_parts)

    @_table
    def fct_branch_performance(self):
        return branches.branch_performance(
            self.int_acct_cust_bridge,
            self.int_transactions_decoded,
            self.daily_parts,
            self.placed_fees,
        )

    @_table
    def fct_division_performance(self):
        return divisions.division_performance(self.fct_branch_performance)

    @cached_property
    def month_end_accounts(self):
        """Accounts open at the end of each report month, by branch, with its region and division."""
        stock = branches.accounts_active_at_month_end(
            self.int_acct_cust_bridge, self.int_transactions_decoded
        )
        places = branch_places(self.int_acct_cust_bridge)
        return stock.join(places.select("branch_code", "region_code", "division_code"), "branch_code")

    @cached_property
    def customer_sets(self):
        """Customers of each branch and opening month as sets that can be united."""
        numbers = customer_sets.numbered_customers(self.int_customers_decoded)
        return customer_sets.customer_sets(self.int_acct_cust_bridge, numbers)

    def measure(
        self, name: str, by: Sequence[str] = ("division_code",), period: str = "month"
    ) -> DataFrame:
        """A measure by name for columns and a period over which it adds up; refused for others."""
        return measures.measured(name, getattr(self, measures.MEASURES[name].table), by, period)

    def metric(self, name: str, by: Sequence[str] | None = None) -> DataFrame:
        """A metric, or list, by name, at its usual grain or by other columns of its table."""
        compute, table = {**metrics.METRICS, **metrics.LISTS}[name]
        source = getattr(self, table)
        return compute(source) if by is None else compute(source, tuple(by))

    def checked_tables(self) -> dict[str, DataFrame]:
        """Every table a data check may name."""
        published = {n: getattr(self, a) for a, n in PUBLISHED.items() if a not in WORKING}
        return ledgers(self.raw) | published


def ledgers(raw: RawTables) -> dict[str, DataFrame]:
    """The inputs by the names under which checks know them."""
    return {
        "a_m": raw.accounts,
        "c_m": raw.customers,
        "f_l": raw.fees,
        "t_l": raw.transactions,
        "branches": raw.branches,
        "divisions": raw.divisions,
    }
