"""Spark-native reporting tables, quality checks and metrics for a retail and commercial bank."""

from ledgerloom.plans.models import FinanceModels
from ledgerloom.plans.refresh import Refreshed, refresh, register_views, restate_month
from ledgerloom.sources.tables import RawTables, TableSink, VersionedSink, load

__all__ = [
    "FinanceModels",
    "RawTables",
    "Refreshed",
    "TableSink",
    "VersionedSink",
    "load",
    "refresh",
    "register_views",
    "restate_month",
]
