"""A small bank by hand, with the rows that are easy to get wrong."""

from datetime import date as d
from decimal import Decimal as D

from ledgerloom.sources import schemas
from ledgerloom.sources.seeds import seed_branches, seed_divisions
from ledgerloom.sources.tables import RawTables

AS_OF = "2024-12-31"

ACCOUNTS = [
    # id, customer, type, opened, closed, status, balance, branch
    (1, 1, "SAV", d(2023, 1, 15), None, "O", D("9999.00"), "BR001"),
    (2, 1, "CHK", d(2023, 1, 20), None, "O", D("9999.50"), "BR001"),
    (3, 1, "COM_LN", d(2022, 6, 1), d(2023, 6, 1), "C", D("-10.00"), "BR009"),
    (4, 2, "CC", d(2023, 2, 28), None, "F", D("49999.99"), "BR002"),
    (5, 2, "NEW", None, None, "X", None, "BR002"),
    (6, 3, None, d(2024, 12, 31), None, None, D("0.00"), "BR009"),
    (7, 3, "LN", d(2023, 1, 31), None, "O", D("50000.00"), "BR404"),
    (8, 99, "SAV", d(2023, 1, 1), None, "O", D("1.00"), "BR001"),
]
CUSTOMERS = [
    # id, reference, born, since, segment, status, risk, checked
    (1, "CRM-000001-0A1B", d(1964, 12, 31), d(2024, 10, 2), "RTL", "AC", 40, 1),
    (2, "CRM-000002-0002", d(1963, 12, 31), d(2024, 7, 4), "COM", "DM", 30, 0),
    (3, "CRM-000003-0003", None, d(2024, 10, 1), "PRM", "CL", 39, 1),
    (4, "CRM-000004-0004", d(2010, 1, 1), d(2024, 7, 3), "VIP", "ZZ", None, None),
]
TRANSACTIONS = [
    # id, account, day, posted, amount, side, type, channel, status
    (10, 1, d(2024, 12, 1), d(2024, 12, 3), D("100.00"), "D", "POS", "POS", "S"),
    (11, 1, d(2024, 12, 1), d(2024, 12, 1), D("50.05"), "C", "DEP", "MOB", "P"),
    (12, 2, d(2024, 10, 2), d(2024, 10, 2), D("10.00"), "D", "ATM", "MOB", "R"),
    (13, 2, d(2024, 1, 1), d(2024, 1, 1), D("20.00"), "X", "WDR", "POS", "S"),
    (14, 4, d(2024, 10, 1), d(2024, 10, 2), D("30.00"), "C", "XXX", None, None),
    (15, 4, d(2023, 3, 1), d(2023, 3, 1), D("1.01"), "C", "TFR", "WIRE", "S"),
    (16, 3, d(2025, 1, 5), d(2025, 1, 5), D("7.00"), "D", "INT", "FAX", "S"),
    (17, 8, d(2024, 6, 1), d(2024, 6, 1), D("9.00"), "D", "FEE", "BR", "S"),
]
FEES = [
    # id, account, transaction, type, amount, day
    (100, 1, 10, "MAINT", D("5.00"), d(2024, 12, 1)),
    (101, 1, None, "OD", D("7.50"), d(2024, 12, 5)),
    (102, 1, 999, "WIRE", D("2.50"), d(2024, 10, 5)),
    (103, 3, 10, "SVC", D("1.00"), d(2024, 1, 5)),
    (104, 4, None, "GIFT", D("3.00"), d(2023, 3, 5)),
    (105, 8, 17, "ATM", D("4.00"), d(2024, 6, 1)),
]


def table(spark, rows, schema):
    """Identifiers are written as numbers above and arrive as text."""
    return spark.createDataFrame(
        [[str(v) if f.name in schemas.IDENTIFIERS and v is not None else v for f, v in zip(schema, row)] for row in rows],
        schema,
    )


def hand_made(spark) -> RawTables:
    return RawTables(
        accounts=table(spark, ACCOUNTS, schemas.ACCOUNTS),
        customers=table(spark, CUSTOMERS, schemas.CUSTOMERS),
        fees=table(spark, FEES, schemas.FEES),
        transactions=table(spark, TRANSACTIONS, schemas.TRANSACTIONS),
        branches=seed_branches(spark),
        divisions=seed_divisions(spark),
    )
