"""Schemas of the four ledgers and the two reference lists, as loaded.

Identifiers arrive as whole numbers or as text, depending on the source; they are loaded as text, as they
are published.
"""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(18, 2)
IDENTIFIER = StringType()


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Table and column names as the ledgers arrive.
ACCOUNTS = _table(
    a_id=IDENTIFIER,
    c_id=IDENTIFIER,
    a_typ=StringType(),
    a_opn_dt=DateType(),
    a_cls_dt=DateType(),
    a_st=StringType(),
    a_bal=MONEY,
    br_cd=StringType(),
)
CUSTOMERS = _table(
    c_id=IDENTIFIER,
    c_extrn_ref=StringType(),
    c_dob=DateType(),
    c_onb_dt=DateType(),
    c_seg=StringType(),
    c_st_cd=StringType(),
    c_rsk_sc=IntegerType(),
    c_kyc_flg=IntegerType(),
)
FEES = _table(
    f_id=IDENTIFIER,
    a_id=IDENTIFIER,
    t_id=IDENTIFIER,
    f_typ=StringType(),
    f_amt=MONEY,
    f_dt=DateType(),
)
TRANSACTIONS = _table(
    t_id=IDENTIFIER,
    a_id=IDENTIFIER,
    t_dt=DateType(),
    t_post_dt=DateType(),
    t_amt=MONEY,
    t_dr_cr=StringType(),
    t_typ=StringType(),
    t_ch=StringType(),
    t_st=StringType(),
)
BRANCHES = _table(
    branch_code=StringType(),
    branch_name=StringType(),
    region_code=StringType(),
    division_code=StringType(),
)
DIVISIONS = _table(division_code=StringType(), division_name=StringType())

# Columns that identify a row of a ledger, here and in other ledgers.
IDENTIFIERS = ("a_id", "c_id", "f_id", "t_id")

LEDGERS = {"a_m": ACCOUNTS, "c_m": CUSTOMERS, "f_l": FEES, "t_l": TRANSACTIONS}
REFERENCE_LISTS = {"branches": BRANCHES, "divisions": DIVISIONS}
