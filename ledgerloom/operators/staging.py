"""First layer: readable column names, identifiers and flags as text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Arriving and published names of each ledger.
NAMES = {
    "a_m": {
        "a_id": "account_id",
        "c_id": "customer_id",
        "a_typ": "account_type_code",
        "a_opn_dt": "open_date",
        "a_cls_dt": "close_date",
        "a_st": "account_status_code",
        "a_bal": "balance",
        "br_cd": "branch_code",
    },
    "c_m": {
        "c_id": "customer_id",
        "c_extrn_ref": "crm_reference",
        "c_dob": "date_of_birth",
        "c_onb_dt": "onboard_date",
        "c_seg": "segment_code",
        "c_st_cd": "customer_status_code",
        "c_rsk_sc": "risk_score",
        "c_kyc_flg": "know_your_cust_flag",
    },
    "f_l": {
        "f_id": "fee_id",
        "a_id": "account_id",
        "t_id": "transaction_id",
        "f_typ": "fee_type_code",
        "f_amt": "fee_amount",
        "f_dt": "fee_date",
    },
    "t_l": {
        "t_id": "transaction_id",
        "a_id": "account_id",
        "t_dt": "transaction_date",
        "t_post_dt": "posting_date",
        "t_amt": "transaction_amount",
        "t_dr_cr": "transaction_indicator",
        "t_typ": "transaction_type_code",
        "t_ch": "transaction_channel_code",
        "t_st": "settlement_status",
    },
}


def _renamed(raw: DataFrame, ledger: str, text: tuple[str, ...]) -> DataFrame:
    return raw.select(
        *[
            (F.col(old).cast("string") if old in text else F.col(old)).alias(new)
            for old, new in NAMES[ledger].items()
        ]
    )


def stage_accounts(raw: DataFrame) -> DataFrame:
    return _renamed(raw, "a_m", text=("a_id", "c_id"))


def stage_customers(raw: DataFrame) -> DataFrame:
    return _renamed(raw, "c_m", text=("c_id", "c_kyc_flg"))


def stage_fees(raw: DataFrame) -> DataFrame:
    return _renamed(raw, "f_l", text=("f_id", "a_id", "t_id"))


def stage_transactions(raw: DataFrame) -> DataFrame:
    return _renamed(raw, "t_l", text=("t_id", "a_id"))
