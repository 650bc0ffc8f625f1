"""Business measures: per-key reductions of one relation each, and columns derived from them.

The reductions return one row per key, ready for :func:`debtlens.operators.assemble`, and
the derived columns read the names those reductions produce.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtlens.functions import (
    add0,
    all_of,
    any_of,
    before,
    count_where,
    decode,
    differs,
    latest_by,
    like_any,
    neg_total,
    nvl,
    preferred_version,
    sum_where,
    total,
    unlike,
)
from debtlens.operators import (
    Measure,
    fits,
    frequent_keys,
    lookup,
    one_per_key,
    pick_one,
    picked_version_sums,
    prefer_version,
    snapshot,
    split_by_version,
)

# Codes as the source systems store them.
OPEN_STATUS = "1"
RESTRUCTURED = "Y"
NOT_RESTRUCTURED = "N"
RESTRUCTURED_VERSION = 2
ORIGINAL_VERSION = 1

# Which ledger entries are fee adjustments.
FEE_TRAN_TYPES = ("4", "2")
FEE_TRAN_CODES = ("DEPTER_FEE", "ADJMONR", "ADJLEGAL", "REPAY", "PAYOFF")
ADJUSTMENT_CODE = "%ADJMON%"
FEE_REMARKS = ("%ค่าทนายความ%", "%ค่าฤชา%")
PAYMENT_REMARK = "%ชำระ%"
FEE_USERS = ("%FIX_LES%", "%DMSFIX%")

# Names and labels shown in reports.
ENTITY_BANKS = {"KTB": "ธนาคารกรุงไทย จำกัด (มหาชน)", "IBANK": "ธนาคารอิสลามแห่งประเทศไทย"}
NO_BANK = "(ไม่พบธนาคาร)"
UNKNOWN_STATUS = "ไม่ทราบสถานะ"
PERSON_STATUS = {
    "00": "ปกติ",
    "01": "ตาย",
    "02": "สาบสูญ",
    "03": "ทุพพลภาพ",
    "04": "โรคติดต่อร้ายแรง",
    "05": "โรคเรื้อรัง",
    "06": "จำคุกตลอดชีวิต",
    "07": "ล้มละลาย",
    "08": "พักชำระหนี้บัตรสวัสดิการแห่งรัฐ",
}
ACCOUNT_STATUS = {
    "00": "ปกติ (อยู่ระหว่างการผ่อนชำระ)",
    "01": "บัญชีใหม่",
    "90": "ปิดบัญชี (Pay Off)",
    "91": "ปิดบัญชี (รวมบัญชี)",
    "92": "ปิดบัญชี (ไม่มียอดหนี้ค้างชำระ)",
    "93": "ปิดบัญชี (มียอดหนี้ค้างชำระ)",
    "94": "ปิดบัญชี (จากการโอนหนี้)",
    "95": "ปิดบัญชี (เนื่องจากเสียชีวิต)",
}
LOAN_CLASS = {
    "A1": "ปกติ",
    "A2": "ค้างชำระ 1 วัน",
    "A3": "ค้างชำระ 31 วัน",
    "A4": "ค้างชำระ 91 วัน",
    "A5": "ค้างชำระ 121 วัน",
    "A6": "ค้างชำระ 151 วัน",
    "A7": "ค้างชำระ 181 วัน",
    "A8": "ค้างชำระ 361 วัน",
}

SUMMARY_AMOUNTS = (
    "capital_remain",
    "accrued_installment",
    "accrued_interest",
    "accrued_fine",
    "carry_interest",
    "carry_fine",
)


# ---------------------------------------------------------------- versions


def current_version(summary: DataFrame) -> DataFrame:
    """Highest version in the bill summary."""
    return summary.groupBy("acc_no").agg(F.max("version").alias("pick_version"))


def bill_version(bills: DataFrame) -> DataFrame:
    """2 for accounts with any version-2 bill, else 1. Not :func:`current_version`."""
    return prefer_version(bills, "acc_no", "version", RESTRUCTURED_VERSION, ORIGINAL_VERSION)


def summary_versions(summary: DataFrame) -> DataFrame:
    """Amounts of versions 1 and 2 side by side, with the highest version, in one pass."""
    return split_by_version(
        summary,
        "acc_no",
        "version",
        SUMMARY_AMOUNTS,
        versions=(ORIGINAL_VERSION, RESTRUCTURED_VERSION),
        extra={"pick_version": F.max("version")},
    )


# ------------------------------------------------------------------- bills


def is_open() -> Column:
    return all_of(F.col("status") == OPEN_STATUS, F.col("closed_date").isNull())


def _fined() -> Column:
    return count_where(nvl("fine_cal_amount", 0) > 0)


def overdue_count(bills: DataFrame, as_of: datetime.date) -> DataFrame:
    """Open bills that fell due before the ``as_of`` day."""
    return bills.groupBy("acc_no").agg(
        count_where(is_open() & before("due_period", as_of)).alias("cnt_default")
    )


def fined_count(bills: DataFrame) -> DataFrame:
    """Bills that carry a fine, whatever their version or status. Not :func:`overdue_count`."""
    return bills.groupBy("acc_no").agg(_fined().alias("cnt_default"))


def open_bill_sums(bills: DataFrame) -> DataFrame:
    """Principal, interest and fine over the open bills of :func:`bill_version`."""
    return picked_version_sums(
        bills,
        "acc_no",
        "version",
        {
            "sum_installment": "installment_cal_amount",
            "sum_interest": "interest_cal_amount",
            "sum_fine": "fine_cal_amount",
        },
        is_open(),
        RESTRUCTURED_VERSION,
        ORIGINAL_VERSION,
    )


def delinquent_bills(bills: DataFrame) -> DataFrame:
    """:func:`fined_count` and the principal of :func:`open_bill_sums` in one scan and shuffle."""
    principal = {
        v: sum_where("installment_cal_amount", is_open() & (F.col("version") == v))
        for v in (ORIGINAL_VERSION, RESTRUCTURED_VERSION)
    }
    picked = preferred_version("version", RESTRUCTURED_VERSION, ORIGINAL_VERSION)
    return bills.groupBy("acc_no").agg(
        _fined().alias("cnt_default"),
        F.when(picked == RESTRUCTURED_VERSION, principal[RESTRUCTURED_VERSION])
        .otherwise(principal[ORIGINAL_VERSION])
        .alias("sum_installment"),
    )


# ------------------------------------------------------------ installments


def _plan(installments: DataFrame, amount: Column) -> DataFrame:
    return (
        installments.where(F.col("version") == RESTRUCTURED_VERSION)
        .groupBy("acc_no")
        .agg(amount.alias("installment_amt"), F.lit(True).alias("has_plan"))
    )


def current_installment(installments: DataFrame) -> DataFrame:
    """Amount of the last period of the restructured plan; a NULL period counts as the latest."""
    amount = "period_installment_amount"
    return _plan(installments, latest_by(amount, ["periods"], tiebreak=[amount]))


def largest_installment(installments: DataFrame) -> DataFrame:
    """The largest amount of the restructured plan, as the first delinquency draft used."""
    return _plan(installments, F.max("period_installment_amount"))


def monthly_due() -> Column:
    """The installment of a restructured account that has a plan, else 0."""
    return F.when(
        (F.col("restructure_flag") == RESTRUCTURED) & F.col("has_plan").isNotNull(),
        nvl("installment_amt", 0),
    ).otherwise(F.lit(0))


# -------------------------------------------------------------------- fees


def is_fee_credit() -> Column:
    """Valid ledger entries of one of three kinds: a legal-fee adjustment by its remark, an
    adjustment by a correction user, or one of the fee codes."""
    adjustment = F.col("tran_code").like(ADJUSTMENT_CODE)
    return all_of(
        F.col("tran_type").isin(*FEE_TRAN_TYPES),
        F.col("tran_flag") == "N",
        F.col("ec_revert_flag") == "N",
        any_of(
            adjustment & like_any("remark", FEE_REMARKS) & unlike("remark", PAYMENT_REMARK),
            adjustment & like_any("tran_userid", FEE_USERS),
            F.col("tran_code").isin(*FEE_TRAN_CODES),
        ),
    )


def fee_credits(statement: DataFrame) -> DataFrame:
    """Magnitude of the negative amounts of each fee over the qualifying entries."""
    return (
        statement.where(is_fee_credit())
        .groupBy("acc_no")
        .agg(*(neg_total(f"fee{i}").alias(f"fee{i}_new") for i in range(1, 5)))
    )


def total_fees() -> list[Column]:
    """The account's fee plus its credits, for the four fees."""
    return [total(add0(f"fee_amt{i}", f"fee{i}_new")).alias(f"fee{i}_total") for i in range(1, 5)]


# ------------------------------------------------------- contract and bank


def preferred_contract(contract: DataFrame, bank: DataFrame, bank_size: Measure | None = None) -> DataFrame:
    """One contract per person with its bank's name: a known bank first, then any bank code,
    then the newest contract."""
    banks = one_per_key(bank, "bank_code", ["bank_name_th"]).withColumn("bank_known", F.lit(True))
    columns = ["bank_known", "bank_name_th"]
    if fits(bank, measured=bank_size):
        coded = lookup(contract, F.broadcast(banks), "stu_bank_code", "bank_code", columns)
    else:
        hot = frequent_keys(contract, "stu_bank_code")
        coded = lookup(contract, banks, "stu_bank_code", "bank_code", columns, hot)
    return pick_one(
        coded,
        ["cid"],
        order=[
            F.col("bank_known").desc_nulls_last(),
            F.col("stu_bank_code").isNull().asc(),
        ],
        tiebreak=[F.col("contract_seq").desc_nulls_last(), "stu_bank_code"],
    ).select("cid", "stu_bank_code", "bank_name_th")


def custodian(entity: Column | str, bank_name: Column | str) -> Column:
    """Two entities keep their own accounts; others are kept by the contract's bank."""
    return decode(entity, ENTITY_BANKS, nvl(bank_name, NO_BANK))


# ----------------------------------------------------- logs and snapshots


def last_processed(log: DataFrame) -> DataFrame:
    """Date of the last processing run."""
    return log.groupBy("acc_no").agg(F.max("cal_date").alias("data_as_of"))


def snapshot_balances(ktb: DataFrame, snapshot_date: datetime.date) -> DataFrame:
    """Balances on one day. An absent balance stays NULL."""
    balances = ["o_bs_capital_remain", "o_bs_accrued_interest", "o_bs_accrued_fine", "o_bs_lawyer_fee"]
    return one_per_key(snapshot(ktb, snapshot_date), "acc_no", balances)


def day_amounts(add_day: DataFrame) -> DataFrame:
    """Interest and fine of the days since the last bill."""
    one = one_per_key(add_day, "acc_no", ["interest", "fine"])
    return one.withColumnsRenamed({"interest": "day_interest", "fine": "day_fine"})


# ---------------------------------------------- columns over summary_versions


def _if_current(version: int, amount: str) -> Column:
    """The day amount belongs to the current version alone; a version above 2 gets none shown."""
    return F.when(F.col("pick_version") == version, nvl(amount, 0)).otherwise(F.lit(0))


def version_breakdown() -> list[Column]:
    """Arrears of versions 1 and 2. A restructured account shows the fine carried into version 2
    as its version-1 fine."""
    fine_v1 = F.when(F.col("restructure_flag") == RESTRUCTURED, nvl("carry_fine_v2", 0)).otherwise(
        add0("accrued_fine_v1", _if_current(1, "day_fine"))
    )
    columns = {
        "principal_v1": nvl("accrued_installment_v1", 0),
        "interest_v1": add0("accrued_interest_v1", _if_current(1, "day_interest")),
        "fine_v1": fine_v1,
        "principal_v2": nvl("accrued_installment_v2", 0),
        "interest_v2": add0("accrued_interest_v2", _if_current(2, "day_interest")),
        "fine_v2": add0("accrued_fine_v2", _if_current(2, "day_fine")),
    }
    return [total(c).alias(name) for name, c in columns.items()]


def payoff() -> Column:
    """Amount that closes the account. A restructured account owes no fine."""
    original = add0("capital_remain_v1", "accrued_interest_v1", "accrued_fine_v1", "day_interest", "day_fine")
    restructured = add0("capital_remain_v2", "accrued_interest_v2", "carry_interest_v2", "day_interest")
    flag = F.col("restructure_flag")
    return total(
        F.when(differs(flag, RESTRUCTURED, NOT_RESTRUCTURED), original).when(
            flag == RESTRUCTURED, restructured
        )
    )


def arrears() -> Column:
    """Everything accrued in versions 1 and 2, without the day amounts."""
    accrued = ("accrued_installment", "accrued_interest", "accrued_fine")
    return total(add0(*(f"{c}_v{v}" for c in accrued for v in (1, 2))))


# ------------------------------------------------------------ status, profile


def person_status(code: Column | str) -> Column:
    return decode(code, PERSON_STATUS, UNKNOWN_STATUS)


def account_status(code: Column | str) -> Column:
    return decode(code, ACCOUNT_STATUS, UNKNOWN_STATUS)


def loan_class(code: Column | str) -> Column:
    return decode(code, LOAN_CLASS, UNKNOWN_STATUS)


def first_known(*columns: str) -> Column:
    """The first source that knows the value."""
    return F.coalesce(*columns)
