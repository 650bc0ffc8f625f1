"""Broken-contract list: who owes, who keeps the account, and how much closes it."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens import measures as m
from debtlens.operators import (
    Scope,
    assemble,
    chain_left,
    driver_list,
    measure,
    one_per_key,
    pick_one,
    salts_of,
)
from debtlens.operators.scope import MAX_BROADCAST_KEYS
from debtlens.sources import Ledger
from debtlens.sources.relations import ADDRESS

# Display names of all columns.
CONTRACT_LABELS = {
    "custodian": "ดูแลบัญชีโดย",
    "acc_no": "เลขที่บัญชี",
    "loan_type": "ประเภทบัญชี",
    "loan_acc_status": "รหัสสถานะบัญชี",
    "person_status": "สถานะบุคคล",
    "account_status": "สถานะบัญชี",
    "cif": "รหัสผู้กู้",
    "cid": "เลขประจำตัวประชาชน",
    "title_name": "TITLE_NAME",
    "hr_name": "HR_NAME",
    "hr_surname": "HR_SURNAME",
    "last_payment_date": "LAST_PAYMENT_DATE",
    "no_of_late_bill": "NO_OF_LATE_BILL",
    "loan_classification": "LOAN_CLASSIFICATION",
    "group_flag": "GROUP_FLAG",
    "end_contract_date": "END_CONTRACT_DATE",
    **{c: c.upper() for c in ADDRESS},
    "total_amt": "TOTAL_AMT",
    "payoff": "ภาระหนี้คงเหลือ (ยอดปิดบัญชี)",
    "principal_remain": "เงินต้นคงเหลือ",
    "interest": "ดอกเบี้ย",
    "fine": "เบี้ยปรับ",
    "arrears": "ยอดหนี้ค้างชำระ (ยอดผิดนัดชำระหนี้)",
    "principal_v1": "ยอดหนี้เงินต้นค้างชำระ (V1)",
    "interest_v1": "ดอกเบี้ยเงินต้นค้างชำระ (V1)",
    "fine_v1": "เบี้ยปรับเงินต้นค้างชำระ (V1)",
    "principal_v2": "ยอดหนี้เงินต้นค้างชำระ (V2)",
    "interest_v2": "ดอกเบี้ยเงินต้นค้างชำระ (V2)",
    "fine_v2": "เบี้ยปรับเงินต้นค้างชำระ (V2)",
    "lawyer_fee": "ค่าธรรมเนียม",
    "employer_org": "หักองค์กรนายจ้าง",
    "data_as_of": "ข้อมูล ณ",
}

SUMMARY = [
    "loan_type",
    "sta_code",
    "loan_acc_status",
    "group_flag",
    "end_contract_date",
    "no_of_late_bill",
    "last_payment_date",
    "entity",
    "loan_classification",
]
PROFILE = ["loan_type", "title_name", "hr_name", "hr_surname"]


def _prefixed(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def contract_list(
    ledger: Ledger,
    snapshot_date: datetime.date,
    accounts: Sequence[str] | None = None,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
    covers_most: bool = False,
    max_filter_keys: int | None = None,
) -> DataFrame:
    """One row per listed account, 44 columns.

    The hops by person (contract and bank by ``cid``, person by ``cif``) come first, while
    a row is only the list's three keys; everything after them joins on the account. In a
    long list many accounts may share one person, or have none, so those hops are
    salted if a count by person finds it so.
    """
    listed = driver_list(ledger["list_acc_broken_contract"], ["acc_no", "cid", "cif"], accounts)
    banks = ledger["rdbbank"]
    # One job measures all that the plan depends on.
    sizes = measure({"list": (listed, ["cid", "cif"]), "banks": (banks, ())})
    scope = Scope.of(
        listed,
        max_keys=max_broadcast_keys,
        covers_most=covers_most,
        max_filter_keys=max_filter_keys,
        measured=sizes["list"],
    )

    def scoped(name: str) -> DataFrame:
        return scope.prefilter(ledger[name])

    contract = m.preferred_contract(scope.by("cid").prefilter(ledger["contract"]), banks, sizes["banks"])
    person_columns = ["hr_title", "hr_name", "hr_surname", *ADDRESS]
    person = one_per_key(scope.by("cif").prefilter(ledger["person"]), "cif", person_columns)
    person = _prefixed(person, "pr_", ["hr_title", "hr_name", "hr_surname"])
    accounts_once = pick_one(listed, ["acc_no"], tiebreak=["cid", "cif"])
    # A short list has too few rows for a hot key to matter. Of a long one the raw rows are counted,
    # in one pass: at least as many as accounts, so that every hot person among those is found
    # unless repeated rows outweigh it, which changes no result.
    hot = {} if scope.small else salts_of(listed, sizes["list"], ["cid", "cif"])
    base = chain_left(
        accounts_once,
        [
            (contract, "cid", "cid", ["bank_name_th"]),
            (person, "cif", "cif", [c for c in person.columns if c != "cif"]),
        ],
        hot,
    )

    view = one_per_key(scoped("mv_dms_acc_report"), "acc_no", [*PROFILE, "org"])
    summary = one_per_key(scoped("report_summary_month"), "acc_no", SUMMARY)
    parts = [
        _prefixed(view, "ar_", PROFILE),
        _prefixed(summary, "rsm_", ["loan_type"]),
        one_per_key(scoped("loan_account"), "acc_no", ["total_amt"]),
        one_per_key(scoped("dms_trn_input_for_recal"), "acc_no", ["restructure_flag"]),
        m.summary_versions(scoped("dms_trn_bill_summary")),
        m.day_amounts(scoped("dms_trn_cal_int_add_day")),
        m.snapshot_balances(scoped("mv_ktb_day"), snapshot_date),
        m.last_processed(scoped("dms_log_cal")),
    ]
    return assemble(base, parts).select(
        m.custodian("entity", "bank_name_th").alias("custodian"),
        "acc_no",
        m.first_known("ar_loan_type", "rsm_loan_type").alias("loan_type"),
        "loan_acc_status",
        m.person_status("sta_code").alias("person_status"),
        m.account_status("loan_acc_status").alias("account_status"),
        "cif",
        "cid",
        m.first_known("ar_title_name", "pr_hr_title").alias("title_name"),
        m.first_known("ar_hr_name", "pr_hr_name").alias("hr_name"),
        m.first_known("ar_hr_surname", "pr_hr_surname").alias("hr_surname"),
        "last_payment_date",
        "no_of_late_bill",
        m.loan_class("loan_classification").alias("loan_classification"),
        "group_flag",
        "end_contract_date",
        *ADDRESS,
        "total_amt",
        m.payoff().alias("payoff"),
        F.col("o_bs_capital_remain").alias("principal_remain"),
        F.col("o_bs_accrued_interest").alias("interest"),
        F.col("o_bs_accrued_fine").alias("fine"),
        m.arrears().alias("arrears"),
        *m.version_breakdown(),
        F.col("o_bs_lawyer_fee").alias("lawyer_fee"),
        F.col("org").alias("employer_org"),
        "data_as_of",
    )
