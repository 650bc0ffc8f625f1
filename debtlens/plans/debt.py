"""Account debt report for a driver list."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens import measures as m
from debtlens.functions import nvl, total
from debtlens.operators import Scope, assemble, driver_list, one_per_key, pick_one
from debtlens.operators.scope import MAX_BROADCAST_KEYS
from debtlens.sources import Ledger

# Display names.
DEBT_LABELS = {
    "cid": "CID",
    "acc_no": "ACC_NO",
    "group_flag": "กลุ่มผู้กู้ยืม",
    "restructure_flag": "ปรับโครงสร้างหนี้",
    "total_amount": "จำนวนเงินที่ต้องชำระต่อเดือน",
    "no_of_late_bill": "จำนวนวันที่ผิดนัดชำระ",
    "cnt_default": "จำนวนงวดที่ผิดนัดชำระ",
    "principal_remain": "เงินต้นคงเหลือ",
    "interest_total": "ดอกเบี้ย",
    "fine_total": "เบี้ยปรับ",
    "principal_v1": "ยอดหนี้เงินต้นค้างชำระ (V1)",
    "interest_v1": "ดอกเบี้ยเงินต้นค้างชำระ (V1)",
    "fine_v1": "เบี้ยปรับเงินต้นค้างชำระ (V1)",
    "principal_v2": "ยอดหนี้เงินต้นค้างชำระ (V2)",
    "interest_v2": "ดอกเบี้ยเงินต้นค้างชำระ (V2)",
    "fine_v2": "เบี้ยปรับเงินต้นค้างชำระ (V2)",
    "fee1_total": "fee 1",
    "fee2_total": "fee 2",
    "fee3_total": "fee 3",
    "fee4_total": "fee 4",
    "payoff_amount": "ภาระหนี้คงเหลือ (ยอดปิดบัญชี)",
    "data_as_of": "ข้อมูล ณ",
}


def debt_report(
    ledger: Ledger,
    as_of: datetime.date,
    snapshot_date: datetime.date,
    accounts: Sequence[str] | None = None,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
    covers_most: bool = False,
    max_filter_keys: int | None = None,
) -> DataFrame:
    """One row per listed account: dues, arrears by version, fees and payoff.

    Contract and bank are not joined: no column of this report comes from them. The monthly
    summary shows only for accounts that the account view knows.
    """
    listed = driver_list(ledger["list_account_f69_117"], ["acc_no", "cid"], accounts)
    scope = Scope.of(listed, max_keys=max_broadcast_keys, covers_most=covers_most, max_filter_keys=max_filter_keys)

    def scoped(name: str) -> DataFrame:
        return scope.prefilter(ledger[name])

    known = scoped("mv_dms_acc_report").select("acc_no")
    summary = one_per_key(scoped("report_summary_month"), "acc_no", ["group_flag", "no_of_late_bill"])
    fee_amounts = [f"fee_amt{i}" for i in range(1, 5)]

    base = pick_one(listed, ["acc_no"], tiebreak=["cid"])
    parts = [
        summary.join(known, "acc_no", "left_semi"),
        one_per_key(scoped("dms_trn_input_for_recal"), "acc_no", ["restructure_flag"]),
        m.summary_versions(scoped("dms_trn_bill_summary")),
        m.day_amounts(scoped("dms_trn_cal_int_add_day")),
        m.snapshot_balances(scoped("mv_ktb_day"), snapshot_date),
        m.overdue_count(scoped("dms_trn_bills"), as_of),
        m.current_installment(scoped("dms_mst_installments")),
        one_per_key(scoped("loan_account"), "acc_no", fee_amounts),
        m.fee_credits(scoped("account_statement")),
        m.last_processed(scoped("dms_log_cal")),
    ]
    return assemble(base, parts).select(
        "cid",
        "acc_no",
        "group_flag",
        "restructure_flag",
        total(m.monthly_due()).alias("total_amount"),
        "no_of_late_bill",
        nvl("cnt_default", 0).alias("cnt_default"),
        F.col("o_bs_capital_remain").alias("principal_remain"),
        F.col("o_bs_accrued_interest").alias("interest_total"),
        F.col("o_bs_accrued_fine").alias("fine_total"),
        *m.version_breakdown(),
        *m.total_fees(),
        m.payoff().alias("payoff_amount"),
        "data_as_of",
    )
