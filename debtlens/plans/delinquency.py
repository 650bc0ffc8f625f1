"""Delinquency reports: accounts of the monthly summary that have recalculation input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens import measures as m
from debtlens.functions import constant, nvl, total
from debtlens.operators import Scope, assemble, driver_list, fixed, one_per_key, pick_one
from debtlens.sources import RELATIONS, Ledger

# Display names.
DELINQUENCY_LABELS = {"principal_arrears": "ยอดหนี้เงินต้นค้างชำระ"}
DRAFT_TEXTS = (
    "จำนวนเงินที่ต้องชำระต่อเดือน",
    "จำนวนวันที่ผิดนัดชำระ",
    "จำนวนงวดที่ผิดนัดชำระ",
)


class _Listed:
    """The relations of a ledger without NULL keys, narrowed to the accounts asked for.

    ``accounts`` are names or a relation with a column ``acc_no``; None asks for all.
    """

    def __init__(self, ledger: Ledger, accounts: Sequence[str] | DataFrame | None):
        self.ledger, self.accounts = ledger, accounts
        self.scope = None
        if isinstance(accounts, DataFrame):
            # Read by every scan: written once, so that all of them see one list.
            self.accounts, self.scope = None, Scope.of(fixed(accounts.select("acc_no"), "account_list"))

    def __getitem__(self, name: str) -> DataFrame:
        rows = driver_list(self.ledger[name], list(RELATIONS[name].columns), self.accounts)
        return rows.where(F.col("acc_no").isNotNull()) if self.scope is None else self.scope.prefilter(rows)

    def exactly(self, df: DataFrame) -> DataFrame:
        """Rows of listed accounts only, also where a long list has not filtered the relations."""
        return df if self.scope is None or self.scope.small else self.scope.restrict(df)


def _accounts(listed: _Listed, summary_columns: list[str]) -> DataFrame:
    """One row per account of the monthly summary with its restructure flag, restructured first."""
    summary = one_per_key(listed["report_summary_month"], "acc_no", summary_columns)
    restructured_first = F.when(F.col("restructure_flag") == m.RESTRUCTURED, 0).otherwise(1).asc()
    flags = pick_one(
        listed["dms_trn_input_for_recal"],
        ["acc_no"],
        order=[restructured_first],
        tiebreak=["restructure_flag"],
    )
    return listed.exactly(summary).join(flags, "acc_no")


def delinquency_report(ledger: Ledger, accounts: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """One row per account: amount due monthly, fined bills, principal in arrears."""
    listed = _Listed(ledger, accounts)
    base = _accounts(listed, ["cid", "group_flag", "no_of_late_bill"])
    parts = [
        m.delinquent_bills(listed["dms_trn_bills"]),
        m.current_installment(listed["dms_mst_installments"]),
    ]
    return assemble(base, parts).select(
        "cid",
        "acc_no",
        "group_flag",
        "restructure_flag",
        total(m.monthly_due()).alias("total_amount"),
        "no_of_late_bill",
        nvl("cnt_default", 0).alias("cnt_default"),
        total(nvl("sum_installment", 0)).alias("principal_arrears"),
    )


def delinquency_draft(ledger: Ledger, accounts: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """The first draft of the report, whose three figures were quoted as text by mistake.

    Its columns are the account's flags and three constant texts. The draft also joined
    bills and plan rows before counting; see :func:`fined_count_inflated` for that count.
    """
    base = _accounts(_Listed(ledger, accounts), ["cid", "group_flag"])
    return base.select(
        "cid", "acc_no", "group_flag", "restructure_flag", *(constant(t, t) for t in DRAFT_TEXTS)
    )


def fined_count_inflated(ledger: Ledger, accounts: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """The draft's count of fined bills, multiplied by the account's plan rows.

    Joining bills to plan rows on the account pairs each with each. The count of those pairs
    is a product of two counts, so the pairs are never made.
    """
    listed = _Listed(ledger, accounts)
    bills = m.fined_count(listed["dms_trn_bills"])
    plan = (
        listed["dms_mst_installments"]
        .where(F.col("version") == m.RESTRUCTURED_VERSION)
        .groupBy("acc_no")
        .agg(F.count(F.lit(1)).alias("plan_rows"))
    )
    base = _accounts(listed, ["cid"]).select("acc_no")
    pairs = nvl("cnt_default", 0) * F.greatest(nvl("plan_rows", 0), F.lit(1))
    return assemble(base, [bills, plan]).select("acc_no", pairs.alias("cnt_inflated"))
