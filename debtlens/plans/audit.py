"""Coverage audit: which sources lack which listed account."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debtlens import measures as m
from debtlens.functions import any_of, missing_flag, nvl
from debtlens.operators import (
    Measure,
    Scope,
    assemble,
    distinct_keys,
    driver_list,
    fits,
    frequent_keys,
    lookup,
    measure,
    multiplicity,
    repeat_rows,
    snapshot,
)
from debtlens.operators.scope import MAX_BROADCAST_KEYS
from debtlens.sources import Ledger

# Display names; {day} is the snapshot day as dd_mm_yyyy.
AUDIT_LABELS = {
    "acc_no": "ACC_NO",
    "no_account_view": "ไม่พบใน MV_DMS_ACC_REPORT",
    "no_contract": "ไม่พบใน CONTRACT",
    "no_bank": "ไม่พบใน RDBBANK",
    "no_monthly_summary": "ไม่พบใน REPORT_SUMMARY_MONTH",
    "no_loan_account": "ไม่พบใน LOAN_ACCOUNT",
    "no_recalculation": "ไม่พบใน DMS_TRN_INPUT_FOR_RECAL",
    "no_bill_summary": "ไม่พบใน DMS_TRN_BILL_SUMMARY",
    "no_day_interest": "ไม่พบใน DMS_TRN_CAL_INT_ADD_DAY",
    "no_snapshot": "ไม่พบใน MV_KTB_DAY_{day}",
    "no_open_bill": "ไม่พบใน bills_summary",
}

FLAGS = tuple(c for c in AUDIT_LABELS if c != "acc_no")


def audit_labels(snapshot_date: datetime.date) -> dict[str, str]:
    """The display names for an audit of that day's snapshot."""
    return {c: label.format(day=snapshot_date.strftime("%d_%m_%Y")) for c, label in AUDIT_LABELS.items()}


# A missing bank or a lack of open bills is shown, but does not put an account on the list.
DEFAULT_TRIGGERS = tuple(f for f in FLAGS if f not in ("no_bank", "no_open_bill"))


def _matches(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("acc_no").agg(F.count(F.lit(1)).alias(name))


def _contract_banks(contract: DataFrame, bank: DataFrame, size: Measure) -> DataFrame:
    """Per person: joined contract rows with a known bank, and contract rows without.

    Contracts are counted by person and bank code before they meet the banks.
    """
    coded = contract.where(F.col("cid").isNotNull()).groupBy("cid", "stu_bank_code")
    coded = coded.agg(F.count(F.lit(1)).alias("contracts"))
    banks = bank.groupBy("bank_code").agg(F.count(F.lit(1)).alias("banks"))
    if fits(bank, measured=size):
        found = lookup(coded, F.broadcast(banks), "stu_bank_code", "bank_code", ["banks"])
    else:
        hot = frequent_keys(coded, "stu_bank_code")
        found = lookup(coded, banks, "stu_bank_code", "bank_code", ["banks"], hot)
    return found.groupBy("cid").agg(
        F.sum(F.col("contracts") * nvl("banks", 0)).alias("with_bank"),
        F.sum(F.when(F.col("banks").isNull(), F.col("contracts")).otherwise(F.lit(0))).alias("without_bank"),
    )


def _variants() -> Column:
    """The flag combinations of an account's contract chain, each with its number of rows."""
    in_view = F.col("views").isNotNull()
    no_contract = F.when(in_view, F.col("without_contract")).otherwise(F.lit(1))

    def variant(has_contract: bool, has_bank: bool, rows: Column) -> Column:
        return F.struct(
            F.lit("" if has_contract else None).cast("string").alias("contract"),
            F.lit("" if has_bank else None).cast("string").alias("bank"),
            rows.cast("bigint").alias("rows"),
        )

    return F.array(
        variant(True, True, nvl("with_bank", 0)),
        variant(True, False, nvl("without_bank", 0)),
        variant(False, False, no_contract),
    )


def audit_missing(
    ledger: Ledger,
    snapshot_date: datetime.date,
    accounts: Sequence[str] | None = None,
    triggers: Sequence[str] = DEFAULT_TRIGGERS,
    blank: str | None = "",
    repeated: bool = False,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
    covers_most: bool = False,
    max_filter_keys: int | None = None,
) -> DataFrame:
    """Ten missing-source flags per listed account that any of ``triggers`` applies to.

    Left joins to the ten sources would repeat a listed account for every combination of
    matching source rows, and those rows differ only in the contract and bank flags. Each
    source is therefore reduced to a match count, and the result holds distinct rows with
    the number of such combinations in ``row_count``. ``repeated=True`` gives the rows of
    the joins instead. Mind its size where many accounts share one person who has many
    contracts: it has a row for every pair.

    Contract, bank, monthly summary and open bills are found through the account view: an
    account missing there is missing in all of them.
    """
    listed = driver_list(ledger["list_acc_broken_contract"], ["acc_no"], accounts)
    bank = ledger["rdbbank"]
    sizes = measure({"list": (listed, ()), "banks": (bank, ())})
    scope = Scope.of(
        listed,
        max_keys=max_broadcast_keys,
        covers_most=covers_most,
        max_filter_keys=max_filter_keys,
        measured=sizes["list"],
    )

    def scoped(name: str) -> DataFrame:
        return scope.prefilter(ledger[name])

    viewed = scoped("mv_dms_acc_report").groupBy("acc_no", "cid").agg(F.count(F.lit(1)).alias("n"))
    contract = ledger["contract"]
    hot = None
    if scope.small:
        # The persons of a short list restrict the contracts in their scan.
        people = viewed.where(F.col("cid").isNotNull()).select(F.col("cid").alias("_person")).distinct()
        if fits(people):
            contract = contract.join(F.broadcast(people), F.col("cid") == F.col("_person"), "left_semi")
    else:
        hot = frequent_keys(viewed, "cid")
    banks = _contract_banks(contract, bank, sizes["banks"])
    view = (
        lookup(viewed, banks, "cid", "cid", ["with_bank", "without_bank"], hot)
        .groupBy("acc_no")
        .agg(
            F.sum("n").alias("views"),
            F.sum(F.col("n") * F.col("with_bank")).alias("with_bank"),
            F.sum(F.col("n") * F.col("without_bank")).alias("without_bank"),
            F.sum(F.when(F.col("with_bank").isNull(), F.col("n")).otherwise(F.lit(0))).alias("without_contract"),
        )
    )
    open_bills = distinct_keys(scoped("dms_trn_bills"), "acc_no", m.is_open())
    parts = [
        view,
        _matches(scoped("report_summary_month"), "summaries"),
        _matches(scoped("loan_account"), "loans"),
        _matches(scoped("dms_trn_input_for_recal"), "recalculations"),
        _matches(scoped("dms_trn_bill_summary"), "bill_summaries"),
        _matches(scoped("dms_trn_cal_int_add_day"), "day_interests"),
        _matches(snapshot(scoped("mv_ktb_day"), snapshot_date), "snapshots"),
        open_bills.withColumn("open_bill", F.lit(1)),
    ]
    found = assemble(_matches(listed, "listings"), parts)

    in_view = F.col("views").isNotNull()
    flagged = found.withColumn("_variant", F.explode(_variants())).where(F.col("_variant.rows") > 0).select(
        "acc_no",
        missing_flag("views", blank).alias("no_account_view"),
        missing_flag("_variant.contract", blank).alias("no_contract"),
        missing_flag("_variant.bank", blank).alias("no_bank"),
        missing_flag(F.when(in_view, F.col("summaries")), blank).alias("no_monthly_summary"),
        missing_flag("loans", blank).alias("no_loan_account"),
        missing_flag("recalculations", blank).alias("no_recalculation"),
        missing_flag("bill_summaries", blank).alias("no_bill_summary"),
        missing_flag("day_interests", blank).alias("no_day_interest"),
        missing_flag("snapshots", blank).alias("no_snapshot"),
        missing_flag(F.when(in_view, F.col("open_bill")), blank).alias("no_open_bill"),
        (
            F.col("listings")
            * F.col("_variant.rows")
            * multiplicity(
                F.when(in_view, F.col("summaries")),
                "loans",
                "recalculations",
                "bill_summaries",
                "day_interests",
                "snapshots",
            )
        ).alias("row_count"),
    )
    missing = flagged.where(any_of(*(F.col(f) == "X" for f in triggers)))
    return repeat_rows(missing, "row_count") if repeated else missing
