"""Ledgers in which one key holds a third of the rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from books import AS_OF, SNAPSHOT, books, by_account
from debtlens import measures as m
from debtlens import operators as op
from debtlens.plans import audit_missing, contract_list, debt_report, delinquency_report
from debtlens.sources import Ledger, normalize

ACCOUNTS = 3000
HOT = 1000


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 accounts, of which 1000 belong to person P0 and 1000 to nobody; P0 has 500 contracts,
    and account 0 has a third of the bills, ledger entries, plan rows and log rows."""
    accounts = spark.range(ACCOUNTS).select(
        F.concat(F.lit("a"), "id").alias("acc_no"),
        F.when(F.col("id") < HOT, "P0").when(F.col("id") >= 2 * HOT, F.concat(F.lit("P"), "id")).alias("cid"),
        F.when(F.col("id") < HOT, "F0").when(F.col("id") >= 2 * HOT, F.concat(F.lit("F"), "id")).alias("cif"),
        "id",
    )
    entries = spark.range(2 * ACCOUNTS).select(
        F.concat(F.lit("a"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % ACCOUNTS)).alias("acc_no"), "id"
    )
    changed = {
        "list_account_f69_117": accounts,
        "list_acc_broken_contract": accounts,
        "mv_dms_acc_report": accounts.selectExpr(
            "acc_no", "cid", *(f"NULL AS {c}" for c in ("loan_type", "title_name", "hr_name", "hr_surname", "org"))
        ),
        "contract": spark.range(HOT).selectExpr(
            "CASE WHEN id % 2 = 0 THEN 'P0' ELSE concat('P', id + 2000) END AS cid", "'B1' AS stu_bank_code",
            "id AS contract_seq",
        ),
        "person": spark.range(ACCOUNTS).selectExpr(
            "concat('F', id) AS cif", "'T' AS hr_title", "'N' AS hr_name", "concat('S', id) AS hr_surname",
            *(f"NULL AS ha_{c}" for c in "no building floor roomno village moo trong soi road tamname ampname"
              " provname moicode postal_code".split()),
        ),
        "dms_trn_input_for_recal": accounts.selectExpr("acc_no", "'Y' AS restructure_flag"),
        "report_summary_month": accounts.selectExpr(
            "acc_no", "cid", "'G' AS group_flag", "1 AS no_of_late_bill",
            *(f"NULL AS {c}" for c in ("loan_type", "sta_code", "loan_acc_status", "end_contract_date",
                                       "last_payment_date", "entity", "loan_classification")),
        ),
        "dms_trn_bills": entries.selectExpr(
            "acc_no", "2 AS version", "'1' AS status", "NULL AS closed_date",
            "timestamp_ntz'2020-01-01' AS due_period", "1 AS installment_cal_amount",
            "0 AS interest_cal_amount", "1 AS fine_cal_amount",
        ),
        "dms_mst_installments": entries.selectExpr(
            "acc_no", "2 AS version", "id AS periods", "id AS period_installment_amount"
        ),
        "account_statement": entries.selectExpr(
            "acc_no", "'4' AS tran_type", "'REPAY' AS tran_code", "NULL AS remark", "NULL AS tran_userid",
            "'N' AS tran_flag", "'N' AS ec_revert_flag", "-1 AS fee1", "0 AS fee2", "0 AS fee3", "0 AS fee4",
        ),
        "dms_log_cal": entries.selectExpr("acc_no", "timestamp_ntz'2020-01-01' AS cal_date"),
    }
    rest = books(spark)
    return Ledger(lambda name: normalize(changed[name], name) if name in changed else rest[name])


@pytest.fixture(autouse=True)
def as_on_large_tables(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for s in settings:
        spark.conf.set(s, "-1")
    yield
    for s in settings:
        spark.conf.unset(s)


ENTRIES_OF_HOT = 2 * ACCOUNTS // 3  # account 0's other entries have ids that 3 divides too


@pytest.mark.parametrize("max_keys", [0, 10_000], ids=["long list", "short list"])
def test_debt_report(skewed, max_keys):
    found = by_account(debt_report(skewed, AS_OF, SNAPSHOT, max_broadcast_keys=max_keys))
    assert len(found) == ACCOUNTS
    hot = found["a0"]
    assert (hot["cnt_default"], hot["fee1_total"]) == (ENTRIES_OF_HOT, ENTRIES_OF_HOT)
    assert hot["total_amount"] == 2 * ACCOUNTS - 3  # the last period's amount
    assert sum(r["cnt_default"] for r in found.values()) == 2 * ACCOUNTS


def test_delinquency_report(skewed):
    found = by_account(delinquency_report(skewed))
    assert len(found) == ACCOUNTS and found["a0"]["principal_arrears"] == ENTRIES_OF_HOT


def test_contract_list(skewed):
    long, short = (by_account(contract_list(skewed, SNAPSHOT, max_broadcast_keys=n)) for n in (0, 10_000))
    assert long == short and len(long) == ACCOUNTS
    surnames = Counter(r["hr_surname"] for r in long.values())
    assert surnames["S0"] == HOT and surnames[None] == HOT and len(surnames) == HOT + 2
    keepers = Counter(r["custodian"] for r in long.values())
    assert keepers == {"Bank One": HOT + 500, m.NO_BANK: 2 * HOT - 500}


@pytest.mark.parametrize("max_keys", [0, 10_000], ids=["long list", "short list"])
def test_audit_counts_pairs_without_making_them(skewed, max_keys):
    rows = audit_missing(skewed, SNAPSHOT, max_broadcast_keys=max_keys).collect()
    assert len(rows) == ACCOUNTS
    counts = Counter(r.row_count for r in rows)
    assert counts == {500: HOT, 1: 2 * HOT}


def test_hot_person_is_spread_over_tasks(spark, skewed):
    listed = skewed["list_acc_broken_contract"]
    person = op.one_per_key(skewed["person"], "cif", ["hr_surname"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = op.lookup(listed, person, "cif", "cif", ["hr_surname"], op.frequent_keys(listed, "cif"))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == ACCOUNTS and max(sizes) < 1.3 * ACCOUNTS / len(sizes)
