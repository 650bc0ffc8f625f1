"""Reports on the hand-made ledger."""

from collections import Counter
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from books import AS_OF, NOON, ROWS, SNAPSHOT, books, by_account, day
from debtlens import measures as m
from debtlens.operators import with_labels
from debtlens.plans import (
    AUDIT_LABELS,
    CONTRACT_LABELS,
    DEBT_LABELS,
    audit_missing,
    contract_list,
    debt_report,
    delinquency_draft,
    delinquency_report,
)
from debtlens.plans.audit import DEFAULT_TRIGGERS, FLAGS
from debtlens.plans.delinquency import DRAFT_TEXTS, fined_count_inflated

LONG_AND_SHORT = pytest.mark.parametrize("max_keys", [0, 1000], ids=["long list", "short list"])


@pytest.fixture(scope="module")
def ledger(spark):
    return books(spark)


@pytest.fixture(scope="module")
def doubled(spark):
    """Every right-hand relation with each row twice, and rows that no key can match."""
    lists = ("list_account_f69_117", "list_acc_broken_contract")
    facts = ("dms_trn_bills", "account_statement")
    copies = {
        name: rows * 2 + [{c: None for c in rows[0]}]
        for name, rows in ROWS.items()
        if name not in lists and name not in facts
    }
    return books(spark, **copies)


def debt(ledger, **options):
    return debt_report(ledger, AS_OF, SNAPSHOT, **options)


@LONG_AND_SHORT
def test_debt_report(ledger, max_keys):
    found = by_account(debt(ledger, max_broadcast_keys=max_keys))
    assert set(found) == {"v1", "v2", "both", "v3", "none", "hidden", None}

    assert found["v1"] == {
        "cid": "Pv1", "acc_no": "v1", "group_flag": "G1", "restructure_flag": "N",
        "total_amount": 0, "no_of_late_bill": 5, "cnt_default": 1,
        "principal_remain": 2, "interest_total": 3, "fine_total": 4,
        "principal_v1": 100, "interest_v1": Decimal("10.25"), "fine_v1": Decimal("1.50"),
        "principal_v2": 0, "interest_v2": 0, "fine_v2": 0,
        "fee1_total": 10 + 1 + 2 + 8 + 16 + 64, "fee2_total": 20, "fee3_total": 0, "fee4_total": 6,
        "payoff_amount": Decimal("1011.75"), "data_as_of": NOON,
    }
    v2 = found["v2"]
    assert (v2["total_amount"], v2["cnt_default"], v2["payoff_amount"]) == (400, 1, 2000 + 20 + 30)
    assert (v2["fine_v1"], v2["fine_v2"], v2["interest_v2"]) == (3, 2, 20)
    assert v2["principal_remain"] is None and v2["data_as_of"] is None

    both = found["both"]
    # The day interest goes to the current version, 2; the carried fine shows as the V1 fine.
    assert (both["interest_v1"], both["interest_v2"]) == (40, Decimal("80.75"))
    assert (both["fine_v1"], both["fine_v2"]) == (6, 8)
    assert (both["principal_v1"], both["principal_v2"]) == (400, 0)
    assert both["total_amount"] == 80  # the plan row without a period ranks last
    assert both["payoff_amount"] == Decimal("8080.75")
    assert both["cnt_default"] == 1

    v3 = found["v3"]  # a current version above 2 gives the day amounts to neither version
    assert (v3["interest_v1"], v3["interest_v2"], v3["fine_v1"], v3["fine_v2"]) == (0, 0, 0, 0)
    assert v3["payoff_amount"] == 7  # a NULL flag is not restructured
    assert (v3["restructure_flag"], v3["total_amount"]) == (None, 0)

    hidden = found["hidden"]  # the summary is invisible without the account view
    assert hidden["group_flag"] is None and hidden["no_of_late_bill"] is None
    assert found["none"]["payoff_amount"] == found[None]["payoff_amount"] == 0
    assert found[None]["cid"] == "Pnull"


@LONG_AND_SHORT
def test_contract_list(ledger, max_keys):
    report = contract_list(ledger, SNAPSHOT, max_broadcast_keys=max_keys)
    assert len(report.columns) == 44
    found = by_account(report)
    assert set(found) == {"v1", "v2", "both", "v3", "none", "hidden", None}

    v1 = found["v1"]
    assert v1["custodian"] == m.ENTITY_BANKS["KTB"]
    assert (v1["loan_type"], v1["title_name"], v1["hr_name"], v1["hr_surname"]) == ("AR", "Mx", "Person", "View")
    assert (v1["person_status"], v1["account_status"], v1["loan_classification"]) == ("ปกติ", "บัญชีใหม่", "ปกติ")
    assert (v1["payoff"], v1["arrears"]) == (Decimal("1011.75"), 111)
    assert (v1["ha_no"], v1["total_amt"], v1["lawyer_fee"], v1["employer_org"]) == ("1/2", 77, 5, "Org")
    assert v1["data_as_of"] == NOON

    assert found["v2"]["custodian"] == m.ENTITY_BANKS["IBANK"]
    assert found["both"]["custodian"] == "Bank Two"  # the newest contract with a known bank
    assert found["both"]["arrears"] == 400 + 40 + 80 + 4 + 8
    assert found["both"]["end_contract_date"] == day("2020-01-01")
    assert found["v3"]["custodian"] == m.NO_BANK  # the bank is known, its name is not
    assert found["both"]["person_status"] == found["none"]["person_status"] == m.UNKNOWN_STATUS
    assert found["hidden"]["loan_type"] == "RSM"  # here the summary does not depend on the view


def test_delinquency_report(ledger):
    found = by_account(delinquency_report(ledger))
    assert set(found) == {"v1", "v2", "both", "v3"}  # in both the summary and the recalculation input
    short = {a: (r["total_amount"], r["cnt_default"], r["principal_arrears"]) for a, r in found.items()}
    assert short == {
        "v1": (0, 2, 300),
        "v2": (400, 1, 300),
        "both": (80, 1, 60),
        "v3": (0, 0, 0),
    }
    assert set(by_account(delinquency_report(ledger, accounts=["v2", "nobody"]))) == {"v2"}


def test_delinquency_prefers_the_restructured_input(spark):
    flags = [dict(acc_no="v2", restructure_flag=f) for f in (None, "N", "Y")]
    twice = books(spark, dms_trn_input_for_recal=flags)
    assert by_account(delinquency_report(twice))["v2"]["total_amount"] == 400


def test_delinquency_draft_shows_texts(ledger):
    draft = delinquency_draft(ledger)
    assert draft.columns == ["cid", "acc_no", "group_flag", "restructure_flag", *DRAFT_TEXTS]
    found = by_account(draft)
    assert set(found) == {"v1", "v2", "both", "v3"}
    assert all(row[t] == t for row in found.values() for t in DRAFT_TEXTS)


def test_inflated_count_multiplies_by_plan_rows(ledger):
    found = {a: r["cnt_inflated"] for a, r in by_account(fined_count_inflated(ledger)).items()}
    assert found == {"v1": 2, "v2": 1 * 2, "both": 1 * 2, "v3": 0}


def test_largest_installment_is_not_the_current_one(ledger):
    plan = ledger["dms_mst_installments"]
    current = {a: r["installment_amt"] for a, r in by_account(m.current_installment(plan)).items()}
    largest = {a: r["installment_amt"] for a, r in by_account(m.largest_installment(plan)).items()}
    assert current == {"v2": 400, "both": 80, "v3": 70}
    assert largest == {"v2": 500, "both": 90, "v3": 70}


def test_open_bill_sums(ledger):
    found = by_account(m.open_bill_sums(ledger["dms_trn_bills"]))
    assert {a: (r["sum_installment"], r["sum_interest"], r["sum_fine"]) for a, r in found.items()} == {
        "v1": (300, 10, 1),
        "v2": (300, 0, 2),
        "both": (60, 0, 0),
    }


def test_preferred_contract(ledger):
    picked = m.preferred_contract(ledger["contract"], ledger["rdbbank"]).collect()
    assert {r.cid: (r.stu_bank_code, r.bank_name_th) for r in picked} == {
        "Pv1": ("B1", "Bank One"),
        "Pv2": ("gone", None),
        "Pboth": ("B2", "Bank Two"),
        "Pv3": ("B3", None),
    }


# --------------------------------------------------------------- properties


@LONG_AND_SHORT
def test_duplicate_rows_do_not_change_the_debt_report(ledger, doubled, max_keys):
    assert by_account(debt(doubled, max_broadcast_keys=max_keys)) == by_account(debt(ledger))


@LONG_AND_SHORT
def test_duplicate_rows_do_not_change_the_contract_list(ledger, doubled, max_keys):
    plain = by_account(contract_list(ledger, SNAPSHOT))
    assert by_account(contract_list(doubled, SNAPSHOT, max_broadcast_keys=max_keys)) == plain


def test_duplicate_rows_do_not_change_delinquency(ledger, doubled):
    assert by_account(delinquency_report(doubled)) == by_account(delinquency_report(ledger))


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_results_do_not_depend_on_partitioning(spark, ledger, doubled, partitions):
    expected = by_account(debt(ledger))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert by_account(debt(doubled)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_named_accounts_only(ledger):
    assert set(by_account(debt(ledger, accounts=["v1", "zzz"]))) == {"v1"}
    assert set(by_account(contract_list(ledger, SNAPSHOT, accounts=["both"]))) == {"both"}


def test_display_names(ledger):
    shown = with_labels(debt(ledger), DEBT_LABELS).columns
    assert shown[:2] == ["CID", "ACC_NO"] and shown[-1] == "ข้อมูล ณ" and len(set(shown)) == 22
    listed = contract_list(ledger, SNAPSHOT)
    assert set(CONTRACT_LABELS) == set(listed.columns)
    assert len(set(with_labels(listed, CONTRACT_LABELS).columns)) == 44


# -------------------------------------------------------------------- audit


def audit_by_hand(rows: dict[str, list[dict]], triggers=DEFAULT_TRIGGERS) -> Counter:
    """The chain of left joins, one combination of source rows at a time."""

    def matches(name, column, value, where=lambda r: True):
        found = [r for r in rows[name] if value is not None and r.get(column) == value and where(r)]
        return found or [None]

    def is_open(row):
        return row.get("status") == "1" and row.get("closed_date") is None

    out = Counter()
    for listed in rows["list_acc_broken_contract"]:
        acc = listed["acc_no"]
        for view in matches("mv_dms_acc_report", "acc_no", acc):
            seen = acc if view else None
            for contract in matches("contract", "cid", view and view["cid"]):
                code = contract and contract["stu_bank_code"]
                sources = product(
                    matches("rdbbank", "bank_code", code),
                    matches("report_summary_month", "acc_no", seen),
                    matches("loan_account", "acc_no", acc),
                    matches("dms_trn_input_for_recal", "acc_no", acc),
                    matches("dms_trn_bill_summary", "acc_no", acc),
                    matches("dms_trn_cal_int_add_day", "acc_no", acc),
                    matches("mv_ktb_day", "acc_no", acc, lambda r: r["snapshot_date"] == SNAPSHOT),
                    matches("dms_trn_bills", "acc_no", seen, is_open)[:1],
                )
                for combination in sources:
                    flags = ["" if s else "X" for s in (view, contract, *combination)]
                    if any(flags[FLAGS.index(t)] for t in triggers):
                        out[(acc, *flags)] += 1
    return out


REPEATED = {
    "rdbbank": ROWS["rdbbank"] + ROWS["rdbbank"][:1],
    "mv_dms_acc_report": ROWS["mv_dms_acc_report"] + [dict(acc_no="both", cid="Pv2"), dict(acc_no="v2", cid="gone")],
    "loan_account": ROWS["loan_account"] * 2,
    "report_summary_month": ROWS["report_summary_month"] * 3,
    "mv_ktb_day": ROWS["mv_ktb_day"] + [dict(acc_no="both", snapshot_date=SNAPSHOT)],
    "dms_trn_input_for_recal": [*ROWS["dms_trn_input_for_recal"], dict(acc_no=None, restructure_flag="Y")],
}


@LONG_AND_SHORT
@pytest.mark.parametrize("extra", [{}, REPEATED], ids=["plain", "repeated"])
@pytest.mark.parametrize("triggers", [DEFAULT_TRIGGERS, ("no_bank",)], ids=["default", "bank"])
def test_audit_equals_the_joins(spark, extra, triggers, max_keys):
    ledger = books(spark, **extra)
    expected = audit_by_hand(ROWS | extra, triggers)
    options = dict(triggers=triggers, max_broadcast_keys=max_keys)
    audit = audit_missing(ledger, SNAPSHOT, repeated=True, **options)
    assert audit.columns == list(AUDIT_LABELS)
    assert Counter(tuple(r) for r in audit.collect()) == expected
    counted = audit_missing(ledger, SNAPSHOT, **options).collect()
    assert {tuple(r)[:-1]: r.row_count for r in counted} == expected


def test_audit_blank_may_be_null(ledger):
    flags = audit_missing(ledger, SNAPSHOT, blank=None).select(*FLAGS)
    assert {v for row in flags.collect() for v in row} == {"X", None}


def test_snapshot_uses_one_day_only(ledger):
    later = m.snapshot_balances(ledger["mv_ktb_day"], SNAPSHOT).collect()
    assert [(r.acc_no, r.o_bs_capital_remain) for r in later] == [("v1", 2)]


def test_arrears_are_the_six_accrued_amounts(spark, ledger):
    versions = m.summary_versions(ledger["dms_trn_bill_summary"])
    accrued = [f"{c}_v{v}" for c in ("accrued_installment", "accrued_interest", "accrued_fine") for v in (1, 2)]
    rows = versions.select(m.arrears().alias("total"), *accrued).collect()
    assert all(r.total == sum(r[c] or 0 for c in accrued) for r in rows)


def test_each_account_once_even_when_listed_many_times(spark):
    many = books(spark, list_account_f69_117=ROWS["list_account_f69_117"] * 5)
    assert by_account(debt(many)) == by_account(debt(books(spark)))
    assert debt(many).where(F.col("acc_no").isNull()).count() == 1
