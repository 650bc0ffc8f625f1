"""A ledger written in buckets: no fact shuffle, and hot keys kept out of buckets."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from books import AS_OF, SNAPSHOT, books
from debtlens import measures as m
from debtlens.operators import Measure
from debtlens.plans import audit_missing, contract_list, debt_report
from debtlens.sources import RELATIONS, Ledger, Stored, layout, normalize, write_ledger

BUCKETS = 4


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for s in names:
        spark.conf.set(s, "-1")
    yield
    for s in names:
        spark.conf.unset(s)


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("laid_out"))
    found = write_ledger(books(spark), "laid_out", BUCKETS, place)
    assert found == {name: Stored(BUCKETS) for name in RELATIONS}
    return Ledger.at(spark, "laid_out")


def test_all_relations_come_back(spark, laid_out):
    ledger = books(spark)
    for name in RELATIONS:
        assert laid_out[name].schema == ledger[name].schema
        assert Counter(laid_out[name].collect()) == Counter(ledger[name].collect())


@pytest.mark.parametrize(
    "run",
    [
        lambda ledger, **n: debt_report(ledger, AS_OF, SNAPSHOT, **n),
        lambda ledger, **n: contract_list(ledger, SNAPSHOT, **n),
        lambda ledger, **n: audit_missing(ledger, SNAPSHOT, **n),
    ],
)
@pytest.mark.parametrize("how", [{}, {"covers_most": True}, {"max_broadcast_keys": 0, "max_filter_keys": 1000}])
def test_reports_over_buckets_are_the_same(spark, laid_out, run, how):
    assert Counter(run(laid_out, **how).collect()) == Counter(run(books(spark)).collect())


def test_the_debt_report_shuffles_nothing(laid_out, large):
    text = plan(debt_report(laid_out, AS_OF, SNAPSHOT, covers_most=True))
    assert text.count("Bucketed: true") == 12 and "Exchange" not in text


def test_a_report_prunes_days(laid_out):
    text = plan(m.snapshot_balances(laid_out["mv_ktb_day"], SNAPSHOT))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "snapshot_date" in filters and "2026-01-24" in filters


def test_one_file_per_bucket_and_none_for_a_key_too_large(spark, tmp_path, large):
    n = 4000
    log = spark.range(0, n, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), "id")).alias("acc_no"),
        F.lit("2020-01-01").alias("cal_date"),
    )
    even = spark.range(n).select(F.concat(F.lit("a"), "id").alias("acc_no"), F.lit("N").alias("restructure_flag"))
    frames = {"dms_log_cal": normalize(log, "dms_log_cal"), "dms_trn_input_for_recal": normalize(even, "dms_trn_input_for_recal")}
    found = write_ledger(Ledger.of(frames), "uneven", 64, str(tmp_path), frames)
    assert found == {"dms_log_cal": Stored(0, ("hot",)), "dms_trn_input_for_recal": Stored(64)}
    files = [f.name for f in (tmp_path / "dms_trn_input_for_recal").glob("*.parquet")]
    assert len(files) == 64 == len({re.search(r"_(\d+)\.c\d+", f).group(1) for f in files})
    # The hot key stays in as many files as it was read in, though its rows are all equal, and its
    # reduction still combines before the shuffle.
    ledger = Ledger.at(spark, "uneven")
    held = ledger["dms_log_cal"].where("acc_no = 'hot'").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(held) > 10 and max(r["count"] for r in held) < n / 3 / 5
    text = plan(m.last_processed(ledger["dms_log_cal"]))
    assert "Bucketed: true" not in text and "partial_max" in text.split("Exchange")[1]
    assert m.last_processed(ledger["dms_log_cal"]).count() == n - len(range(0, n, 3)) + 1


def test_a_layout_replaces_the_one_before(spark, tmp_path):
    rows = [spark.createDataFrame([(a, "2020-01-01")], "acc_no string, cal_date string") for a in ("x", "y")]
    for k, one in enumerate(rows):
        write_ledger(Ledger.of({"dms_log_cal": one}), "again", 2, f"{tmp_path}/{k}", ["dms_log_cal"])
    assert [r["acc_no"] for r in Ledger.at(spark, "again")["dms_log_cal"].collect()] == ["y"]


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "BUCKET_ROWS", 100)
    n = 3000
    account = F.concat(F.lit("a"), "id").alias("acc_no")
    even = spark.range(n).select(account, F.lit("N").alias("restructure_flag"))
    log = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("a"), "id")).alias("acc_no"),
        F.lit("2020-01-01").alias("cal_date"),
    )
    frames = {"dms_log_cal": normalize(log, "dms_log_cal"), "dms_trn_input_for_recal": normalize(even, "dms_trn_input_for_recal")}
    found = write_ledger(Ledger.of(frames), "grown", None, str(tmp_path), frames)
    assert found == {"dms_log_cal": Stored(0, ("hot",)), "dms_trn_input_for_recal": Stored(n // 100)}
    for name, df in frames.items():
        assert Counter(Ledger.at(spark, "grown")[name].collect()) == Counter(df.collect())


def test_small_and_huge_ledgers_have_bounded_buckets():
    assert layout.buckets_for(0) == layout.buckets_for(8 * layout.BUCKET_ROWS) == 8
    assert layout.buckets_for(8 * layout.BUCKET_ROWS + 1) == 9
    assert layout.buckets_for(10**12) == 8000


def test_values_that_hold_a_larger_share():
    found = Measure(100, 0, {"k": [("a", 50), (None, 10)], "l": []})
    assert found.over(2).frequent == {"k": [], "l": []}
    assert found.over(3).frequent == {"k": [("a", 50)], "l": []}
    assert found.over(11).frequent == found.frequent
