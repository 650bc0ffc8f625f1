"""Medium lists, lists that change, measuring in one pass, and hot keys with equal rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from books import AS_OF, ROWS, SNAPSHOT, books, by_account, frame
from debtlens import measures as m
from debtlens import operators as op
from debtlens.operators.bloom import filterable, key_filter, may_hold, words_for
from debtlens.plans import audit_missing, contract_list, debt_report, delinquency_report
from debtlens.sources import Ledger
from test_hot_keys import hot, jobs_of


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
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ledger"))
    for name, rows in ROWS.items():
        frame(spark, name, rows).write.parquet(f"{root}/{name}.parquet")
    return Ledger.at(spark, root)


# --- Bloom filters ------------------------------------------------------------------------


def test_a_filter_passes_every_key_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("a"), F.col("id") * 7).alias("k")).union(spark.sql("SELECT NULL"))
    words = words_for(20_000)
    held = key_filter(keys, "k", words)
    assert held.count() <= words == 5000
    everything = spark.range(140_000).select(F.concat(F.lit("a"), "id").alias("k"), "id")
    passed = may_hold(everything, "k", held, words)
    own = passed.where("id % 7 = 0").count()
    assert own == 20_000 and passed.count() - own < 0.015 * 120_000


def test_keys_whose_hash_may_differ_are_not_filtered(spark):
    assert not any(map(filterable, ("double", "float", "string collate UNICODE_CI", "array<int>")))
    assert all(map(filterable, ("string", "bigint", "date", "decimal(18,2)")))
    scope = op.Scope.of(spark.createDataFrame([(1,)], "k int"), "k", max_keys=0, max_filter_keys=10)
    assert scope.words and "Join" not in plan(scope.prefilter(spark.range(5).withColumnRenamed("id", "k")))


@pytest.mark.parametrize(
    "run",
    [
        lambda ledger, **n: debt_report(ledger, AS_OF, SNAPSHOT, **n),
        lambda ledger, **n: contract_list(ledger, SNAPSHOT, **n),
        lambda ledger, **n: audit_missing(ledger, SNAPSHOT, **n),
    ],
)
def test_medium_lists_give_the_same_reports(spark, large, run):
    ledger = books(spark)
    short, long = run(ledger), run(ledger, max_broadcast_keys=0)
    medium = run(ledger, max_broadcast_keys=0, max_filter_keys=1000)
    assert Counter(medium.collect()) == Counter(short.collect()) == Counter(long.collect())


def test_a_medium_list_filters_every_fact_below_its_shuffle(stored, large):
    text = plan(debt_report(stored, AS_OF, SNAPSHOT, max_broadcast_keys=0, max_filter_keys=1000))
    facts = 11  # ten parts and the account view
    assert len(re.findall(r"BroadcastHashJoin \[pmod\(xxhash64\(acc_no", text)) == facts
    assert len(re.findall(r"Exchange hashpartitioning\(acc_no#\d+", text)) == facts + 1  # and the list
    for name in ("dms_trn_bills", "account_statement", "dms_log_cal", "dms_mst_installments"):
        above = text[: text.index(f"/{name}.parquet")]
        # Read upwards from the scan: the filter stands below the first shuffle by account.
        assert above.rindex("BroadcastHashJoin [pmod(xxhash64(acc_no") > above.rindex("Exchange hashpartitioning(acc_no")


def test_the_size_of_a_list_decides(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("acc_no"))
    of = lambda **n: op.Scope.of(rows, **n)
    assert of().small and of(max_keys=100).small
    assert not of(max_keys=99).small and of(max_keys=99).words == 25
    assert of(max_keys=12).words == 0 and of(max_keys=13).words == 25
    assert of(max_keys=0).words == 0 and of(max_keys=0, max_filter_keys=100).words == 25
    assert of(max_keys=99, covers_most=True) == op.Scope(rows, "acc_no", False)


# --- lists that change --------------------------------------------------------------------


def test_a_list_that_changes_is_read_once(spark, tmp_path):
    path = str(tmp_path / "list")
    ledger = books(spark)
    everyone = by_account(delinquency_report(ledger))
    first, second = sorted(everyone)[:2]
    spark.createDataFrame([(first,)], "acc_no string").write.parquet(path)
    report = delinquency_report(ledger, spark.read.parquet(path))
    spark.createDataFrame([(second,)], "acc_no string").write.mode("append").parquet(path)
    assert by_account(report) == {first: everyone[first]}
    # A list that is not the same twice, not even within one plan.
    wavering = spark.createDataFrame([(a,) for a in everyone], "acc_no string").where(F.rand() < 0.5)
    for _ in range(3):
        found = by_account(delinquency_report(ledger, wavering))
        assert found == {a: everyone[a] for a in found}


# --- measuring ----------------------------------------------------------------------------


def counted(df, key, one_in):
    """Frequent keys by counting every value."""
    rows = Counter(r[0] for r in df.select(key).collect())
    total = sum(rows.values())
    return {k: -(-n * one_in // total) for k, n in rows.items() if n * one_in > total}


def test_sketched_keys_are_those_of_an_exact_count(spark):
    n = 60_000
    df = spark.range(n).select(
        # Zipf-like: value v holds about 1 / v of the rows, far more values than a sketch tracks.
        F.floor(F.lit(n) / (F.pmod(F.xxhash64("id"), F.lit(n)) + 1)).alias("zipf"),
        F.when(F.col("id") % 3 == 0, F.lit("third")).when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("text"),
        F.col("id").alias("even"),
        F.to_date(F.lit("2020-01-01")).alias("day"),
    )
    for one_in in (10, 50, 400):
        found = op.frequent_keys(df, df.columns, one_in)
        for key in df.columns:
            expected = counted(df, key, one_in)
            assert hot(found[key]) == (expected or None)
    assert op.frequent_keys(df.limit(0), "zipf") is None


def test_sketches_shuffle_no_values(spark):
    from debtlens.operators.measuring import _recount, _summary

    df = spark.range(1000).select(F.col("id").alias("k"))
    text = plan(_summary("", df, ["k"], 100))
    assert text.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in text
    text = plan(_recount("", df, ["k"], {"k": ["1", None]}))
    assert "Join" not in text and "partial_count" in text.split("Exchange")[1]
    assert _recount("", df, ["k"], {"k": ["1", None]}).collect() == [("", "k", "1", 1)]


def test_one_job_measures_what_a_plan_needs(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("a"), F.lit("é").alias("b"))
    found = op.measure({"x": (df, ["a"]), "y": (df.limit(0), ["a", "b"]), "z": (df.where("a = 7"), ())}, 100)
    assert (found["x"].rows, found["x"].text_bytes, found["x"].frequent) == (3000, 6000, {"a": [("7", 1501)]})
    assert found["y"] == op.Measure(0, 0, {"a": [], "b": []}) and found["z"].rows == 1501
    ledger = Ledger.at(spark, _parquet(spark, tmp_path))
    for name in ROWS:
        ledger[name]
    # One action; adaptive execution submits the sketch stage of each relation as a job.
    assert jobs_of(spark, lambda: contract_list(ledger, SNAPSHOT)) <= 3 + 2  # and a recount
    assert jobs_of(spark, lambda: debt_report(ledger, AS_OF, SNAPSHOT)) <= 2


def _parquet(spark, tmp_path):
    for name, rows in ROWS.items():
        frame(spark, name, rows).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# --- hot keys with equal rows ---------------------------------------------------------------


def test_equal_rows_of_a_hot_key_stay_spread(spark, large):
    n = 8000
    df = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 4 != 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    for s in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled"):
        spark.conf.set(s, "false")
    try:
        found = op.total_over(df, "k", F.count(F.lit(1)), "n")
        assert Counter(map(tuple, found.collect())) == Counter(
            [("hot", n * 3 // 4)] * (n * 3 // 4) + [(str(i), 1) for i in range(0, n, 4)]
        )
        sizes = found.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 1.3 * n * 3 / 4 / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_split_join_equals_a_left_join(spark, large):
    df = spark.sql("SELECT IF(id % 3 = 0, 'a', IF(id % 3 = 1, NULL, string(id))) AS k, id FROM range(3000)")
    dim = spark.sql("SELECT * FROM VALUES ('a', 1), (NULL, 2), ('5', 3), ('zz', 4) AS t(d, x)")
    expected = Counter(map(tuple, df.join(dim, F.col("k").eqNullSafe(F.col("d")), "left").collect()))
    hot_keys = op.frequent_keys(df, "k", 100)
    assert hot(hot_keys).keys() == {"a", None}
    assert Counter(map(tuple, op.split_left_join(df, dim, "k", "d", hot_keys).collect())) == expected
    assert Counter(map(tuple, op.split_left_join(df, dim, "k", "d", None).collect())) == expected


def test_current_installment_takes_a_null_period_for_the_latest(spark):
    rows = [("a", 2, 5, 10), ("a", 2, None, 3), ("b", 2, 1, 7)]
    df = spark.createDataFrame(rows, "acc_no string, version int, periods int, period_installment_amount int")
    assert {r["acc_no"]: r["installment_amt"] for r in m.current_installment(df).collect()} == {"a": 3, "b": 7}
