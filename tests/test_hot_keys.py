"""Measuring keys once, keeping what was measured, and spreading what is hot."""

import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from books import ROWS, SNAPSHOT, books, by_account, frame
from debtlens import operators as op
from debtlens.operators.scope import named
from debtlens.plans import contract_list, debt_report, delinquency_report
from debtlens.settings import settings
from debtlens.sources import Ledger


def jobs_of(spark, run):
    """How many Spark jobs ``run`` starts."""
    sc = spark.sparkContext
    group = uuid.uuid4().hex
    sc.setJobGroup(group, "counted")
    try:
        run()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def hot(df):
    return df and {r["_hot_key"]: r["_salts"] for r in df.collect()}


def test_frequent_keys_of_several_columns_at_once(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"),
        F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id").cast("string")).alias("b"),
        F.col("id").alias("c"),
    )
    found = op.frequent_keys(df, ["a", "b", "c"], one_in=100)
    assert {k: hot(v) for k, v in found.items()} == {"a": {7: 34}, "b": {None: 50}, "c": None}
    assert dict(found["a"].dtypes)["_hot_key"] == "bigint"
    assert hot(op.frequent_keys(df, "a", one_in=100)) == {7: 34}


def test_frequent_keys_of_an_aggregate_count_its_rows(spark):
    counts = spark.createDataFrame([("x", 900), ("y", 1), (None, 99)], "k string, n long")
    assert hot(op.frequent_keys(counts, "k", one_in=10, rows="n")) == {"x": 9}
    assert op.frequent_keys(counts.limit(0), "k", rows="n") is None


def test_frequent_keys_are_fixed_by_one_job(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"))
    with_shuffles = jobs_of(spark, lambda: op.frequent_keys(df, "k"))
    # One action; adaptive execution may submit each of its shuffles as a job.
    assert with_shuffles <= 4
    assert jobs_of(spark, lambda: op.frequent_keys(df.withColumn("l", F.col("k")), ["k", "l"])) <= with_shuffles
    plan = op.frequent_keys(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Range" not in plan


def test_rows_added_in_between_lose_no_match(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select(F.lit("hot").alias("k"), "id").write.parquet(path)
    df, dim = spark.read.parquet(path), spark.createDataFrame([("hot", 1), ("new", 2)], "d string, x int")
    keys = op.frequent_keys(df, "k")
    extra = spark.range(5000).select(F.when(F.col("id") < 4000, "new").otherwise("hot").alias("k"), "id")
    extra.write.mode("append").parquet(path)
    joined = op.salted_left_join(spark.read.parquet(path), dim, "k", "d", keys)
    assert Counter(r["x"] for r in joined.collect()) == {1: 2000, 2: 4000}


def test_long_contract_list_measures_the_list_only(spark, tmp_path):
    root = str(tmp_path)
    for name, rows in ROWS.items():
        frame(spark, name, rows).write.parquet(f"{root}/{name}.parquet")
    ledger = Ledger.at(spark, root, suffix=".parquet")
    for name in ROWS:
        ledger[name]  # opened: reading a footer is a job too
    built = jobs_of(spark, lambda: contract_list(ledger, SNAPSHOT, max_broadcast_keys=0))
    # The length of the list, the length of the banks, and both keys' counts.
    assert built <= 9


@pytest.fixture
def large(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for s in names:
        spark.conf.set(s, "-1")
    yield
    for s in names:
        spark.conf.unset(s)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_left_join_many_spreads_null_and_hot_keys(spark, large, adaptive):
    n = 9000
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id"
    )
    right = spark.range(0, n, 2).select(F.col("id").alias("k"), F.lit("r").alias("r"))
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = op.left_join_many(left, right, "k")
        expected = left.join(right, "k", "left")
        assert Counter(map(tuple, joined.select("k", "id", "r").collect())) == Counter(
            map(tuple, expected.select("k", "id", "r").collect())
        )
        # The rows of key -1 match nothing, so they all come out of the join with the right keys.
        unmatched = joined.where("k = -1").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in unmatched) == n // 3
        assert max(r["count"] for r in unmatched) < 0.6 * n // 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_names_become_a_relation(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("acc_no"))
    few, many = ["7", "8"], [str(i) for i in range(2000)]
    assert named(df, few).count() == 2 and named(df, many).count() == 2000
    plan = lambda names: named(df, names)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan(few) and "BroadcastHashJoin" in plan(many)


def test_delinquency_by_names_and_by_relation(spark):
    ledger = books(spark)
    everyone = by_account(delinquency_report(ledger))
    some = sorted(everyone)[:2]
    listed = spark.createDataFrame([(a,) for a in [*some, "unknown", None, some[0]]], "acc_no string")
    expected = {a: everyone[a] for a in some}
    assert by_account(delinquency_report(ledger, some)) == expected
    assert by_account(delinquency_report(ledger, listed)) == expected


def test_a_listed_relation_filters_the_scans(spark, large):
    listed = spark.createDataFrame([("v1",)], "acc_no string")
    text = delinquency_report(books(spark), listed)._jdf.queryExecution().executedPlan().toString()
    assert text.count("LeftSemi") == 4


def test_covers_most_plans_without_a_filter(spark, large):
    from books import AS_OF

    ledger = books(spark)
    run = lambda hint: debt_report(ledger, AS_OF, SNAPSHOT, covers_most=hint)
    assert by_account(run(True)) == by_account(run(False))
    text = run(True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in text


def test_settings_are_those_of_the_session(spark):
    for key, value in settings(partitions=4).items():
        assert spark.conf.get(key) == value


def test_decode_without_labels(spark):
    from debtlens.functions import decode

    df = spark.range(1).select(decode("id", {}, "none").alias("a"), decode("id", {}, F.col("id")).alias("b"))
    assert tuple(df.first()) == ("none", 0)
