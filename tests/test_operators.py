from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from debtlens import operators as op
from debtlens.functions import count_where


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def skewed(spark, n=3000):
    """(k, v) rows of which a third have key 7, a ninth have none, and the rest spread out."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 9 == 1, None).otherwise(F.col("id") % 50 + 100)
    return spark.range(n).select(key.cast("int").alias("k"), F.col("id").alias("v"))


# ------------------------------------------------------------------- pick_one


def test_pick_one_is_independent_of_partitioning(spark):
    rows = [(i % 5, i % 3, i) for i in range(60)]
    results = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "k int, grade int, seq int").repartition(parts)
        picked = op.pick_one(df, ["k"], order=[F.col("grade").desc_nulls_last()], tiebreak=["seq"])
        results.append(bag(picked))
    best = {}
    for k, grade, seq in rows:
        best[k] = min(best.get(k, (9, 0)), (-grade, seq))
    assert results[0] == results[1] == Counter((k, -g, s) for k, (g, s) in best.items())


def test_pick_one_needs_a_tiebreak(spark):
    with pytest.raises(ValueError):
        op.pick_one(spark.range(1), ["id"])


def test_one_per_key_keeps_a_row_whole_and_drops_the_null_key(spark):
    df = spark.createDataFrame([("a", 2, 1), ("a", 1, 9), ("a", None, 0), (None, 1, 1)], "k string, x int, y int")
    assert bag(op.one_per_key(df, "k", ["x", "y"])) == Counter([("a", 1, 9)])


def test_distinct_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), (None, 1)], "k string, x int")
    assert bag(op.distinct_keys(df, "k", F.col("x") == 1)) == Counter([("a",)])


# ------------------------------------------------------------------- versions


def test_split_by_version_takes_a_version_from_one_row(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, 1), ("a", 1, 4, 9), ("a", 2, 7, None), ("b", 3, 1, 1), ("c", 1, None, 2)],
        "k string, ver int, x int, y int",
    )
    split = op.split_by_version(df, "k", "ver", ["x", "y"], extra={"top": F.max("ver")})
    assert split.columns == ["k", "top", "x_v1", "y_v1", "x_v2", "y_v2"]
    assert bag(split) == Counter(
        [("a", 2, 5, 1, 7, None), ("b", 3, None, None, None, None), ("c", 1, None, 2, None, None)]
    )


def test_picked_version_sums(spark):
    df = spark.createDataFrame(
        [("a", 1, True, 1), ("a", 1, False, 2), ("b", 1, True, 4), ("b", 2, True, 8), ("b", 2, True, None),
         ("c", 1, True, 16), ("c", 2, False, 32), ("d", 1, True, None), ("e", 3, True, 64)],
        "k string, ver int, ok boolean, x int",
    )
    sums = op.picked_version_sums(df, "k", "ver", {"s": "x"}, F.col("ok"))
    assert bag(sums) == Counter([("a", 1), ("b", 8), ("d", 0)])


# ---------------------------------------------------------- totals and salting


def test_count_over_equals_an_unordered_window(spark):
    df = skewed(spark)
    over = op.count_over(df, "k", F.col("v") % 2 == 0, "n")
    rows = [(r.k, r.v) for r in df.collect()]
    totals = defaultdict(int)
    for k, v in rows:
        totals[k] += v % 2 == 0
    assert bag(over) == Counter((k, v, totals[k]) for k, v in rows)


@pytest.mark.parametrize("one_in", [4, 10, 1000])
def test_salted_join_equals_a_plain_join(spark, one_in):
    df = skewed(spark)
    dim = spark.createDataFrame([(7, "hot"), (100, "x"), (101, "y"), (999, "unused")], "d int, name string")
    hot = op.frequent_keys(df, "k", one_in)
    salted = op.lookup(df, dim, "k", "d", ["name"], hot)
    assert bag(salted) == bag(op.lookup(df, dim, "k", "d", ["name"]))
    null_safe = op.salted_left_join(df, dim.unionByName(spark.sql("SELECT CAST(NULL AS INT) AS d, 'none' AS name")),
                                    "k", "d", hot)
    names = {7: "hot", 100: "x", 101: "y", None: "none"}
    assert bag(null_safe.select("k", "v", "name")) == Counter(
        (r.k, r.v, names.get(r.k)) for r in df.collect()
    )


def test_frequent_keys_hold_more_than_their_share(spark):
    def keys(one_in):
        return {r[0] for r in op.frequent_keys(skewed(spark), "k", one_in).collect()}

    assert keys(4) == {7} and keys(10) == {7, None}
    pieces = {r["_hot_key"]: r["_salts"] for r in op.frequent_keys(skewed(spark), "k", 10).collect()}
    assert pieces == {7: 4, None: 2}
    assert op.frequent_keys(skewed(spark), "k", 3) is None  # exactly a third is not over a third
    assert op.frequent_keys(skewed(spark).where("false"), "k") is None


def test_a_hot_key_is_spread_over_salts(spark):
    df = skewed(spark)
    dim = spark.createDataFrame([(7, "hot")], "d int, name string")
    joined = op.salted_left_join(df, dim, "k", "d", op.frequent_keys(df, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = (
            op.salted_left_join(df, dim, "k", "d", op.frequent_keys(df, "k"))
            .where("k = 7")
            .groupBy(F.spark_partition_id())
            .count()
            .collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert joined.where("k = 7").count() == 1000
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 500


# ----------------------------------------------------------------------- rows


@pytest.mark.parametrize("chunk", [1, 3, 10, 100])
def test_repeat_rows(spark, chunk):
    df = spark.createDataFrame([("a", 1), ("b", 10), (None, 7)], "k string, n bigint")
    assert bag(op.repeat_rows(df, "n", chunk)) == Counter({("a",): 1, ("b",): 10, (None,): 7})


def test_multiplicity_is_the_size_of_the_fan_out(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    bills = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    plans = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    joined = left.join(bills, "k", "left").join(plans, "k", "left").groupBy("k").count()
    counts = [d.groupBy("k").agg(F.count("k").alias(n)) for d, n in ((bills, "nb"), (plans, "np"))]
    counted = op.assemble(left, counts, "k").select("k", op.multiplicity("nb", "np"))
    assert bag(joined) == bag(counted) == Counter([(1, 6), (2, 1), (3, 1)])


# ---------------------------------------------------------------------- joins


def test_left_join_many_equals_a_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k int, x string")
    right = spark.createDataFrame([(1, 5), (1, 6), (3, 7), (None, 8)], "k int, y int")
    assert bag(op.left_join_many(left, right, "k")) == bag(left.join(right, "k", "left"))


def test_left_join_where_keeps_left_rows(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, ver int")
    assert bag(op.left_join_where(left, right, "k", F.col("ver") == 2)) == Counter([(1, 2), (2, None)])


def test_chain_left_loses_later_hops_with_the_first(spark):
    base = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    first = spark.createDataFrame([(1, 10), (None, 20)], "id int, next int")
    second = spark.createDataFrame([(10, "x"), (20, "y")], "id int, name string")
    chain = op.chain_left(base, [(first, "k", "id", ["next"]), (second, "next", "id", ["name"])])
    assert bag(chain) == Counter([(1, 10, "x"), (2, None, None), (None, None, None)])


def test_assemble_refuses_a_column_in_two_parts(spark):
    a = spark.createDataFrame([(1, 2)], "k int, x int")
    with pytest.raises(ValueError):
        op.assemble(a, [a], "k")


def test_exists_any_is_all_or_nothing(spark):
    df = spark.range(3)
    keys = spark.createDataFrame([(None,), ("a",)], "k string")
    assert op.exists_any(df, keys, "k").count() == 3
    assert op.exists_any(df, keys.where("k IS NULL"), "k").count() == 0


def test_in_scope_keeps_multiplicity(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    scope = spark.createDataFrame([(1,), (1,), (None,)], "s int")
    assert bag(op.in_scope(facts, scope, "k", "s")) == Counter({(1,): 2})


@pytest.mark.parametrize("max_keys", [0, 100])
def test_scope_reduces_alike_in_both_orders(spark, max_keys):
    facts = spark.createDataFrame([("a", 1), ("a", 5), ("b", 7), (None, 9)], "acc_no string, x int")
    scope = op.Scope.of(spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "acc_no string"), max_keys=max_keys)
    assert scope.small == (max_keys > 0)
    top = scope.reduce(facts, lambda d: d.groupBy("acc_no").agg(F.max("x")))
    assert bag(top) == Counter([("a", 5)])


def test_driver_list(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "acc_no string, cid int, x int")
    assert bag(op.driver_list(df, ["acc_no", "cid"], ["b"])) == Counter([("b", 3)])
    assert op.driver_list(df, ["acc_no"], []).count() == 0


def test_labels_may_be_any_text(spark, tmp_path):
    label = "ยอดหนี้เงินต้นค้างชำระ (V1)"
    df = op.with_labels(spark.createDataFrame([(1,)], "x int"), {"x": label})
    df.write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).columns == [label]
    with pytest.raises(ValueError):
        op.with_labels(df, {"nope": "x"})


def test_fan_out_inflates_a_count_over_the_join(spark):
    """Two fined bills and two plan rows make four pairs; aggregating first keeps the two."""
    bills = spark.createDataFrame([("a", 1), ("a", 2)], "k string, fine int")
    plans = spark.createDataFrame([("a", 10), ("a", 20)], "k string, amount int")
    pairs = bills.join(plans, "k", "left")
    assert {r.n for r in op.count_over(pairs, "k", F.col("fine") > 0, "n").collect()} == {4}
    assert bills.groupBy("k").agg(count_where(F.col("fine") > 0)).first()[1] == 2
