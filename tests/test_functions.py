import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from debtlens import functions as fn


def column(spark, values, kind, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def one(spark, values, kind, aggregate):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return df.agg(aggregate.alias("y")).first().y


def test_like_underscore_is_a_wildcard(spark):
    assert column(spark, ["FIX_LES", "FIXxLES", "FIXLES", None], "string", fn.like_any("x", ["%FIX_LES%", "%Z%"])) == [
        True, True, False, None,
    ]


def test_unlike_is_true_for_null_and_empty(spark):
    assert column(spark, [None, "", "a", "b"], "string", fn.unlike("x", "%a%")) == [True, True, False, True]


def test_empty_string_is_not_null(spark):
    assert column(spark, [None, ""], "string", fn.nvl("x", "z")) == ["z", ""]


def test_differs_reads_null_as_default(spark):
    assert column(spark, [None, "N", "Y"], "string", fn.differs("x", "Y", "N")) == [True, True, False]


def test_before_excludes_the_day_itself(spark):
    days = [datetime.datetime(2026, 1, 23, 23, 59), datetime.datetime(2026, 1, 24), None]
    expected = [True, False, None]
    assert column(spark, days, "timestamp_ntz", fn.before("x", datetime.date(2026, 1, 24))) == expected
    late = datetime.datetime(2026, 1, 24, 18)
    assert column(spark, days, "timestamp_ntz", fn.before("x", late)) == expected


def test_decode_sends_null_and_unknown_to_the_default(spark):
    labels = fn.decode("x", {"00": "zero", "01": "one"}, "unknown")
    assert column(spark, ["00", "01", "1", None], "string", labels) == ["zero", "one", "unknown", "unknown"]


def test_missing_flag(spark):
    assert column(spark, [None, 1], "int", fn.missing_flag("x")) == ["X", ""]
    assert column(spark, [None, 1], "int", fn.missing_flag("x", blank=None)) == ["X", None]


def test_add0_ignores_nulls_and_keeps_cents(spark):
    values = [Decimal("0.10"), None]
    added = fn.total(fn.add0("x", F.lit(Decimal("0.20")), F.lit(None).cast("decimal(18,2)")))
    assert column(spark, values, "decimal(18,2)", added) == [Decimal("0.30"), Decimal("0.20")]


def test_sums(spark):
    amounts = [Decimal(-3), Decimal(5), None, Decimal(-4)]
    assert one(spark, amounts, "decimal(18,2)", fn.neg_total("x")) == 7
    assert one(spark, [None, Decimal(2)], "decimal(18,2)", fn.neg_total("x")) == 0
    assert one(spark, amounts, "decimal(18,2)", fn.sum_where("x", F.col("x") > 100)) is None


def test_count_where_does_not_count_null(spark):
    assert one(spark, [1, None, 3], "int", fn.count_where(F.col("x") > 1)) == 1


@pytest.mark.parametrize(
    "versions, expected", [([1, 2], 2), ([2], 2), ([1], 1), ([3], 1), ([None], 1), ([None, 2], 2)]
)
def test_preferred_version(spark, versions, expected):
    assert one(spark, versions, "int", fn.preferred_version("x")) == expected


def test_latest_by_ranks_null_highest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 9, 20), ("b", 5, 1), ("b", None, 7), ("c", 3, 4), ("c", 3, 6), ("d", 9, None)],
        "k string, period int, amount int",
    )
    latest = df.groupBy("k").agg(fn.latest_by("amount", ["period"], tiebreak=["amount"]).alias("y"))
    assert {r.k: r.y for r in latest.collect()} == {"a": 20, "b": 7, "c": 6, "d": None}
    even = fn.latest_by("amount", ["period"], tiebreak=["amount"], where=F.col("period") < 9)
    some = df.groupBy("k").agg(even.alias("y"))
    assert {r.k: r.y for r in some.collect()} == {"a": 10, "b": 1, "c": 6, "d": None}


def test_latest_by_needs_a_tiebreak(spark):
    with pytest.raises(ValueError):
        fn.latest_by("x", ["y"], tiebreak=[])
