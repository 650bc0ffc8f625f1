"""The relations derived from generated tables."""

import datetime
import re
from types import SimpleNamespace

from checks.derived import DERIVATIONS, ledger

LINES = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
DAY = datetime.datetime(1998, 1, 1)


def tables(spark):
    rows = [
        (1, 1, 2.005, 0.1, 0.04, 0.01, "A", "O", DAY),
        (1, 2, 7.0, 0.2, 0.005, 0.02, "N", "O", DAY),
        (1, 2, 7.0, 0.2, 0.005, 0.02, "N", "O", DAY),
        (1, 3, None, -1.015, -0.125, None, "N", "F", DAY),
        (1, 4, 1.0, 9007199254740993.25, 0.0, 0.3, "R", "O", DAY),
        (1, 5, 1.0, 98765432109876.543, None, 0.4, None, None, DAY),
        (2, 1, None, None, None, None, "A", "O", DAY),
        (None, 1, 3.0, 5.555, 0.1, 0.1, "A", "F", DAY),
        (None, 7, 4.0, 1.0, 0.2, 0.2, "N", "O", DAY),
    ]
    return SimpleNamespace(spark=spark, lineitem=spark.createDataFrame(rows, LINES))


def test_sums_in_cents_are_the_sums_of_amounts(spark):
    t = tables(spark)
    (derivation,) = DERIVATIONS["dms_trn_bill_summary"]
    plain = spark.sql(derivation.sql("{source}"), source=t.lineitem)
    quick = derivation.frame(t)
    assert quick.dtypes == plain.dtypes
    assert sorted(map(str, quick.collect())) == sorted(map(str, plain.collect()))
    assert plain.count() == 5


def test_bill_summary_sums_are_held_in_place(spark):
    text = ledger(tables(spark))["dms_trn_bill_summary"]._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    sums = re.findall(r"partial_sum\((.*?)\), partial_", text)
    assert sums and all("as bigint" in s for s in sums)
