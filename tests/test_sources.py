import datetime

import pytest

from books import ROWS, SNAPSHOT, books, by_account, frame
from debtlens import measures as m
from debtlens.plans import debt_report
from debtlens.sources import RELATIONS, Ledger, load_relation, normalize, write_report


def test_sixteen_relations():
    assert len(RELATIONS) == 16 and all(r.key in r.columns for r in RELATIONS.values())


def test_source_spellings_are_normalized(spark):
    raw = spark.sql("SELECT 17 AS ACCOUNT_NO, timestamp_ntz'2026-01-01' AS CAL_DATE, 'x' AS other")
    log = normalize(raw, "dms_log_cal")
    assert log.dtypes == [("acc_no", "string"), ("cal_date", "timestamp_ntz")]
    assert log.first().acc_no == "17"


def test_a_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="cal_date"):
        normalize(spark.sql("SELECT 'a' AS acc_no"), "dms_log_cal")


def test_ledger_at_a_path(spark, tmp_path):
    for name, rows in ROWS.items():
        frame(spark, name, rows).write.parquet(f"{tmp_path}/{name}.parquet")
    stored = debt_report(Ledger.at(spark, str(tmp_path)), SNAPSHOT, SNAPSHOT)
    assert by_account(stored) == by_account(debt_report(books(spark), SNAPSHOT, SNAPSHOT))


def test_ledger_in_a_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ledger_tables")
    frame(spark, "rdbbank", ROWS["rdbbank"]).write.saveAsTable("ledger_tables.rdbbank", mode="overwrite")
    assert load_relation(spark, "ledger_tables", "rdbbank").count() == 3


def test_a_dated_relation_stored_by_day_is_pruned(spark, tmp_path):
    ktb = frame(spark, "mv_ktb_day", ROWS["mv_ktb_day"])
    ktb.write.partitionBy("snapshot_date").parquet(f"{tmp_path}/mv_ktb_day")
    stored = Ledger.at(spark, str(tmp_path), suffix="")["mv_ktb_day"]
    balances = m.snapshot_balances(stored, SNAPSHOT)
    assert [r.o_bs_lawyer_fee for r in balances.collect()] == [5]
    text = balances._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in text


def test_reports_are_written(spark, tmp_path):
    df = spark.createDataFrame([("a", datetime.date(2026, 1, 1))], "`ข้อมูล ณ` string, d date")
    write_report(df, f"{tmp_path}/p")
    write_report(df, f"{tmp_path}/c", "csv")
    assert spark.read.parquet(f"{tmp_path}/p").collect() == df.collect()
    assert spark.read.csv(f"{tmp_path}/c", header=True).columns == df.columns
    with pytest.raises(ValueError):
        write_report(df, f"{tmp_path}/x", "xlsx")
