"""Run the long-list reports on a ledger ten times as large, with a third of it on one key.

    python skewed_run.py [sf] [copies]

The derived ledger of ``/root/testdata/sf<sf>`` is copied, every copy with accounts of its own,
and written as Parquet to a new temporary folder; in the skewed variant a third of the list, the
view and the contracts belong to one person, and a third of the bills, plan rows and ledger
entries to one account. Each report runs once on either. For every stage of four tasks or more
the event log gives the records that its largest and its median task read.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path
from statistics import median

from pyspark.sql import functions as F

from checks.derived import AS_OF, DERIVATIONS, SNAPSHOT_DATE, ledger
from checks.registry import Tables
from compare import TESTDATA, session
from debtlens.plans import audit_missing, contract_list, debt_report, delinquency_report
from debtlens.sources import Ledger

REPORTS = {
    "debt": lambda books: debt_report(books, AS_OF, SNAPSHOT_DATE, max_broadcast_keys=0),
    "contract": lambda books: contract_list(books, SNAPSHOT_DATE, max_broadcast_keys=0),
    "audit": lambda books: audit_missing(books, SNAPSHOT_DATE, max_broadcast_keys=0),
    "delinquency": delinquency_report,
}
#: The key that a third of the rows of a relation gets.
SKEWED = {
    "list_acc_broken_contract": ("cid", "cif"),
    "mv_dms_acc_report": ("cid",),
    "contract": ("cid",),
    "dms_trn_bills": ("acc_no",),
    "dms_mst_installments": ("acc_no",),
    "account_statement": ("acc_no",),
    "dms_log_cal": ("acc_no",),
}


def write(spark, sf: str, copies: int, skewed: bool, root: str) -> Ledger:
    books = ledger(Tables(spark, f"{TESTDATA}/sf{sf}"))
    for name in DERIVATIONS:
        rows = books[name].withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        for key in {"acc_no", "cid", "cif"} & set(rows.columns):
            rows = rows.withColumn(key, F.concat(F.col(key), F.lit("-"), F.col("_copy")))
        if skewed:
            third = F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == 0
            for key in SKEWED.get(name, ()):
                rows = rows.withColumn(key, F.when(third, F.lit("1-0")).otherwise(F.col(key)))
        rows.drop("_copy").write.parquet(f"{root}/{name}.parquet")
    return Ledger.at(spark, root, suffix=".parquet")


def uneven(log: Path) -> list[tuple[int, int, int]]:
    """Stage, records of the largest task and of the median one, where the first is far larger."""
    records = defaultdict(list)
    for line in log.open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
            m = event["Task Metrics"]
            n = m["Input Metrics"]["Records Read"] + m["Shuffle Read Metrics"]["Total Records Read"]
            records[event["Stage ID"]].append(n)
    found = ((stage, max(n), int(median(n))) for stage, n in records.items() if len(n) >= 4)
    return [x for x in found if x[1] > 1.5 * x[2] + 1000]


def main(sf: str = "0.1", copies: str = "10") -> None:
    folder = Path(tempfile.mkdtemp(prefix="skewed-run-"))
    (folder / "events").mkdir()
    spark = session(
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4m",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{folder}/events",
            "spark.eventLog.compress": "false",
        }
    )
    for kind in ("even", "skewed"):
        books = write(spark, sf, int(copies), kind == "skewed", f"{folder}/{kind}")
        for name, report in REPORTS.items():
            start = time.perf_counter()
            report(books).write.format("noop").mode("overwrite").save()
            print(f"{kind} {name}: {time.perf_counter() - start:.1f} s", flush=True)
    spark.stop()
    for log in sorted((folder / "events").rglob("*")):
        if log.is_file() and not log.name.endswith(".crc") and "appstatus" not in log.name:
            print("stage, largest task, median task:", uneven(log) or "none uneven")


if __name__ == "__main__":
    main(*sys.argv[1:])
