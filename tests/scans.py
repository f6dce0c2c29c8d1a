"""Table scans of finished Spark executions, read from the event log."""
from __future__ import annotations

import json
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

_SQL = "org.apache.spark.sql.execution.ui."


def _scans(plan: dict) -> list[str]:
    own = [plan["simpleString"]] if plan["nodeName"].startswith(("Scan parquet", "Scan csv", "Scan json",
                                                                 "Scan text")) else []
    return own + [s for child in plan["children"] for s in _scans(child)]


def scans_of(spark: SparkSession, work: Callable[[], object]) -> list[str]:
    """The file scans in the final plans of all that ``work`` executes.

    The session must write an event log; its marker execution tells where the work begins and ends.
    """
    def mark(name: str) -> None:
        spark.sparkContext.setJobDescription(name)
        spark.range(1).selectExpr("id + 1").collect()
        spark.sparkContext.setJobDescription(None)

    begin, end = f"begin {time.time_ns()}", f"end {time.time_ns()}"
    mark(begin)
    work()
    mark(end)
    folder = Path(spark.conf.get("spark.eventLog.dir").removeprefix("file://"))
    log = next(folder.glob(f"*{spark.sparkContext.applicationId}*"))
    for _ in range(100):
        text = log.read_text()
        if end in text:
            break
        time.sleep(0.1)
    plans: dict[int, dict] = {}
    inside = False
    for line in text.split("\n"):
        if not line.endswith("}"):
            continue
        event = json.loads(line)
        kind = event["Event"].removeprefix(_SQL)
        if kind == "SparkListenerSQLExecutionStart":
            if event["description"] == begin:
                inside = True
            elif event["description"] == end:
                break
        if inside and kind in (
                "SparkListenerSQLExecutionStart", "SparkListenerSQLAdaptiveExecutionUpdate"):
            plans[event["executionId"]] = event["sparkPlanInfo"]
    return [s for plan in plans.values() for s in _scans(plan)]


def main(tables: str, work: str) -> None:
    """Print the number of scans of a report, the gate and the job on small tables, as JSON."""
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tablewarden.plans.catalog import QUERIES
    from tablewarden.plans.jobs import gate_job
    from tablewarden.plans.profile import build_report
    from tablewarden.sources.csv import write_csv

    os.makedirs(f"{work}/events")
    conf = {
        "spark.master": "local[4]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC",
        "spark.checkpoint.dir": f"file://{work}/shared", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{work}/events", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.buffer.kb": "1k",
    }
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def report() -> None:
        for table in build_report(spark.read.parquet(f"{tables}/lineitem.parquet")).tables.values():
            table.write.format("noop").mode("overwrite").save()

    write_csv(spark.read.parquet(f"{tables}/orders.parquet"), f"{work}/orders")
    counts = {
        "report": len(scans_of(spark, report)),
        "gate_summary": len(scans_of(spark, lambda: QUERIES["gate_summary"](spark, tables).collect())),
        "gate_job": len(scans_of(
            spark, lambda: gate_job(spark, f"{work}/orders", f"{work}/out", kind="csv"))),
    }
    left = [str(p) for p in Path(f"{work}/shared").rglob("*.parquet")]
    print("\n" + json.dumps(counts | {"left": left}))
    spark.stop()


if __name__ == "__main__":
    import sys as _sys

    main(*_sys.argv[1:])
