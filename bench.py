"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from meadowlark import session  # noqa: E402
from meadowlark.plans import QUERIES  # noqa: E402

HEADLINE = [
    "rs_individual",
    "rs_sector",
    "rs_industry",
    "core_documents",
    "day_summary",
    "sma",
    "ema",
    "rrs",
    "buying_pressure",
    "asof_announcement",
    "fundamentals_merge",
    "market_transpose",
    "fill_only_merge",
    "freeze_plan_month",
    "coverage_symbol_year",
    "bars_5min",
]


def machine(spark, cpus: int) -> float:
    """Seconds of a job that has nothing to do with the library: what the machine is worth at the moment."""
    runs = []
    for _ in range(3):
        began = time.time()
        spark.range(0, 60_000_000, 1, cpus).selectExpr("bit_xor(xxhash64(id, id * 3)) as x").write.format("noop").mode("overwrite").save()
        runs.append(time.time() - began)
    return round(min(runs), 3)


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session.build("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    took, before = {}, machine(spark, int(cpus))
    for name in HEADLINE:
        runs = []
        for _ in range(2):  # the second has its code compiled
            began = time.time()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(min(runs), 3)
    after = machine(spark, int(cpus))
    spark.stop()
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf).name, "cpus": int(cpus), "machine_sec": [before, after]}))


if __name__ == "__main__":
    main()
