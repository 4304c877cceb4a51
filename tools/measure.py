"""Median seconds and shuffle bytes of jobs as a table: ``python tools/measure.py [sf_dir] [name ...]``."""

from __future__ import annotations

import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from kgloom.registry import JOBS  # noqa: E402
from kgloom.session import build_session  # noqa: E402

RUNS = 3


def shuffled(spark) -> int:
    """Bytes written to shuffles so far, over the stages the session still lists."""
    gateway = spark.sparkContext._gateway
    none = gateway.new_array(gateway.jvm.double, 0)
    empty = gateway.jvm.java.util.ArrayList()
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, empty)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.ui.retainedStages": "1000000",
        "spark.driver.memory": "16g",
    }
    spark = build_session("measure", "local[8]", **settings)
    spark.sparkContext.setLogLevel("OFF")
    print("| job | seconds | shuffle KB |\n|---|---|---|")
    for name in sys.argv[2:] or JOBS:
        times, size = [], 0
        for _ in range(RUNS + 1):
            before, start = shuffled(spark), time.perf_counter()
            JOBS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            size = shuffled(spark) - before
        print(f"| `{name}` | {statistics.median(times[1:]):.2f} | {size / 1024:,.0f} |", flush=True)


if __name__ == "__main__":
    main()
