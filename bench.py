"""Benchmark: the whole batch pipeline from text extracts, then every mart on the stored state.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from lettings import session  # noqa: E402
from lettings.catalog import queries, tables  # noqa: E402
from lettings.model import ENTITIES, ROW  # noqa: E402
from lettings.plans import marts, pipeline  # noqa: E402
from lettings.plans.state import StateStore  # noqa: E402
from lettings.sources.lake import Lake  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
LEGACY = (
    "legacy_q05",
    "legacy_q07",
    "legacy_q11",
    "legacy_q13",
    "city_price_correction",
    "reassign_agent",
    "overlapping_agreements",
    "free_house_assignment",
)


def noop(frame: object) -> None:
    frame.write.format("noop").mode("overwrite").save()


def write_extracts(spark, folder: str, parts: int) -> None:
    """Preparation, not timed: the raw tables as CSV and JSON Lines in source order."""
    for name, raw in tables.raw_batch(spark, FOLDER).items():
        ordered = raw.repartitionByRange(parts, ROW).sortWithinPartitions(ROW).drop(ROW)
        path = f"{folder}/{name}.{ENTITIES[name].extract}"
        if ENTITIES[name].extract == "csv":
            ordered.write.option("header", True).option("escape", '"').option(
                "ignoreLeadingWhiteSpace", False
            ).option("ignoreTrailingWhiteSpace", False).csv(path)
        else:
            ordered.write.json(path)


def main() -> None:
    root = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_WORK", "/tmp"))
    spark = session.build(
        f"local[{CPUS}]",
        **{
            "spark.checkpoint.dir": f"{root}/checkpoints",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    write_extracts(spark, f"{root}/source", int(CPUS))
    times: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object]) -> object:
        began = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - began, 3)
        return result

    first = timed(
        "pipeline_full",
        lambda: pipeline.run_batch(spark, f"{root}/source", root, batch_id="bench-full"),
    )
    timed(
        "pipeline_replay",
        lambda: pipeline.run_batch(spark, f"{root}/source", root, batch_id="bench-replay"),
    )
    state = StateStore(spark, Lake(root).state).read()
    models = pipeline.warehouse(state, tables.as_of())
    for name, frame in models.items():
        if name not in state:
            timed(name, lambda frame=frame: noop(frame))
    timed("payments_for_agreement", lambda: noop(marts.payments_for_agreement(state, "AGR-5001")))
    for name in LEGACY:
        timed(name, lambda name=name: noop(queries.QUERIES[name](spark, FOLDER)))
    records = first.counts["input_count"]
    print(
        json.dumps(
            {
                "metric": "pipeline_and_marts_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")),
                "records": records,
                "pipeline_records_per_sec": round(records / times["pipeline_full"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
