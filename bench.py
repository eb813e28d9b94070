"""Wall time of the headline queries, as one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. The
sources and targets of the sync are written once per scale, outside the times, so
that a step or job is measured on stored tables, as it runs in production. Each query
is run in full into a sink that drops the rows; a step includes reading its sources
and staging its changes, a job its publishing. The first, unmeasured run of every query
on the smallest tables warms the JVM up. ``jobs`` counts the Spark jobs of each entry.
The ``upsert_*`` entries measure an upsert of region tracks at three sizes of change.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.queries import QUERIES, REGIONS, STEPS
from checks.standin import AS_OF, given, sources, targets
from tidemark.functions.dates import at
from tidemark.operators.apply import upsert
from tidemark.operators.changes import changed_since
from tidemark.plans.context import Run, Tables, same_named
from tidemark.plans.runner import sync_catalog, sync_rights
from tidemark.sources.catalog import load_sources
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.staging import Staging, shared_folder

OPERATORS = [
    "changed_scan",
    "changed_ids",
    "changed_or_child_changed",
    "semi_parent",
    "anti_no_rights",
    "lookup_one",
    "first_child",
    "top1_per_group",
    "multiway_join",
    "style_expansion",
    "upsert_orders",
    "upsert_composite_key",
    "update_if_exists",
    "split_rows",
    "text_before",
    "parse_client",
    "ingest_logins",
]
STEP_NAMES = [
    "artist_vnm",
    "album_vnm",
    "track_vnm",
    "track_local_vnm",
    "track_local_jpn",
    "lyrics_type_vnm",
    "track_style_vnm",
    "mv_vnm",
    "album_status_vnm",
    "track_rights_jpn",
]
JOBS = {
    "catalog_vnm": (sync_catalog, "vnm"),
    "catalog_generic": (sync_catalog, "generic"),
    "rights_jpn": (sync_rights, "jpn"),
}
# Share of the region tracks that changed, by a cut near the last order date.
CUTS = {"0.1pct": datetime(2001, 11, 2), "1pct": datetime(2001, 10, 10), "10pct": datetime(2001, 2, 27)}
WARM_DIR = "/root/testdata/sf0.001"


class Stored:
    """Stand-ins of one scale as parquet tables, and a store seeded with the targets."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
        for name, df in sources(spark, sf_dir).items():
            df.write.parquet(f"{self.root}/src/{name}")
        self.src: Tables = load_sources(spark, f"{self.root}/src")
        self.store = Snapshots(spark, f"{self.root}/tgt")
        self.store.seed(targets(spark, sf_dir))
        self.tgt: Tables = self.store.read(self.store.published()[1])

    def step(self, name: str) -> DataFrame:
        table, _, label = name.rpartition("_")
        step = next(s for n, s, _, _ in STEPS if n == table)
        return step(self.src, self.tgt, Run.start(self.spark, REGIONS[label], AS_OF))

    def job(self, name: str) -> None:
        run, label = JOBS[name]
        seeded = self.store.published()[1]
        fresh = Snapshots(self.spark, f"{self.root}/{name}-{uuid.uuid4().hex}")
        fresh.publish(seeded, 1)  # the same folders: a run writes beside them
        run(self.spark, self.src, fresh, REGIONS[label], AS_OF)

    def upsert(self, cut: datetime) -> DataFrame:
        dated = given(self.spark, self.sf_dir, "orders").select(F.col("o_orderkey").alias("track_id"), "o_orderdate")
        fresh = changed_since(dated, cut, ("o_orderdate",)).select(
            "track_id", F.lit("VNM").alias("local_cd"), F.col("o_orderdate").alias("crt_dt"), F.lit("OK").alias("status")
        )
        stage = Staging(self.spark)
        return upsert(
            self.tgt["track_local"],
            stage(fresh, "tracks"),
            ["track_id", "local_cd"],
            on_match=same_named("status") | {"upd_dt": at(cut)},
            on_insert=same_named("crt_dt", "status"),
            stage=stage,
        )


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def entries(data: Stored) -> dict[str, Callable[[], None]]:
    found = {n: lambda n=n: _run(QUERIES[n](data.spark, data.sf_dir)) for n in OPERATORS}
    found |= {f"sync_{n}": lambda n=n: _run(data.step(n)) for n in STEP_NAMES}
    found |= {n: lambda n=n: data.job(n) for n in JOBS}
    return found | {f"upsert_{size}": lambda cut=cut: _run(data.upsert(cut)) for size, cut in CUTS.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scheduler = spark._jsc.sc().dagScheduler()
    warm = WARM_DIR if Path(WARM_DIR).is_dir() else sf_dir
    for entry in entries(Stored(spark, warm)).values():
        entry()
    times, jobs = {}, {}
    for name, entry in entries(Stored(spark, sf_dir)).items():
        before, started = scheduler.numTotalJobs(), time.perf_counter()
        entry()
        times[name] = round(time.perf_counter() - started, 3)
        jobs[name] = scheduler.numTotalJobs() - before
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1).rstrip(".")) if scale else sf_dir,
                "jobs": jobs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
