"""Benchmark the hourly batch and the conversion report.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Timed steps (each includes its Spark jobs end to end):

* ``pipeline_first_load``  - stage the four inputs from the driver tables and
  load all 14 vault tables into an empty parquet vault (batch 1);
* ``pipeline_next_batch``  - the next hourly run over the same source: every
  table checks its candidates against the stored history and appends nothing;
* ``group_conversion``     - the flagship report over the stored vault;
* ``group_conversion_single_plan`` - the flagship as one lazy plan straight
  from the driver tables (no stored vault), the shape of the baseline timing;
* ``audits``               - the four integrity audits over the stored vault.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vaultline.operators import audits  # noqa: E402
from vaultline.operators.store import Batch, ParquetVault  # noqa: E402
from vaultline.plans import marts  # noqa: E402
from vaultline.plans.pipeline import run_batch  # noqa: E402
from vaultline.plans.queries import group_conversion_single_plan  # noqa: E402
from vaultline.session import checkpoint_dir, local_session  # noqa: E402
from vaultline.sources.adapter import staging_from_driver_tables  # noqa: E402
from vaultline.sources.staging import read_staging  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
B1 = Batch(1, "2024-06-07 12:00:00")
B2 = Batch(2, "2024-06-07 13:00:00")


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=CPUS, driver_memory="16g")
    base = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="vaultline-bench-"))
    work = f"{base.rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
    staging_root, vault_root = f"{work}/staging", f"{work}/vault"

    # JVM and reader warm-up, not timed
    spark.read.parquet(f"{SF_DIR}/supplier.parquet").count()

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    source = staging_from_driver_tables(spark, SF_DIR)
    timed("pipeline_first_load", lambda: run_batch(
        spark, B1, staging_root=staging_root, vault_root=vault_root, frames=source))
    nxt = timed("pipeline_next_batch", lambda: run_batch(
        spark, B2, staging_root=staging_root, vault_root=vault_root, frames=source))
    assert all(n == 0 for n in nxt.vault.rows.values()), nxt.vault.rows

    vault = ParquetVault(spark, vault_root, cache_reads=True)
    rows = timed("group_conversion", lambda: marts.group_conversion(vault.table).collect())
    single = timed("group_conversion_single_plan",
                   lambda: group_conversion_single_plan(spark, SF_DIR).collect())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, single))

    staged = {n: read_staging(spark, staging_root, n) for n in source}
    timed("audits", lambda: audits.all_audits(staged, vault.table).collect())

    m = re.search(r"sf([0-9.]+)", SF_DIR)
    # Headline: the flagship rebuilt from the driver tables as one plan, the
    # same shape as the baseline's timing; everything else is in "queries".
    print(json.dumps({
        "metric": "group_conversion_single_plan",
        "value": times["group_conversion_single_plan"],
        "unit": "sec",
        "queries": times,
        "total_sec": round(sum(times.values()), 3),
        "sf": float(m.group(1)) if m else None,
        "cpus": CPUS,
    }))


if __name__ == "__main__":
    main()
