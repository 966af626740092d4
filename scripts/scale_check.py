"""Distinct plan vs row plan on a larger table shaped like the reference's batch data.

Usage: python scripts/scale_check.py [rows] [cpus]   (default 20,000,000 rows, 8 cores)

Writes ``synthetic_batch`` (50 departments, 10,000 VINs) below the session's
checkpoint folder once, then times ``pseudonymize(..., strategy=...)`` to the
``noop`` sink: 'auto' (distinct plan here) twice, then 'row'. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cloakline.plans.registered import KR  # noqa: E402
from cloakline.operators.table import pseudonymize  # noqa: E402
from cloakline.session import local_session, scratch_path  # noqa: E402
from cloakline.sources.datagen import synthetic_batch  # noqa: E402


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = local_session(cpus, app="cloakline-scale")
    kr = KR
    path = scratch_path(spark, "scale-batch")
    synthetic_batch(spark, rows, partitions=4 * int(cpus)).write.parquet(path)
    df = spark.read.parquet(path)
    out: dict[str, float] = {}
    for name, strategy in (("distinct_cold", "distinct"), ("distinct_warm", "distinct"), ("row", "row")):
        t0 = time.perf_counter()
        pseudonymize(df, "vin", kr, strategy=strategy).write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t0, 2)
    print(json.dumps({"rows": rows, "cpus": cpus, "seconds": out}))
    spark.stop()


if __name__ == "__main__":
    main()
