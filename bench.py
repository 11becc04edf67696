"""Timings of all queries over the fixture tables.

Reads ``$BENCH_SF_DIR`` (default sf0.1), runs on ``local[$BENCH_CPUS]`` and prints one JSON
line.  Every query runs twice and the second, warm run counts.  ``variants`` compares the
implementations a setting can choose between; they are not part of the total.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from rankframe import fixtures as fx
from rankframe.checks import queries
from rankframe.functions.binning import quantile_bins
from rankframe.functions.hashing import concat_key, hash_mod
from rankframe.operators.quantiles import interior_fractions, quantile_boundaries
from rankframe.session import build_session, materialize

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    job()
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def variants(spark) -> dict[str, float]:
    """Choices measured on the whole interaction table, stored once."""
    rows = materialize(fx.interactions(spark, SF_DIR).repartition(int(CPUS)))
    names = list(fx.SPEC.numeric)
    fractions = interior_fractions(64)
    bounds = [
        r["bounds"] for r in quantile_boundaries(rows, names, 64).orderBy("pos").collect()
    ]
    packed = materialize(
        rows.select(F.array(*[F.coalesce(F.col(n), F.lit(0.0)).cast("float") for n in names]).alias("num"))
    )
    wide_bounds = (bounds * 24)[:185]
    wide = packed.select(F.slice(F.flatten(F.array_repeat("num", 24)), 1, 185).alias("num"))
    wide = materialize(wide.repartition(int(CPUS)))
    key = concat_key(F.col("unified_buyer_id"), F.col("product_id"), F.col("event_timestamp_day"))
    exact = F.array(*[F.lit(f) for f in fractions])
    jobs = {
        "quantiles_counting": lambda: quantile_boundaries(rows, names, 64).collect(),
        "quantiles_percentile": lambda: rows.agg(*[F.percentile(n, exact) for n in names]).collect(),
        "bins_8": lambda: run(packed.select(quantile_bins(F.col("num"), bounds))),
        "bins_185": lambda: run(wide.select(quantile_bins(F.col("num"), wide_bounds))),
        "hash_xxhash64": lambda: run(rows.select(hash_mod(key, 1_000_000, "xxhash64"))),
        "hash_md5": lambda: run(rows.select(hash_mod(key, 1_000_000, "md5"))),
    }
    return {name: timed(job) for name, job in jobs.items()}


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: timed(lambda q=query: run(q(spark, SF_DIR))) for name, query in queries().items()}
    compared = {} if os.environ.get("BENCH_SKIP_VARIANTS") else variants(spark)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "variants": compared,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
