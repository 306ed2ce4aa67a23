"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times; the median counts. Every
row of the result is computed, in all columns, and thrown away. A query that
stages or stores tables does so in each run, within its time.

Names on the command line replace the headline list. ``snk5_export`` writes a folder
per species of a finished main run: on a local disk its time is that of creating
thousands of files.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from occflow.session import build_session  # noqa: E402
from occflow.sources import sinks  # noqa: E402
from verification import registry  # noqa: E402

HEADLINE = [
    "job1_extract_native",
    "job8_main_rmd",
    "job3_species_table",
    "stats_main",
    "job4_native_status",
    "job9_supplemental_rmd",
    "job10_unfiltered",
    "job12_flags",
    "job14_introduced",
    "val1_species_decade",
    "val2_null_obs",
    "val2_null_spp",
    "val6_conflicting",
    "val7j_species_country",
    "snk5_export",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def run(name: str) -> float:
        if name == "snk5_export":
            inputs = registry.Inputs(spark, sf_dir)
            observations, path = inputs.raw, inputs.stage.path("by_species")
            start = time.perf_counter()
            sinks.export_by_species(observations, path)
        else:
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
