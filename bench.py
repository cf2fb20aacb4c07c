"""Time the headline queries; prints one JSON line.

Every query is fully computed and its rows discarded.  The text queries speed up severalfold while
the JVM compiles them, so ``BENCH_WARMUPS`` rounds of two of them run before the clock does; each
figure is the best of ``BENCH_RUNS``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import QUERIES  # noqa: E402
from workload.session import local_session  # noqa: E402

HEADLINE = (
    "values_by_year",
    "structure_types",
    "value_rows",
    "kv_nested",
    "split_documents",
    "split_pages",
    "year_extract",
    "date_normalize",
    "category_enrich",
    "enrich_summary",
    "refinement_summary",
    "multi_value_profile",
    "separator_census",
    "field_catalog",
    "missing_entities",
    "export_rows",
    "export_summary",
    "page_fields",
    "raw_documents",
    "refined_documents",
    "url_index",
    "mapping_extract",
    "snapshot_latest",
    "snapshot_diff",
    "snapshot_diff_fields",
    "quality_rules",
    "run_metadata",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session()
    for _ in range(int(os.environ.get("BENCH_WARMUPS", "1"))):
        run(spark, "values_by_year", sf_dir)
        run(spark, "raw_documents", sf_dir)
    seconds = {n: round(min(run(spark, n, sf_dir) for _ in range(runs)), 3) for n in names}
    fields = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "fields": fields,
                "refined_fields_per_second": round(
                    fields / seconds["structure_types"] if "structure_types" in seconds else 0
                ),
            }
        )
    )


if __name__ == "__main__":
    main()
