"""Seconds per headline query on the star-schema tables; prints one JSON line.

BENCH_SF_DIR names the folder, BENCH_CPUS the local threads, BENCH_KEYS some queries instead of all.  Every result is
computed in full and thrown away.  Each query runs twice and the second time
counts, so that session start and code generation are left out.  The value is the sum of the first round's
21 queries, so that rounds can be compared; later ones are listed, too.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from marquee.starschema.queries import QUERIES

#: The first round's keys, whose sum is reported on its own, and those added later.
FIRST_ROUND = [
    "genre_consistency",
    "director_consistency",
    "writer_consistency",
    "audience_preferences_by_genre",
    "format_comparison",
    "genre_popularity",
    "genre_trends",
    "emerging_declining_genres",
    "genre_popularity_by_region",
    "ratings_by_region",
    "rating_histogram",
    "rating_boxplot_by_title_type",
    "runtime_perception",
    "collaboration_network",
    "multi_role_people",
    "crew_contribution",
    "director_writer_performance",
    "similar_items_topk",
    "genre_embeddings",
    "als_scores",
    "hybrid_recommend",
]
LATER = [
    "rating_prediction",
    "title_recommendations",
    "similar_titles_topk",
    "table_schemas",
    "similar_items_lsh",
    "embedding_correlation",
    "price_quantile_sketches",
    "rating_density",
    "ingest_rejects",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    wanted = [n for n in os.environ.get("BENCH_KEYS", "").split(",") if n] or FIRST_ROUND + LATER
    for name in wanted:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.get(name, 0.0) for name in FIRST_ROUND), 3),
                "value_of_all": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
