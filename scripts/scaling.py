"""Scaling run: star build (fact_event) and the flat interactions with their summaries over k-times
replicated events. Copies get shifted event ids and keep users, campaigns and
times, so hot users and campaigns grow with k.

Usage: python scripts/scaling.py SF_DIR k1 k2 ...   (prints one JSON line per k)
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from adlens.operators.materialize import table_root  # noqa: E402
from adlens.operators.star import materialize_star  # noqa: E402
from adlens.plans.documents import engagement, user_summaries  # noqa: E402
from adlens.session import get_spark  # noqa: E402
from adlens.sources.fixtures import ad_staging, campaigns, users  # noqa: E402
from adlens.sources.tables import read_table  # noqa: E402


def main() -> None:
    sf_dir, ks = sys.argv[1], [int(k) for k in sys.argv[2:]] or [1, 10]
    spark = get_spark(app="adlens-scaling", master="local[8]", shuffle_partitions=16,
                      **{"spark.driver.memory": "16g"})
    events = read_table(spark, sf_dir, "events")
    span = events.agg(F.max("event_id")).first()[0] + 1
    spark.range(1).count()  # warm up
    for k in ks:
        rep = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).select(
            (F.col("event_id") + F.col("copy") * F.lit(span)).alias("event_id"),
            "ts", "user_id", "event_type", "value", "props")
        root = table_root(spark, "scaling", f"k{k}-{uuid.uuid4().hex[:8]}")
        t0 = time.perf_counter()
        star = materialize_star(spark, {
            "stg_ad_events": lambda: ad_staging(spark, sf_dir, events=rep), "stg_campaigns": lambda: campaigns(spark, sf_dir),
            "stg_users": lambda: users(spark, sf_dir)}, root)
        t_star = time.perf_counter() - t0
        n_fact = star.fact_event.count()
        t1 = time.perf_counter()
        e = engagement(star)
        e.interactions.repartitionByRange("user_id", "event_id").sortWithinPartitions("user_id", "event_id").write.parquet(f"{root}/interactions")
        user_summaries(e).write.parquet(f"{root}/summaries")
        t_docs = time.perf_counter() - t1
        print(json.dumps({"sf_dir": sf_dir, "k": k, "fact_rows": n_fact, "build_star_sec": round(t_star, 2),
                          "engagement_sec": round(t_docs, 2)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
