"""S1 as a checked query: the events of the given table arrive in three runs,
each of which brings back all rows of the runs before it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from voxtab.plans.registry import register
from voxtab.session import ensure_checkpoint_dir
from voxtab.sources.views import table
from voxtab.streaming.ingest import ingest_once

RUNS = 3


@register(
    "s1_ingest",
    f"SELECT event_id, user_id, CAST(event_id % {RUNS} AS BIGINT) AS batch_id FROM events",
)
def s1_ingest(spark, sf_dir):
    """Run ``k`` delivers the events of its third and, once more, those of the
    earlier runs; an event stays in the batch that first had it."""
    base = f"{ensure_checkpoint_dir(spark)}/voxtab-ingest-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    for run in range(RUNS):
        events.where(F.col("event_id") % RUNS <= run).write.mode("append").parquet(f"{base}/src")
        ingest_once(spark, f"{base}/src", events.schema, f"{base}/state", f"{base}/out", key="event_id")
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", F.col("batch_id").cast("bigint"))
