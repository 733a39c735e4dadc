"""Incremental ingest as Structured Streaming.

"Re-run and skip what exists" becomes a file stream: each run picks up only
new files of the source (the checkpoint remembers what was read), the batch
is anti-joined against the ledger of paths already ingested, and the new
rows plus their ledger entries are written by ``foreachBatch``. A replayed
batch (after a failure) rewrites the same ``batch_id`` partition (query id
and batch number), so output
and ledger stay exactly-once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _ledger(spark: SparkSession, ledger_path: str, batch_id: str) -> DataFrame:
    """Keys ingested by other batches (a replayed batch must not see its own
    entries from a failed attempt). Only a ledger that is not there yet counts
    as empty; one that can't be read fails the batch."""
    if not _exists(spark, ledger_path):
        return spark.createDataFrame([], T.StructType([T.StructField("_key", T.StringType())]))
    led = spark.read.schema("_key string, batch_id string").parquet(ledger_path)
    return led.where(F.col("batch_id") != batch_id).select("_key")


def ingest_stream(spark: SparkSession, src: str, schema: T.StructType, checkpoint: str, out: str, ledger: str,
                  key: str = "path", fmt: str = "parquet", stage: str = "ingest"):
    """Run one incremental pass (``availableNow``) and return the finished
    query. ``key`` identifies an item (cast to string in the ledger)."""

    def write_batch(batch: DataFrame, number: int) -> None:
        # numbers restart at 0 with a new checkpoint; the query's id does not repeat
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch_id = f"{query}-{number}"
        keyed = batch.withColumn("_key", F.col(key).cast("string"))
        seen = _ledger(spark, ledger, batch_id)
        new = keyed.join(seen, "_key", "left_anti").dropDuplicates(["_key"])
        new = new.withColumn("batch_id", F.lit(batch_id))
        (new.drop("_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(out))
        entries = new.select(
            F.lit(stage).alias("stage"), F.col("_key"), F.lit("success").alias("status"),
            F.lit(None).cast("string").alias("reason"), "batch_id",
        )
        entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(ledger)

    stream = spark.readStream.format(fmt).schema(schema).load(src)
    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def ingest_once(spark: SparkSession, src: str, schema: T.StructType, checkpoint: str, out: str, key: str = "path", fmt: str = "parquet",
                time: str | None = None, expire: str | None = None):
    """S1 with the ledger as streaming state: one incremental pass
    (``availableNow``) over the new files of ``src``, in which the state store
    drops keys that an earlier row, batch or run has had. The state is dealt
    by key and lives in ``checkpoint`` (a shared folder), so a batch looks up
    its own keys and reads no ledger, whatever that holds.

    With ``expire`` keys are forgotten that much after the event time
    ``time``, which bounds the state; without it they are kept for good.
    Output rows are written by batch (``batch_id=<n>``), so that a batch
    replayed after a failure replaces what it had written. Rows without a key
    count as one. Returns the finished query."""
    stream = spark.readStream.format(fmt).schema(schema).load(src)
    if expire:
        if not time:
            raise ValueError("expiry needs an event-time column")
        fresh = stream.withWatermark(time, expire).dropDuplicatesWithinWatermark([key])
    else:
        fresh = stream.dropDuplicates([key])

    def write_batch(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(number).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    # local to this query: the state store that keeps its keys on disk, not in the heap
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = stream_writer(fresh, write_batch, checkpoint)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    query.awaitTermination()
    return query


def stream_writer(rows: DataFrame, write_batch, checkpoint: str):
    return (rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
