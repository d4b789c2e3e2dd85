"""New files to a stored table, once each.

The one incremental job is reading files that are not stored yet. A file stream with ``availableNow`` keeps the list of read
files in its checkpoint, so a lost executor or a stopped job repeats a batch
only, and keys that the table already has are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_new(spark: SparkSession, folder: str, schema: str, table: str, checkpoint: str, key: str,
               parse: Callable[[DataFrame], DataFrame], fmt: str = "parquet", options: dict[str, str] | None = None) -> int:
    """Reads the folder's new files, parses them and appends rows of new keys to ``table``; gives the number of batches."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = parse(batch).dropDuplicates([key])
        try:
            known = batch.sparkSession.read.parquet(table).select(key)
            rows = rows.join(known, key, "left_anti")
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
        rows.write.mode("append").parquet(table)

    stream = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(folder)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(query.recentProgress)


def ingest_keyed(spark: SparkSession, folder: str, schema: str, table: str, checkpoint: str, key: str,
                 parse: Callable[[DataFrame], DataFrame], fmt: str = "parquet", options: dict[str, str] | None = None) -> int:
    """As ``ingest_new`` with the known keys in the stream's state; gives the number of batches.

    The state store holds a row a key, in partitions by its hash, and its changes
    go to the checkpoint batch by batch, so a batch reads its own rows only,
    never the table. The sink's log names the files of whole batches: a batch
    that was cut short is run again and its first files count for nothing. The
    table must have been written by this stream alone; rows without a key are
    left out; of the rows of one key in a batch any may be kept.
    """
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(folder)
        rows = parse(stream).where(F.col(key).isNotNull()).dropDuplicates([key])
        query = rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(provider, before)
    query.awaitTermination()
    return len(query.recentProgress)
