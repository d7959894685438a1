"""Import by unseen hash as files arrive: the append build of the manifest, run per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def unseen(batch: DataFrame, known: DataFrame, key: str, position: str) -> DataFrame:
    """First row of every key that the register does not hold yet."""
    fresh = batch.join(known.select(key), key, "left_anti")
    return fresh.groupBy(key).agg(F.min_by(F.struct(*[c for c in batch.columns if c != key]), position).alias("r")).select(key, "r.*")


def import_stream(source: DataFrame, register: str, checkpoint: str, key: str = "sha256", position: str = "path") -> StreamingQuery:
    """Append rows with new keys to the parquet table ``register``; stops when the input is drained.

    A repeated batch finds its own rows in the register and adds nothing, so the table
    stays exact when a batch is run again after a failure.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        known = batch.sparkSession.read.schema(batch.schema).parquet(register)
        unseen(batch, known, key, position).select(*batch.columns).write.mode("append").parquet(register)

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
