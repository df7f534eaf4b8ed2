"""New OCR files as they arrive: each batch runs the batch operators for its documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, stage: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Run `stage` on each batch of JSON rows under `source` and write its rows under `target`, a folder for each batch.

    A batch that is run again replaces its own folder, so that a lost driver leaves nothing twice.
    Readers take a document's rows from its latest batch (see latest).
    """

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return spark.readStream.schema(schema).json(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(rows: DataFrame) -> DataFrame:
    """Of documents that came in several batches, the rows of the last."""
    last = rows.groupBy("doc_id").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["doc_id", "batch"]).drop("batch")
