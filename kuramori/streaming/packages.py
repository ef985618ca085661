"""New delivery folders as a stream: each new file is read once, cleaned and appended to its layer, exactly once per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def ingest_available(spark: SparkSession, folder: str, schema: StructType, target: str, checkpoint: str, keys: list[str], clean: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Process the files that arrived since the last run and stop. A repeated batch replaces its own output (the batch number is a
    partition), and rows already delivered in earlier batches are left out by an anti-join on the keys."""

    def append(batch: DataFrame, number: int) -> None:
        rows = clean(batch).dropDuplicates(keys)
        try:
            known = spark.read.parquet(target).filter(f"batch <> {int(number)}").select(*keys)
            rows = rows.join(known, keys, "left_anti")
        except Exception as e:  # nothing has been written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        rows.write.mode("overwrite").parquet(f"{target}/batch={int(number)}")

    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
