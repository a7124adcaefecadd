"""Micro-batch loading of new source files into the raw table, and keeping the fact current with them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from checkmart.schemas import SOURCE_CHECKS
from checkmart.session import written
from checkmart.sources.incremental import run_extract
from checkmart.vocabulary import CHECK_SOURCE_NAME

Transform = Callable[[DataFrame], DataFrame]


def stream_incremental_load(
    spark: SparkSession,
    source_glob: str,
    root: str,
    checkpoint: str,
    schema: T.StructType = SOURCE_CHECKS,
    transform: Transform | None = None,
    on_batch: Callable[[SparkSession, dict[str, int]], None] | None = None,
    name: str = CHECK_SOURCE_NAME,
) -> StreamingQuery:
    """Load every new source file into the raw table under `root` once, then stop.

    Each micro-batch is an ordinary extract: rows above the stored mark are published together with the new mark. A batch
    that is replayed, or whose rows a batch job has loaded before, adds nothing. Row ids grow with the files, as in the
    source. There is no event-time watermark: a late version of an old check must never be dropped. `transform` turns
    source rows into source check lines; `on_batch` gets the session and the counts of the load, to refresh the fact.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = written(transform(batch) if transform else batch, "batch")
        counts = run_extract(batch.sparkSession, rows, root, name=name)
        if on_batch:
            on_batch(batch.sparkSession, counts)

    return (
        spark.readStream.schema(schema)
        .parquet(source_glob)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
