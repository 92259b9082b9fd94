"""Incremental complaint classification with Structured Streaming.

The original tool classifies the ticket table in batch.  Ticket files usually
arrive continuously, so the same operator (:func:`classify_support_tickets`,
a per-row native projection with no state) runs here on a file stream: each
micro-batch classifies only the new files and appends the result.  Progress
and output commit state live under the shared checkpoint folder, so a restarted
query (or one that lost executors) resumes exactly once per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from churnlab.operators.complaints import DOMAIN_LEXICON, classify_support_tickets
from churnlab.session import ensure_checkpoint_dir

TICKET_SCHEMA = T.StructType(
    [
        T.StructField("ticket_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("ticket_text", T.StringType()),
        T.StructField("complaint_category_seed", T.StringType()),
    ]
)


def ticket_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType = TICKET_SCHEMA,
    max_files_per_trigger: int = 64,
) -> DataFrame:
    """Parquet ticket files appearing in ``source_dir`` as an unbounded table."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_dir)
    )


def classify_stream(
    spark: SparkSession,
    source_dir: str,
    output_dir: str,
    lexicon: Sequence[Sequence[str]] = DOMAIN_LEXICON,
    query_name: str = "classified_tickets",
    checkpoint_location: str | None = None,
    trigger_once: bool = False,
) -> StreamingQuery:
    """Classify new ticket files and append them as Parquet to ``output_dir``.

    The checkpoint defaults to ``<spark.checkpoint.dir>/streams/<query_name>``.
    ``trigger_once`` processes what is there and stops (for scheduled runs).
    """
    checkpoint_location = checkpoint_location or (
        f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
    )
    classified = classify_support_tickets(ticket_stream(spark, source_dir), lexicon)
    writer = (
        classified.writeStream.format("parquet")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
        .queryName(query_name)
    )
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
