"""Score files as they arrive.

The batch scorer is applied to each micro-batch of a file-stream source
(``foreachBatch``); the checkpoint folder tracks processed files, so a
restarted query resumes where it stopped. Each micro-batch is written to
its own ``epoch=<id>`` folder with overwrite, so a retried batch replaces
its own output instead of appending duplicates (idempotent sink).
The reference only scores static files; this is the same operator driven
by a stream source instead of a one-off read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.plans.scoring import score_batch


def score_stream(
    spark: SparkSession,
    model: PipelineModel,
    classes: Sequence,
    *,
    source_dir: str,
    schema: StructType,
    output_dir: str,
    checkpoint_dir: str,
    id_col: str,
    features: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
    max_files_per_trigger: int = 100,
) -> StreamingQuery:
    """Start a query scoring every new parquet file in ``source_dir`` into
    parquet files under ``output_dir``. ``available_now`` processes what is
    there and stops (batch-like catch-up); otherwise it keeps running."""
    source = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # one model pass per batch; a batch with bad probabilities or ids fails and is tried again
        score_batch(model, batch, classes, id_col=id_col, features=features, prepare=prepare, allow_empty=True,
                    output=f"{output_dir.rstrip('/')}/epoch={epoch_id}")

    writer = source.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
