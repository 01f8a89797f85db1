"""Streaming use of the fitted models.

The original is batch-only (no watermarks, windows or state), so this
package adds no streaming operators. The stateless scoring steps are plain
column expressions and therefore work unchanged on a streaming DataFrame:

* ``quarry.operators.logistic.score(model, stream)`` (M2),
* ``quarry.operators.kmeans.assign(stream, model)`` (M4),

e.g. ``spark.readStream.schema(s).parquet(dir)`` -> score -> ``writeStream``.
Naive Bayes scoring aggregates per document, so it is applied per micro-batch
with ``foreachBatch`` (see ``score_batches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def score_batches(stream: DataFrame, scorer, sink, checkpoint: str, trigger_once: bool = False):
    """Run ``sink(scorer(batch_df), epoch_id)`` for each micro-batch of ``stream``.

    ``checkpoint`` must be a folder on shared storage so a restarted query
    resumes where it stopped.
    """
    writer = (stream.writeStream
              .foreachBatch(lambda batch, epoch: sink(scorer(batch), epoch))
              .option("checkpointLocation", checkpoint))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
