"""Documents in, raw rows and tallies out, micro-batch by micro-batch."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremorline.operators.documents import decode_documents, document_counts, explode_features
from tremorline.operators.normalize import normalize_features
from tremorline.sources.tables import append_raw

logger = logging.getLogger(__name__)


def _log_batch(batch_id: int, totals: dict) -> None:
    logger.info("batch %s: %s", batch_id, totals)


def start_ingest(
    documents: DataFrame,
    raw_log: str,
    tally_log: str | None,
    checkpoint: str,
    trigger: dict | None = None,
    null_numeric: str = "zero",
    on_batch: Callable[[int, dict], None] = _log_batch,
) -> StreamingQuery:
    """Run the ingest over a stream of (doc_seq, value).

    Processing-time micro-batches, one per second unless told otherwise, and no
    watermark: a late event is appended like any other and enters the views at
    their next recompute. A batch that is replayed after a failure appends its
    rows again under the same source sequence, which leaves the current rows and
    the audit as they were.

    on_batch gets the batch's totals, observed on the way: documents, corrupt,
    measures. tally_log takes one row per document for the audit; None leaves
    it out.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        totals = Observation(f"ingest-{batch_id}")
        decoded = decode_documents(batch)
        observed = decoded.observe(
            totals,
            F.count(F.lit(1)).alias("documents"),
            F.count_if("is_corrupt").alias("corrupt"),
            F.coalesce(F.sum("count"), F.lit(0)).alias("measures"),
        )
        append_raw(normalize_features(explode_features(observed), null_numeric), raw_log)
        if tally_log is not None:
            # Decoded again: measured at half the cost of keeping the decoded
            # features, which are several times the size of their text.
            document_counts(decoded).write.mode("append").parquet(tally_log)
        on_batch(batch_id, totals.get)

    return (
        documents.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def run_available(
    documents: DataFrame,
    raw_log: str,
    tally_log: str | None,
    checkpoint: str,
    **options: object,
) -> StreamingQuery:
    """Ingest everything there is, then stop."""
    query = start_ingest(
        documents, raw_log, tally_log, checkpoint, trigger={"availableNow": True}, **options
    )
    query.awaitTermination()
    return query
