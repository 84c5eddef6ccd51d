"""A bounded sample of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.batches import fold_of

BUCKETS = 1_000_003


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: int, folds: int,
                    max_rows: int) -> DataFrame:
    """doc_id, text, y of labelled rows outside the held-out fold, about ``max_rows`` at most.

    Rows are chosen by a hash of the id, so the sample is the same however Spark splits the
    work; a label given twice counts once. The chosen labels are bounded by ``max_rows`` and are
    therefore sent to the texts.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("double").alias("y")
                          ).where((fold_of(F.col("__id"), folds) != held_out)
                                  & F.col("y").isin(0.0, 1.0)).distinct()
    rows = known.count()
    share = min(1.0, max_rows / rows) if rows else 1.0
    chosen = known.where(
        F.expr(f"pmod(xxhash64(__id), {BUCKETS}) < {int(share * BUCKETS) + 1}"))
    return docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select(
        "doc_id", "text", "y")
