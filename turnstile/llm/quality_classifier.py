"""Quality classifier: features of the whole text, scored by an additive model with pairs.

The model (see ``gam``) is fitted on at most about ``TRAIN_ROWS`` labelled rows, chosen by a
hash of the id, so the sample does not depend on how Spark splits the work. Features and
scores cover every row. Label, language, source and id are no features.

Null text counts as empty; empty texts get the score that the model gives to texts without
words. Rows without a label only get a score; a label given twice trains once; a null id or
label trains nothing. Without any labels the score is 0.5. An empty table gives an empty
result. The operator keeps only the named columns; the filter keeps all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.batches import fold_of, raw_texts, slices
from turnstile.llm.gam import Gam, fit
from turnstile.llm.labelled import labelled_sample

TRAIN_ROWS = 20_000
THRESHOLD = 0.3

FEATURES = ("log_words", "word_length", "capitals", "digits", "symbols", "marks", "stops", "pipes",
            "distinct_words", "next_equal", "capital_starts", "line_words", "repeated_lines",
            "line_ends", "common_word", "distinct_pairs")

_CLASS = {"capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789",
          "symbols": b"#*$%&<>@^~_=+\\{}[]", "marks": b"!?", "stops": b".,;:", "pipes": b"|"}
_STOPS = (b".", b"!", b"?", b":", b"\"", b")")


def text_features(raw: bytes) -> list[float]:
    """The features of one text in the order of ``FEATURES``; shares lie between 0 and 1."""
    words = raw.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)
    letters = sum(map(len, words))
    share = {name: (len(raw) - len(raw.translate(None, chars))) / letters
             for name, chars in _CLASS.items()}
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(numbers) + ids[1:]
    lines = [line for line in raw.split(b"\n") if line.strip()]
    capital = sum(1 for w in words if 65 <= w[0] <= 90)
    return [
        float(np.log1p(n)), letters / n, *share.values(),
        len(numbers) / n,
        float(np.count_nonzero(ids[1:] == ids[:-1])) / n,
        capital / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(line.rstrip().endswith(_STOPS) for line in lines) / len(lines),
        float(np.bincount(ids).max()) / n,
        len(np.unique(pairs)) / n if n > 1 else 1.0,
    ]


def features_of(raws: list[bytes]) -> np.ndarray:
    return np.array([text_features(raw) for raw in raws], np.float64).reshape(-1, len(FEATURES))


def fit_quality(docs: DataFrame, labels: DataFrame, held_out: int, folds: int,
                train_rows: int = TRAIN_ROWS) -> Gam:
    """Fit on labelled rows outside the held-out fold. Features are worked out where the texts
    are; only those of the bounded sample reach the driver."""
    sample = labelled_sample(docs, labels, "quality", held_out, folds, train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(features_of(raw_texts(part))), pa.list_(pa.float64())),
                 part.column("y")], names=["x", "y"])

    table = sample.select("text", "y").mapInArrow(run, "x array<double>, y double").orderBy(
        F.xxhash64("x"), "y").limit(2 * train_rows).toArrow()  # ids may repeat
    x = np.array(table.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array(table.column("y").to_pylist(), np.float64))


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  held_out: int = 0, folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    source = _source(docs, doc_id, text)
    model = fit_quality(source, labels, held_out, folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(model.score(features_of(raw_texts(part))))],
                names=["doc_id", "score"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", (fold_of(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
              held_out: int = 0, folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = fit_quality(_source(docs, doc_id, text), labels, held_out, folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            accepted = model.score(features_of(raw_texts(part, text))) >= threshold
            yield part.filter(pa.array(accepted))

    return docs.mapInArrow(run, docs.schema)
