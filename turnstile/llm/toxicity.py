"""Toxicity of texts after noisy-channel deobfuscation.

A letter trigram model is counted over all training texts. Suspicious words (digits, signs or
separators among letters, letters repeated or spelled out) are decoded under it (see
``noisy_channel``); what is left of separators and repeats is also read without them.
Then the restored words are scored: words and word beginnings that mark toxic texts are learned
from at most about ``TRAIN_ROWS`` labelled texts. Evidence is counted in different contexts
(the word before), so copies of one text count once. What each half of these texts has of the
marks of the other half fits a small additive model; scores then use the marks of both halves.

Null and empty texts have no marks and get the score of such texts. Rows without a label only
get a score; without any labels the score is 0.5; a null id counts as empty text for the fold and
meets no label. Repeated rows get the same score; an empty table gives an empty result. The
operator reads only the named columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.batches import fold_of, slices, texts
from turnstile.llm.gam import Gam, fit
from turnstile.llm.labelled import labelled_sample
from turnstile.llm.noisy_channel import (
    EDGES,
    SIZE,
    Channel,
    is_suspicious,
    squeezed,
    trigram_counts,
)
from turnstile.session import stage

TRAIN_ROWS = 16_000
THRESHOLD = 0.3
MAX_MARKS = 20_000
LEAST_CONTEXTS = 3
LEAST_LOG_ODDS = 3.0
BEGINNINGS = (4, 5)
CACHE_WORDS = 200_000
FEATURES = 5


def train_channel(docs: DataFrame) -> Channel:
    """The letter model over all rows; counts are summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for part in slices(batches, limit=1 << 20):
            total += trigram_counts(texts(part))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])],
                                         names=["code", "n"])

    found = docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(
        F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SIZE**3)
    counts[found.column("code").to_numpy()] = found.column("n").to_numpy()
    return Channel(counts)


def units_of(word: str) -> list[str]:
    """A restored word and its beginnings, which stand for its inflected forms."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


class Restorer(dict):
    """Words to their restored form, remembered up to ``CACHE_WORDS`` and a text; ``second`` has
    the form without separators and repeats of those where it is another."""

    def __init__(self, channel: Channel):
        super().__init__()
        self.channel = channel
        self.second: dict[str, str] = {}

    def __missing__(self, word: str) -> str:
        if not is_suspicious(word):
            self[word] = core = word.strip(EDGES)
            return core
        self[word] = restored = self.channel.restore_word(word)
        other = squeezed(word, restored)
        if other != restored:
            self.second[word] = other
        return restored

    def words(self, text: str) -> list[str]:
        seen = text.lower().split()
        if len(self) >= CACHE_WORDS:  # not within a text, whose second forms are looked up below
            self.clear()
            self.second.clear()
        restored = list(map(self.__getitem__, seen))
        second = [self.second[word] for word in seen if word in self.second]
        return [*restored, *second, *self.channel.spelled_out(seen)]


def learn_marks(sample: DataFrame, channel: Channel) -> list[dict[str, float]]:
    """Units with their log odds in toxic against other texts, counted by contexts: of half 0,
    of half 1, and of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(channel)
        for part in slices(batches):
            rows: set[tuple[str, int, int]] = set()
            for text, y, half in zip(texts(part), part.column("y").to_pylist(),
                                     part.column("half").to_pylist(), strict=True):
                before, kind = 0, 2 * half + (y > 0.5)
                for word in restorer.words(text):
                    for unit in units_of(word):
                        rows.add((unit, before, kind))
                    before = zlib.crc32(word.encode())
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()),
                                                strict=True)], names=["unit", "context", "kind"])

    kinds = [F.count_if(F.col("kind") == k).alias(f"n{k}") for k in range(4)]
    found = stage(sample.select("text", "y", "half").mapInArrow(
        run, "unit string, context long, kind long").distinct().groupBy("unit").agg(*kinds),
        "toxic-units")
    out = []
    for clean, toxic in (("n0", "n1"), ("n2", "n3"), ("n0 + n2", "n1 + n3")):
        counts = found.select("unit", F.expr(clean).alias("c"), F.expr(toxic).alias("t"))
        total = counts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
        if not total["t"] or not total["c"]:
            out.append({})
            continue
        odds = F.log(((F.col("t") + 0.5) / total["t"]) / ((F.col("c") + 0.5) / total["c"]))
        marks = counts.where(f"t >= {LEAST_CONTEXTS}").withColumn("odds", odds).where(
            F.col("odds") >= LEAST_LOG_ODDS).orderBy(
            F.desc(F.col("odds") * F.col("t")), "unit").limit(MAX_MARKS).collect()
        out.append({row["unit"]: row["odds"] for row in marks})
    return out


class Evidence:
    """Numbers of a text's marks, by restored words."""

    def __init__(self, channel: Channel, marks: dict[str, float]):
        self.restorer = Restorer(channel)
        self.marks = marks
        self.weights: dict[str, float] = {}

    def weight(self, word: str) -> float:
        known = self.weights.get(word)
        if known is None:
            if len(self.weights) >= CACHE_WORDS:
                self.weights.clear()
            known = max((self.marks.get(unit, 0.0) for unit in units_of(word)), default=0.0)
            self.weights[word] = known
        return known

    def features(self, text: str) -> list[float]:
        words = self.restorer.words(text)
        hits = [(w, x) for w, x in zip(words, map(self.weight, words), strict=True) if x > 0]
        best = sorted({w: x for w, x in hits}.values(), reverse=True)
        return [len(best), best[0] if best else 0.0, sum(best[:3]),
                100 * len(hits) / max(len(words), 1), float(np.log1p(len(words)))]


def _feature_rows(evidence: Evidence, values: list[str]) -> np.ndarray:
    return np.array([evidence.features(v) for v in values], np.float64).reshape(-1, FEATURES)


def fit_evidence(sample: DataFrame, channel: Channel, halves: list[dict[str, float]]) -> Gam:
    """Fit on what each text has of the marks of the other half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = [Evidence(channel, marks) for marks in halves]
        for part in slices(batches):
            rows = [evidence[1 - half].features(text) for text, half in
                    zip(texts(part), part.column("half").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), part.column("y")], names=["x", "y"])

    table = sample.select("text", "y", "half").mapInArrow(
        run, "x array<double>, y double").orderBy(
        F.xxhash64("x"), "y").limit(2 * TRAIN_ROWS).toArrow()  # ids may repeat
    return fit(np.array(table.column("x").to_pylist(), np.float64).reshape(-1, FEATURES),
               np.array(table.column("y").to_pylist(), np.float64))


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   held_out: int = 2, folds: int = 4,
                   threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    channel = train_channel(source.where(fold_of(F.col("doc_id"), folds) != held_out))
    sample = stage(labelled_sample(source, labels, "toxic", held_out, folds, TRAIN_ROWS)
                   .withColumn("half", F.expr("pmod(xxhash64(doc_id, 1), 2)")), "toxic-sample")
    *halves, marks = learn_marks(sample, channel)
    model = fit_evidence(sample, channel, halves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(channel, marks)
        for part in slices(batches):
            scores = model.score(_feature_rows(evidence, texts(part)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)],
                                             names=["doc_id", "score"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, score double").select(
        "doc_id", (fold_of(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def restore_texts(docs: DataFrame, channel: Channel, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """doc_id, restored: every text in lower case with its obfuscated words read out."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"),
                 pa.array([channel.restore_text(t) for t in texts(part)], pa.string())],
                names=["doc_id", "restored"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, restored string")
