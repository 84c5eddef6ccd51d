"""Language-model scores from a hidden Markov model whose states emit words.

The model: a hidden state moves from word to word and emits a symbol. The ``OWN_WORDS`` most
frequent words are symbols of their own; every other word belongs to one of
``SUFFIX_CLASSES`` symbols by its last bytes and has a probability within its class from its
count, with one share left for words never seen; the end of a text is a symbol too. As the
probability within the class does not depend on the state, the exact probability of a text is
the forward probability of its symbols times those of its words within their classes.

Training: word counts over all training texts (summed per task before the shuffle); then
``PASSES`` passes of Baum-Welch over all training texts, the first one with steps of
``STEP_SEGMENTS`` segments within each task. Each task adds up expected counts and Spark sums
them over the partitions, so one row per symbol reaches the driver. Nothing is sampled.
Expected counts come from segments of ``SEGMENT`` tokens; likelihoods from whole texts.

Counts of the most frequent words (``NEAR_WORDS`` at most, of ``NEAR_BYTES`` bytes at most) travel
with the tasks; the others meet their counts in a join on the word, and only their sums come
back to the text's row.

Null and empty texts consist of the end token. A null id counts as empty text for the fold.
Repeated rows count and score again. Without training texts every word is unknown. An empty
table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.batches import LOWER_BYTES, fold_of, raw_texts, slices
from turnstile.llm.hmm import (
    Counts,
    Hmm,
    estimate,
    expect,
    first_guess,
    log10_likelihoods,
)
from turnstile.session import stage

OWN_WORDS = 4096
SUFFIX_CLASSES = 256
NEAR_WORDS = 32_768
NEAR_BYTES = 64
STATES = 8
SEGMENT = 256
STEP_SEGMENTS = 128
FADE = 0.8
PASSES = 2
COUNTER_WORDS = 300_000
SCORE_BYTES = 3 << 20
END = b""


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(LOWER_BYTES).split()


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIX_CLASSES


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))


def training_rows(docs: DataFrame, held_out: int, folds: int) -> DataFrame:
    return docs.where(fold_of(F.col("doc_id"), folds) != held_out)


def count_words(docs: DataFrame) -> DataFrame:
    """word, class, c over all rows; the end token is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = list(found)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(map(suffix_class, words), pa.int64()),
                 pa.array(found.values(), pa.int64())], names=["word", "class", "c"])
            found.clear()
            return batch

        for part in slices(batches):
            for raw in raw_texts(part):
                found.update(words_of(raw))
                found[END] += 1
            if len(found) > COUNTER_WORDS:
                yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, class long, c long").groupBy(
        "word", "class").agg(F.sum("c").alias("c"))


class Codes(dict):
    """Codes of near words; any other word gets the code of its class and goes to ``far``."""

    def __init__(self, near: dict[bytes, int]):
        super().__init__({word: k for k, word in enumerate(near)} | {END: END_CODE})
        self.far: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.far.append(word)
        return NEAR_WORDS + zlib.crc32(word[-3:]) % SUFFIX_CLASSES


END_CODE = NEAR_WORDS + SUFFIX_CLASSES
END_SYMBOL = OWN_WORDS + SUFFIX_CLASSES
N_SYMBOLS = END_SYMBOL + 1


@dataclass
class Vocabulary:
    """What every task needs to know of the counts."""

    near: dict[bytes, int]  # counts of the most frequent words, most frequent first
    n_tokens: int
    n_words: int
    class_tokens: np.ndarray
    class_words: np.ndarray
    end_count: int

    @property
    def symbol_of_code(self) -> np.ndarray:
        """Own words keep their code; other near words and classes share the class symbols."""
        table = np.full(END_CODE + 1, OWN_WORDS)
        table[:OWN_WORDS] = np.arange(OWN_WORDS)
        table[OWN_WORDS:len(self.near)] = OWN_WORDS + np.array(
            [suffix_class(word) for word in list(self.near)[OWN_WORDS:]], np.int64)
        table[NEAR_WORDS:] = OWN_WORDS + np.arange(SUFFIX_CLASSES + 1)
        return table

    @property
    def log_count_of_code(self) -> np.ndarray:
        """log10(count + 1) of near words and the end; 0 for the rest, whose count is not here."""
        table = np.zeros(END_CODE + 1)
        table[:len(self.near)] = np.log10(np.fromiter(self.near.values(), float) + 1)
        table[END_CODE] = np.log10(self.end_count + 1)
        return table

    @property
    def prior(self) -> np.ndarray:
        """Overall probability of each symbol."""
        seen = np.ones(N_SYMBOLS)
        own = list(self.near.values())[:OWN_WORDS]
        seen[:len(own)] += own
        seen[OWN_WORDS:END_SYMBOL] += self.class_tokens
        seen[END_SYMBOL] += self.end_count
        return seen / seen.sum()


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                        F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))),
                                   F.lit(0)).alias("ends")).first()
    words = counts.where((F.octet_length("word") > 0) & (F.octet_length("word") <= NEAR_BYTES)
                         ).withColumn("step", F.floor(16 * F.log2("c")))
    # Steps of the logarithm, most frequent first, as long as their words are few enough.
    steps = sorted(words.groupBy("step").agg(F.count("*").alias("n")).collect(), reverse=True)
    room = np.cumsum([row["n"] for row in steps]) <= NEAR_WORDS
    chosen = [row["step"] for row, fits in zip(steps, room, strict=True) if fits]
    near = words.where(F.col("step") >= (min(chosen) if chosen else 1 << 20)).select(
        "word", "c").collect()
    near = {bytes(row["word"]): row["c"] for row in sorted(near, key=lambda r: (-r["c"], r["word"]))}
    tokens, distinct = np.zeros(SUFFIX_CLASSES), np.zeros(SUFFIX_CLASSES)
    for row in counts.where(F.octet_length("word") > 0).groupBy("class").agg(
            F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        tokens[row["class"]], distinct[row["class"]] = row["c"], row["v"]
    for word in list(near)[:OWN_WORDS]:
        tokens[suffix_class(word)] -= near[word]
        distinct[suffix_class(word)] -= 1
    return Vocabulary(near, totals["n"], totals["v"], tokens, distinct, totals["ends"])


def segments(raws: list[bytes], codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """The codes of texts end to end, and the lengths of segments that never cross texts."""
    flat: list[int] = []
    lengths: list[int] = []
    for raw in raws:
        before = len(flat)
        flat += map(codes.__getitem__, words_of(raw))
        flat.append(END_CODE)
        n = len(flat) - before
        lengths += [SEGMENT] * (n // SEGMENT)
        if n % SEGMENT:
            lengths.append(n % SEGMENT)
    codes.far.clear()
    return np.array(flat, np.int64), np.array(lengths, np.int64)


def in_steps(lengths: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Places of the codes and of the segments of every ``STEP_SEGMENTS`` segments."""
    ends = np.cumsum(lengths)
    for k in range(0, len(lengths), STEP_SEGMENTS):
        last = min(k + STEP_SEGMENTS, len(lengths))
        yield slice(ends[k] - lengths[k], ends[last - 1]), slice(k, last)


def baum_welch_pass(docs: DataFrame, vocabulary: Vocabulary, model: Hmm,
                    learning: bool = False) -> Hmm:
    """One pass over all rows: expected counts per task, summed by Spark.

    A ``learning`` pass starts far from any optimum: a task goes on from what its rows so far have
    taught it, and older counts fade within the task. All tasks start alike, so their states agree.
    """
    names = [f"k{k}" for k in range(STATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, symbols = Codes(vocabulary.near), vocabulary.symbol_of_code
        counts, own = Counts.zero(N_SYMBOLS, STATES), model
        for part in slices(batches):
            flat, lengths = segments(raw_texts(part), codes)
            for here, which in in_steps(lengths) if learning else [(slice(None), slice(None))]:
                if learning:
                    counts.fade(FADE)
                expect(own, symbols[flat[here]], lengths[which], counts)
                if learning:
                    own = estimate(counts, vocabulary.prior)
        numbers, rows = counts.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), *(pa.array(rows[:, k]) for k in range(STATES))],
            names=["n", *names])

    summed = docs.select("text").mapInArrow(
        run, "n long, " + ", ".join(f"{k} double" for k in names)).groupBy("n").agg(
        *(F.sum(k).alias(k) for k in names)).toArrow()
    rows = np.column_stack([summed.column(k).to_numpy() for k in names])
    return estimate(Counts.from_rows(summed.column("n").to_numpy(), rows, N_SYMBOLS, STATES),
                    vocabulary.prior)


def train(docs: DataFrame, vocabulary: Vocabulary, passes: int = PASSES) -> Hmm:
    model = first_guess(vocabulary.prior, STATES)
    for k in range(passes):
        model = baum_welch_pass(docs, vocabulary, model, learning=k == 0)
    return model


def _text_sums(docs: DataFrame, vocabulary: Vocabulary, model: Hmm) -> DataFrame:
    """Per row what its near words and its symbols give, and its far words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, symbols = Codes(vocabulary.near), vocabulary.symbol_of_code
        log_count = vocabulary.log_count_of_code
        # A symbol of a class stands for count / all of the class; an own word for itself.
        inner = log_count.copy()
        inner[:OWN_WORDS] = inner[END_CODE] = 0
        class_log = np.log10(vocabulary.class_tokens + vocabulary.class_words + 1)
        inner[OWN_WORDS:END_CODE] -= class_log[symbols[OWN_WORDS:END_CODE] - OWN_WORDS]
        known = np.arange(END_CODE + 1) < len(vocabulary.near)
        known[END_CODE] = vocabulary.end_count > 0
        row = TaskContext.get().partitionId() << 33
        for part in slices(batches, limit=SCORE_BYTES):
            raws = raw_texts(part)
            flat: list[int] = []
            ends, far_ends = [], [0]
            for raw in raws:
                flat += map(codes.__getitem__, words_of(raw))
                flat.append(END_CODE)
                ends.append(len(flat))
                far_ends.append(len(codes.far))
            found = np.array(flat, np.int32)
            starts = np.array([0, *ends[:-1]], np.int64)
            lengths = np.array(ends, np.int64) - starts
            path = log10_likelihoods(model, symbols[found], lengths)
            path += np.add.reduceat(inner[found], starts)
            far = pa.ListArray.from_arrays(
                pa.array(far_ends, pa.int32()), pa.array(codes.far, pa.binary()))
            codes.far.clear()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.arange(row, row + len(raws))),
                 pa.array(lengths),
                 pa.array(np.add.reduceat(known[found].astype(np.int64), starts)),
                 pa.array(np.add.reduceat(log_count[found], starts)), pa.array(path), far],
                names=["doc_id", "row", "n_tokens", "n_known", "base", "score", "far"])
            row += len(raws)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {id_type}, row long, n_tokens long, n_known long, "
                                "base double, score double, far array<binary>")


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: int = 2,
                folds: int = 7, passes: int = PASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    source = _source(docs, doc_id, text)
    training = training_rows(source, held_out, folds)
    counts = stage(count_words(training), "word-counts")
    vocabulary = vocabulary_of(counts)
    model = train(training, vocabulary, passes)
    sums = stage(_text_sums(source, vocabulary, model), "text-sums")
    far = sums.select("row", F.explode("far").alias("word"))
    far = far.join(counts.select("word", "c"), "word", "left").groupBy("row").agg(
        F.count("c").alias("far_known"),
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("far_log"))
    spread = float(np.log10(vocabulary.n_tokens + vocabulary.n_words + 1))
    far_log = F.coalesce("far_log", F.lit(0.0))
    return sums.drop("far").join(far, "row", "left").select(
        "doc_id", (fold_of(F.col("doc_id"), folds) == held_out).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + far_log - F.col("n_tokens") * F.lit(spread)).alias("base_score"),
        (F.col("score") + far_log).alias("score"))
