"""Quality rules as a short-circuit cascade.

Each rule's cost and share of rejections are measured on a sample; the rules then run in
descending order of rejections per cost and a document stops at the first that rejects it.
Numbers of a text are worked out when a rule first asks for them, so what no rule needs any
more is never computed. The order changes the work, never the verdict: a document is kept if no
rule rejects it.

Null text has no words; empty texts fail the word count. Repeated rows get the same verdict; an
empty table gives an empty result. The operator keeps only the two named columns.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.batches import raw_texts, slices

SAMPLE_ROWS = 1000
WHITE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Facts:
    """Numbers of one text, each computed on first use."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @functools.cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    def count(self, characters: bytes) -> int:
        return len(self.raw) - len(self.raw.translate(None, characters))

    @functools.cached_property
    def word_chars(self) -> int:
        units = np.frombuffer(self.raw, np.uint8)
        return int(np.count_nonzero((units & 0xC0) != 0x80)) - self.count(WHITE)

    @functools.cached_property
    def n_symbols(self) -> int:
        return self.count(SYMBOLS)

    @functools.cached_property
    def n_capitals(self) -> int:
        return self.count(CAPITALS)

    @functools.cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @functools.cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @functools.cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of three that occur twice or more."""
        if self.n_words < 4:
            return 0
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in self.words], np.int64)
        pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(numbers) + ids[2:]
        _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[which] > 1)
        covered = np.zeros(self.n_words, bool)
        for shift in range(3):
            covered[starts + shift] = True
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Facts], bool]
    base: bool = False


RULES = (
    Rule("few_words", lambda f: f.n_words < 50, base=True),
    Rule("repeated_words", lambda f: 100 * f.n_repeat_words > 50 * f.n_words, base=True),
    Rule("symbols", lambda f: 2 * f.n_symbols > f.n_words),
    Rule("capitals", lambda f: 2 * f.n_capitals > f.word_chars),
    Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > len(f.lines)),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 25 * f.n_words),
)


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by rejections per cost, measured on about ``sample_rows`` sampled rows.

    The executors time the rules; only one row per rule reaches the driver.
    """
    rows = docs.count()
    sample = _source(docs, text, text).drop("doc_id")
    sample = sample.sample(min(1.0, sample_rows / rows), seed=1) if rows else sample

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, rejected = [0] * len(rules), [0] * len(rules)
        for part in slices(batches):
            for raw in raw_texts(part):
                for k, rule in enumerate(rules):
                    start = time.perf_counter_ns()
                    rejected[k] += rule.rejects(Facts(raw))
                    cost[k] += time.perf_counter_ns() - start
        yield pa.RecordBatch.from_pydict({"rule": list(range(len(rules))), "cost": cost,
                                          "rejected": rejected})

    measured = sample.mapInArrow(measure, "rule long, cost long, rejected long").groupBy(
        "rule").agg(F.sum("cost").alias("cost"), F.sum("rejected").alias("rejected")).collect()
    worth = {row["rule"]: row["rejected"] / max(row["cost"], 1) for row in measured}
    return tuple(rules[k] for k in sorted(range(len(rules)), key=lambda k: (-worth.get(k, 0), k)))


def quality_cascade(docs: DataFrame, ordered: tuple[Rule, ...], doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, the base numbers, base_failed and kept of every row."""
    source = _source(docs, doc_id, text)
    base = tuple(rule for rule in ordered if rule.base)
    numbers = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            facts = [Facts(raw) for raw in raw_texts(part)]
            kept = [not any(rule.rejects(f) for rule in ordered) for f in facts]
            failed = [not k and any(rule.rejects(f) for rule in base)
                      for k, f in zip(kept, facts, strict=True)]
            columns = [pa.array([getattr(f, n) for f in facts], pa.int64()) for n in numbers]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns, pa.array(failed), pa.array(kept)],
                names=["doc_id", *numbers, "base_failed", "kept"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{n} long" for n in numbers)
    return source.mapInArrow(
        run, f"doc_id {id_type}, {longs}, base_failed boolean, kept boolean")
