"""Packing into training sequences by power-of-two decomposition.

The tokens of a document (its ids and one end token) are cut into pieces whose lengths are
powers of two: as many of the full length as fit, then one for each bit that is set in the
rest, longest first. Each piece is a sequence of its own, so no sequence crosses documents and
none is padded. Equal lengths share a bucket: sequences are numbered bucket by bucket, longest
first, within a bucket by partition and row, so that a loader reads equal lengths together.

Numbering needs no sort of the pieces: each partition counts its pieces per bucket, and running
sums of these counts give every partition its first number. Null and empty texts consist of the
end token. Repeated rows are packed again; an empty table gives an empty result; only the two
named columns are read.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.batches import slices, texts
from turnstile.llm.bpe import Vocabulary, WordEncoder
from turnstile.session import stage

SEQUENCE_TOKENS = 4096
END_TOKEN = 2


class LibraryEncoder(WordEncoder):
    """Encodes new words by the merges of the tokenizers library; they are split already."""

    def _learn(self, new: set[str]) -> None:
        merge, alphabet = self.vocabulary.library.model.tokenize, self.vocabulary.to_alphabet
        for word in new:
            symbols = word.encode().decode("latin-1").translate(alphabet)
            self.known[word] = array("I", [t.id for t in merge(symbols)]).tobytes()


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    """One encoder per worker process and file."""
    return LibraryEncoder(Vocabulary(path))


def piece_lengths(n_tokens: int, longest: int = SEQUENCE_TOKENS) -> list[int]:
    """Lengths of the pieces of a document; ``longest`` is a power of two."""
    rest = n_tokens % longest
    bits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [longest] * (n_tokens // longest) + bits


def cut_pieces(docs: DataFrame, path: str, doc_id: str, text: str, longest: int,
               end_token: int) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, part, place: one row per piece; ``place``
    counts the pieces of that length in the partition."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    end = end_token.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_number = TaskContext.get().partitionId()
        words = library_encoder(path)
        split = words.vocabulary.split
        counts: dict[int, int] = defaultdict(int)
        for part in slices(batches):
            rows: list[tuple] = []
            owners: list[int] = []
            for owner, ids in enumerate(words.encode([split(t) for t in texts(part)])):
                raw, start = ids + end, 0
                for length in piece_lengths(len(raw) // 4, longest):
                    crc = zlib.crc32(raw[4 * start:4 * (start + length)])
                    rows.append((start, length, crc, len(raw) // 4, counts[length]))
                    owners.append(owner)
                    counts[length] += 1
                    start += length
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(owners)), *columns,
                 pa.array([part_number] * len(rows), pa.int64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place", "part"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids_crc32 long, "
                                  "doc_tokens long, place long, part long")


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
         longest: int = SEQUENCE_TOKENS, end_token: int = END_TOKEN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the sequence length must be a power of two")
    pieces = stage(cut_pieces(docs, path, doc_id, text, longest, end_token), "pieces")
    counts = stage(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n"))
    # One row per power of two up to the sequence length, so a single task may order them.
    buckets = lengths.select("length", (F.sum("n").over(
        Window.orderBy(F.desc("length"))) - F.col("n")).alias("bucket_first"))
    by_part = Window.partitionBy("length").orderBy("part")
    firsts = counts.select("length", "part", (F.sum("n").over(by_part) - F.col("n")).alias("first"))
    firsts = stage(firsts.join(buckets, "length").select(
        "length", "part", (F.col("first") + F.col("bucket_first")).alias("first")), "piece-firsts")
    return pieces.join(firsts, ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
