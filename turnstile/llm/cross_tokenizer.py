"""Alignment of two tokenizers over the same bytes by interval coalescing.

Tokenizer A is a byte-level BPE (JSON file, encodes space + text), tokenizer B a piece model
(which adds the space itself). The tokens of both are byte intervals. All intervals of a slice
of texts are lexsorted by start and their ends run through ``maximum.accumulate``: where a start
reaches the running maximum, both tokenizers end a token and a group breaks. Within a group
every pair of an A and a B token whose intervals overlap is linked.

``align_texts`` returns the tokens of every row with their group numbers. ``link_statistics``
sets them against the table: how many documents hold an id pair linked, and whether that is
the most that the A id has with any B id. Texts are cut into chunks of ``CHUNK_BYTES``; a chunk
is one row with its distinct pairs, so a pair crosses the cluster once per chunk and not once
per text, and no pair gathers more rows than there are chunks.

Defined results: null and empty texts, and texts whose tokens of either side do not spell
space + text (the piece model changes some characters), have no tokens, zeros everywhere and an
empty digest. Strings of special tokens are plain text. Repeated rows are documents of their own
and a null id stays null. Other columns are not read. An empty table gives an empty result. One
text is held by one task with its tokens.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnstile.llm.batches import slices, texts
from turnstile.llm.bpe import byte_alphabet
from turnstile.session import stage

CHUNK_BYTES = 4 << 20
CHUNKS_PER_FILE = 4
ENCODE_TEXTS = 256
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The rank encoder recurses over white space; longer runs go to the library of the file.
LONG_SPACE = re.compile(r"\s{2000}")
B_BITS = 32
PIECE_SPACE = "▁"
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


class Tokens(NamedTuple):
    """A tokenizer: lists of ids per text, and the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: np.ndarray
    lengths: np.ndarray


def _tokens(encode: Callable[[list[str]], list[list[int]]], pieces: list[bytes]) -> Tokens:
    table = np.empty(len(pieces), object)
    table[:] = pieces
    return Tokens(encode, table, np.fromiter(map(len, pieces), np.int64, len(pieces)))


@cache
def byte_tokens(path: str) -> Tokens:
    """Tokenizer A from its JSON file; each text is encoded behind a space.

    Where the file's merges are in the order of their ids, as usual, ids are ranks and the quick
    rank encoder gives the same tokens.
    """
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary = spec["model"]["vocab"]
    to_byte = {letter: i for i, letter in enumerate(byte_alphabet())}
    pieces = [b""] * library.get_vocab_size(with_added_tokens=True)
    for token, i in vocabulary.items():
        pieces[i] = bytes(to_byte[letter] for letter in token)
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)]
              for m in spec["model"]["merges"]]
    ranked = None
    if merged == sorted(merged) and spec["normalizer"] is None:
        ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            pieces[i]: i for i in vocabulary.values()})

    def encode(values: list[str]) -> list[list[int]]:
        return [ranked.encode_ordinary(" " + value)
                if ranked and not LONG_SPACE.search(value)
                else library.encode(" " + value, add_special_tokens=False).ids
                for value in values]

    return _tokens(encode, pieces)


@cache
def piece_tokens(path: str) -> Tokens:
    """Tokenizer B from its piece model, which adds the leading space itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = BYTE_PIECE.fullmatch(piece) if model.is_byte(i) else None
        pieces.append(bytes([int(byte[1], 16)]) if byte
                      else piece.replace(PIECE_SPACE, " ").encode())

    def encode(values: list[str]) -> list[list[int]]:
        return model.encode(values, num_threads=1)

    return _tokens(encode, pieces)


class Side(NamedTuple):
    """Tokens of one tokenizer over a slice: ids, byte ends, and the first token of each text."""

    ids: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1])) if len(self.ends) else self.ends


def _encode(tokens: Tokens, values: list[str]) -> list[np.ndarray]:
    return [np.array(ids, np.int32) for at in range(0, len(values), ENCODE_TEXTS)
            for ids in tokens.encode(values[at:at + ENCODE_TEXTS])]


def _side(tokens: Tokens, rows: list[np.ndarray]) -> Side:
    ids = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    firsts = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
    return Side(ids, np.cumsum(tokens.lengths[ids]), firsts)


def spelled(tokens: Tokens, ids: np.ndarray, raw: bytes) -> bool:
    """Whether the tokens are exactly these bytes."""
    return (int(tokens.lengths[ids].sum()) == len(raw)
            and b"".join(tokens.pieces[ids].tolist()) == raw)


def encode_slice(values: list[str], a: Tokens, b: Tokens) -> tuple[Side, Side]:
    """Both sides of a slice; texts that either side does not spell have no tokens."""
    rows_a, rows_b = _encode(a, values), _encode(b, values)
    none = np.zeros(0, np.int32)
    for i, value in enumerate(values):
        raw = (" " + value).encode()
        if not (value and spelled(a, rows_a[i], raw) and spelled(b, rows_b[i], raw)):
            rows_a[i] = rows_b[i] = none
    return _side(a, rows_a), _side(b, rows_b)


def group_numbers(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and B token, numbered through the slice."""
    starts = np.concatenate((a.starts, b.starts))
    ends = np.concatenate((a.ends, b.ends))
    side = np.repeat(np.array([0, 1], np.int8), (len(a.ids), len(b.ids)))
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    groups = np.empty(len(order), np.int64)
    groups[order] = np.cumsum(breaks)
    return groups[:len(a.ids)], groups[len(a.ids):]


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Positions of every A and B token that share a byte, by A position."""
    first = np.searchsorted(b.ends, a.starts, side="right")
    count = np.searchsorted(b.starts, a.ends, side="left") - first
    at_a = np.repeat(np.arange(len(a.ids)), count)
    at_b = np.arange(len(at_a)) - np.repeat(np.cumsum(count) - count - first, count)
    return at_a, at_b


@cache
def _spellings(size: int) -> np.ndarray:
    """Decimal ids followed by each of the four separators (none for the last token)."""
    table = np.empty(size * 4, object)
    table[:] = [str(i).encode() + end for i in range(size) for end in (b",", b"|", b";", b"")]
    return table


def write_groups(a: Side, b: Side, in_a: np.ndarray, in_b: np.ndarray, size: int) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` per text of the slice: ids of A and B, group by group."""
    n_groups = int(in_a[-1]) + 1 if len(in_a) else 0
    many_a = np.cumsum(np.bincount(in_a, minlength=n_groups))
    many_b = np.cumsum(np.bincount(in_b, minlength=n_groups))
    before_b = np.concatenate(([0], many_b[:-1]))
    end_a = np.zeros(len(in_a), np.int64)
    end_a[many_a - 1] = 1
    end_b = np.zeros(len(in_b), np.int64)
    end_b[many_b - 1] = 2
    lasts = b.firsts[1:][np.diff(b.firsts) > 0] - 1
    end_b[lasts] = 3
    codes = np.empty(len(in_a) + len(in_b), np.int64)
    codes[np.arange(len(in_a)) + before_b[in_a]] = a.ids.astype(np.int64) * 4 + end_a
    codes[np.arange(len(in_b)) + many_a[in_b]] = b.ids.astype(np.int64) * 4 + end_b
    written = _spellings(size)[codes].tolist()
    bounds = (a.firsts + b.firsts).tolist()
    return [b"".join(written[s:e]) for s, e in zip(bounds, bounds[1:], strict=False)]


def _per_text(positions: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    return np.searchsorted(firsts, positions, side="right") - 1


def _list(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))


def align_texts(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """doc_id, a_ids, b_ids and the group number of each token, counted from 0 in its text."""
    source = _source(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=CHUNK_BYTES):
            a, b = encode_slice(texts(part), byte_tokens(a_path), piece_tokens(b_path))
            groups = group_numbers(a, b)
            arrays = [part.column("doc_id"), _list(a.ids, a.firsts), _list(b.ids, b.firsts)]
            first_group = np.zeros(part.num_rows, np.int64)
            full = np.diff(a.firsts) > 0
            first_group[full] = groups[0][a.firsts[:-1][full]]
            for side, numbers in zip((a, b), groups, strict=True):
                own = numbers - np.repeat(first_group, np.diff(side.firsts))
                arrays.append(_list(own.astype(np.int32), side.firsts))
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "a_ids", "b_ids", "a_groups", "b_groups"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, a_ids array<int>, b_ids array<int>, "
                                  "a_groups array<int>, b_groups array<int>")


_DOC = ("struct<doc_id:{0},n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,"
        "groups_sha256:string,n_pairs:bigint>")


def _chunk(part: pa.RecordBatch, a_tokens: Tokens, b_tokens: Tokens) -> list[pa.Array]:
    """One row: its documents, its distinct pairs with their document counts, and for each
    document the pairs it holds (by place in the chunk) with the number of links."""
    a, b = encode_slice(texts(part), a_tokens, b_tokens)
    in_a, in_b = group_numbers(a, b)
    at_a, at_b = overlaps(a, b)
    owner = _per_text(at_a, a.firsts)
    pairs, place = np.unique((a.ids[at_a].astype(np.int64) << B_BITS) | b.ids[at_b],
                             return_inverse=True)
    held, links = np.unique(owner * max(1, len(pairs)) + place, return_counts=True)
    held_by, held_place = np.divmod(held, max(1, len(pairs)))
    rows = part.num_rows
    written = write_groups(a, b, in_a, in_b, max(len(a_tokens.pieces), len(b_tokens.pieces)))
    n_a, n_b = np.diff(a.firsts), np.diff(b.firsts)
    n_links = np.bincount(owner, minlength=rows)
    docs = pa.StructArray.from_arrays([
        part.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(n_a + n_b - n_links),
        pa.array(n_links.astype(np.int64)),
        pa.array([hashlib.sha256(w).hexdigest() if w else "" for w in written]),
        pa.array(np.bincount(held_by, minlength=rows).astype(np.int64))],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs"])
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return [one(docs), one(pa.array(pairs)),
            one(pa.array(np.bincount(held_place, minlength=len(pairs)).astype(np.int64))),
            one(pa.array(held_place.astype(np.int32))), one(pa.array(links.astype(np.int64)))]


def _chunks(source: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays(
                _chunk(part, byte_tokens(a_path), piece_tokens(b_path)),
                names=["docs", "pairs", "n_docs", "held", "links"])

    doc = _DOC.format(source.schema["doc_id"].dataType.simpleString())
    return source.mapInArrow(run, f"docs array<{doc}>, pairs array<bigint>, n_docs array<bigint>, "
                                  "held array<int>, links array<bigint>")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, n: documents that hold it linked; best: no B id has more with this A id."""
    pairs = stage(chunks.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("p")).groupBy(
        F.col("p.pairs").alias("pair")).agg(F.sum("p.n_docs").alias("n")), "pair-counts")
    a_id = F.shiftright("pair", B_BITS).alias("a_id")
    most = pairs.groupBy(a_id).agg(F.max("n").alias("most"))
    return pairs.withColumn("a_id", a_id).join(most, "a_id").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a chunk with the counts of their pairs, added up over their links."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            docs, held, links = (row.column(c).flatten() for c in ("docs", "held", "links"))
            found = row.column("found").flatten()
            counts = np.zeros(len(found), np.int64)
            counts[np.asarray(found.field("place"))] = np.asarray(found.field("n"))
            best = np.zeros(len(found), np.int64)
            best[np.asarray(found.field("place"))] = np.asarray(
                found.field("best").cast(pa.int8()))
            ends = np.cumsum(np.asarray(docs.field("n_pairs")))
            held, links = np.asarray(held), np.asarray(links)
            sums = []
            for weight in (best, counts):
                run = np.concatenate(([0], np.cumsum(links * weight[held])))
                sums.append(pa.array(np.diff(run[np.concatenate(([0], ends))])))
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
            yield pa.RecordBatch.from_arrays(
                [*(docs.field(n) for n in names), *sums, docs.field("groups_sha256")],
                names=[*names, "n_best", "count_sum", "groups_sha256"])


def link_statistics(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256."""
    source = _source(docs, doc_id, text)
    chunks = stage(_chunks(source, a_path, b_path).withColumn(
        "chunk", F.monotonically_increasing_id()), "aligned-chunks", CHUNKS_PER_FILE)
    known = stage(pair_counts(chunks), "pair-known")
    asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    found = asked.join(known, "pair").groupBy("chunk").agg(
        F.collect_list(F.struct("place", "n", "best")).alias("found"))
    nothing = F.array().cast("array<struct<place:int,n:bigint,best:boolean>>")
    answered = chunks.select("chunk", "docs", "held", "links").join(
        found, "chunk", "left").select(
        "docs", "held", "links", F.coalesce("found", nothing).alias("found"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return answered.mapInArrow(_sums, f"doc_id {id_type}, n_a bigint, n_b bigint, "
                               "n_groups bigint, n_links bigint, n_best bigint, "
                               "count_sum bigint, groups_sha256 string")
