"""Near duplicates by SimHash and deletion-variant signatures.

A fingerprint has 64 bits; two link if they differ in two bits or fewer. It is cut into two
segments of 32 bits, so of two linked fingerprints one segment differs in at most one bit.
Each segment is indexed as it is and once for each position with that bit deleted; segments
that differ in exactly one bit meet under the variant of that position, one with the bit
clear and one with it set. An equality join on these signatures finds every candidate and a
bit count verifies it.

All of this works on distinct fingerprints. A signature with two members gives its pair from
an aggregate. Signatures with up to ``WIDE`` members are joined. Wider ones take finer
signatures that also delete one (or, where the segment is equal, two) bits of the other
segment: four fingerprints at most share such a signature and all of them link, so no group is
compared pairwise and no link is lost.

Null text counts as empty; texts without words have fingerprint zero and link like any other.
Rows may repeat; a null id joins its group but never names it (a group of null ids only has a
null component). Only the two named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.batches import LOWER_BYTES, raw_texts, slices
from turnstile.llm.components import connected_components
from turnstile.session import stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
WIDE = 64
SLICE_BYTES = 1 << 18
BLOCK_HASHES = 1 << 16


def shingle_hashes(raw: bytes, size: int = SHINGLE_WORDS) -> list[int]:
    """Hashes of all word shingles of a text, repeats included."""
    words = raw.translate(LOWER_BYTES).split()
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-size] + 1))
    return [digest(line[a:b], SEED)
            for a, b in zip(starts.tolist(), stops[size - 1:].tolist(), strict=True)]


def fingerprints(raws: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text: the majority of each bit of its hashes.

    The bits of at most ``BLOCK_HASHES`` hashes are laid out at once, so a text of any length
    fits.
    """
    hashes = [shingle_hashes(raw, size) for raw in raws]
    counts = np.array([len(h) for h in hashes], np.int64)
    owners = np.repeat(np.arange(len(raws)), counts)
    flat = np.fromiter((x for h in hashes for x in h), "<u8", int(counts.sum()))
    ones = np.zeros((len(raws), 64), np.int64)
    for at in range(0, len(flat), BLOCK_HASHES):
        block, owner = flat[at:at + BLOCK_HASHES], owners[at:at + BLOCK_HASHES]
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1))
        ones[owner[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.uint32)
    majority = (2 * ones > counts[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()


def simhash(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp: the fingerprint of every row as a signed 64-bit integer."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(fingerprints(raw_texts(part)).view(np.int64))],
                names=["doc_id", "fp"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, fp long")


def _segment(which: str) -> Column:
    return F.expr(f"shiftrightunsigned(fp, 32 * ({which})) & 4294967295")


def _signatures(nodes: DataFrame) -> DataFrame:
    """fp, key, bit: both segments whole (slot 32) and with each bit deleted (slots 0-31)."""
    slots = nodes.select("fp", F.explode(F.expr("sequence(0, 65)")).alias("slot"))
    cut = slots.select(
        "fp", "slot", _segment("slot div 33").alias("segment"),
        F.expr("CASE WHEN slot % 33 = 32 THEN 0L ELSE shiftleft(1L, slot % 33) END").alias("gone"))
    return cut.select(
        "fp", F.expr("shiftleft(bigint(slot), 32) + (segment & ~gone)").alias("key"),
        F.expr("segment & gone != 0").alias("bit"))


# Slots 32 and 65 hold whole segments; the others a segment without one bit.
def _whole() -> Column:
    return F.expr("shiftright(key, 32) % 33 = 32")


def _close(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def _finer(members: DataFrame) -> DataFrame:
    """Links within signatures of any width, at a fixed number of rows per member.

    Members of a whole segment delete two bits of the other segment, members of a variant
    one. Those that still agree differ in two bits at most.
    """
    other = members.withColumn("whole", _whole()).withColumn(
        "other", F.expr("shiftrightunsigned(fp, CASE WHEN key >= shiftleft(33L, 32) THEN 0 ELSE 32 END)"
                        " & 4294967295"))
    one = F.expr("transform(sequence(0, 31), i -> shiftleft(1L, i))")
    two = F.expr("flatten(transform(sequence(0, 30), i -> transform(sequence(i + 1, 31),"
                 " j -> shiftleft(1L, i) | shiftleft(1L, j))))")
    fine = other.select("fp", "key", "other",
                        F.explode(F.when(F.col("whole"), two).otherwise(one)).alias("gone"))
    groups = fine.groupBy("key", "gone", F.expr("other & ~gone").alias("rest")).agg(
        F.min("fp").alias("a"), F.collect_set("fp").alias("all"))
    return groups.where("size(all) > 1").select("a", F.explode("all").alias("b")).where("a <> b")


def near_links(nodes: DataFrame, wide: int = WIDE) -> DataFrame:
    """(a, b) for distinct fingerprints ``fp``: links that connect all within two bits."""
    keyed = _signatures(nodes)
    sizes = stage(keyed.groupBy("key").agg(
        F.count_if(~F.col("bit")).alias("n_clear"), F.count_if("bit").alias("n_set"),
        F.min(F.when(~F.col("bit"), F.col("fp"))).alias("clear_low"),
        F.max(F.when(~F.col("bit"), F.col("fp"))).alias("clear_high"),
        F.min(F.when(F.col("bit"), F.col("fp"))).alias("set_low")).where(
        F.when(_whole(), F.col("n_clear") > 1).otherwise((F.col("n_clear") > 0) & (F.col("n_set") > 0))),
        "signature-sizes")
    members_of = F.col("n_clear") + F.col("n_set")
    pairs = sizes.where(members_of == 2).select(
        F.col("clear_low").alias("a"),
        F.when(_whole(), F.col("clear_high")).otherwise(F.col("set_low")).alias("b"))
    more = stage(sizes.where(members_of > 2).select(
        "key", (members_of > wide).alias("wide")), "signature-more")
    members = stage(keyed.join(more, "key"), "signature-members")
    narrow = members.where("NOT wide")
    first = narrow.where("NOT bit").select("key", F.col("fp").alias("a"))
    second = narrow.select("key", F.col("fp").alias("b"), "bit")
    joined = first.join(second, "key").where(
        F.when(_whole(), F.col("a") < F.col("b")).otherwise(F.col("bit")) & _close("a", "b"))
    return pairs.where(_close("a", "b")).union(joined.select("a", "b")).union(
        _finer(members.where("wide").select("key", "fp"))).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    wide: int = WIDE) -> DataFrame:
    """One row per input row: doc_id, fp, fingerprint (hex), component_id."""
    prints = stage(simhash(docs, doc_id, text), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "fingerprint-nodes")
    roots = stage(connected_components(near_links(nodes, wide)), "fingerprint-roots")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low_id", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "fingerprint-rooted")
    lows = stage(rooted.groupBy("root").agg(F.min("low_id").alias("component_id")),
                 "component-ids")
    labels = stage(rooted.join(lows, "root").select("fp", "component_id"), "fingerprint-labels")
    return prints.join(labels, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id.

    Rows without an id stay, as they cannot be told apart; repeated ids all stay where theirs
    is the smallest.
    """
    gone = stage(near_duplicates(docs, doc_id, text).where("doc_id <> component_id").select(
        F.col("doc_id").alias("__gone")).distinct(), "near-gone")
    return docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")
