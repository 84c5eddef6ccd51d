"""Near duplicates by a chosen-path similarity join over word shingles.

A text is the set of its distinct word shingles; sets link where 100 * intersection is at least
``percent`` * union. Every distinct set has ``COORDINATES`` minwise tokens. A tree starts with all
sets in one node; a node chooses each coordinate with probability 1 / (similarity *
``COORDINATES``), by a hash of its path, and sends its sets to one child per chosen coordinate
and minwise token. So two linked sets are expected to share one child at least, unlike ones part
quickly. ``trees_for`` independent trees reach the target recall.

Two linked sets meet in most of the nodes below the roots. A set that has company in too few of
them to link with any other (``least_common``) is left out before anything is compared.

Nodes of up to ``leaf`` sets are compared whole, each as one row, by minwise tokens in NumPy; pairs
never are rows. A pair that meets in several such nodes is taken in the first one only. In
larger nodes the set that most others meet somewhere (the pivot) is compared with all, sets
already known to be of one component are not compared again, nodes within one component are done
and only those that mix components branch on. A group of near copies thus costs a comparison
per member, not per pair. A larger node also counts as small if the sets outside its pivot's
component, times all its sets, are no more comparisons than a node of ``leaf`` may take, and it
has ``WIDEST_LEAF`` times as many sets at most; its parts are compared two by two.
Pairs whose sizes, 128-bit sketches or minwise tokens rule them out are skipped; each filter loses
a linked pair with probability below 1e-7. All others are confirmed on the full sets, in
units of up to twice ``CHECK_SETS`` sets that hold each set once however many pairs it is in, and
pairs already connected within their unit are not confirmed.

Full sets are made only for candidates: a second pass over the texts is thinned by a bitmap of
fixed size over text hashes and then joined by the set's 128-bit digest.

Defined results: A-Z is lower-cased, words are runs of other characters than space and
control-range white space; a text with fewer words than a shingle is one shingle of them all;
null, empty and wordless texts have no shingle and link with nothing. Shingles are told apart by
64-bit hashes, those of the two sets of a pair by ``HASH_BYTES`` bytes of them, sets by 128-bit
ones. Repeated rows are copies of each other; a null id joins its component but never names it (a
component of null ids only has a null id). Only the two named columns are read. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.batches import raw_texts, slices
from turnstile.llm.components import connected_components
from turnstile.llm.simhash_dedup import shingle_hashes
from turnstile.session import stage

SHINGLE_WORDS = 5
PERCENT = 85
RECALL = 0.9999
USUAL_DEPTH = 3
COORDINATES = 128
LEAF_SETS = 4096
WIDEST_LEAF = 4
CHECK_SETS = 256
DEEPEST = 48
LOSS = 1e-7
MOST_UNLIKE_BITS = 30
OWNERS = 62
SLICE_BYTES = 1 << 20
BITMAP_BITS = 1 << 25
SEEN_TEXTS = 100_000
HASH_BYTES = 6
SEED = 11
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(count: int, salt: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, count + 1, dtype=np.uint64) + np.uint64(salt << 20)) * STEP)


def trees_for(recall: float, depth: int = USUAL_DEPTH) -> int:
    """Trees until two sets at the least similarity share a node of that depth somewhere.

    They share one expected child per level, so a tree keeps them with the survival probability
    of a critical branching process.
    """
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def least_common(weights: list[int], percent: int) -> int:
    """The smallest weight of agreeing coordinates that linked sets miss with probability ``LOSS``
    at most, if each coordinate agrees with probability ``percent`` / 100 on its own."""
    alike = percent / 100
    chance = np.ones(1)
    for w in weights:
        chance = np.pad(chance * (1 - alike), (0, w)) + np.pad(chance * alike, (w, 0))
    return int(np.searchsorted(np.cumsum(chance), LOSS, side="right"))


class Branching(NamedTuple):
    """Choice of coordinates by path: a threshold on a hash."""

    below: np.uint64

    @classmethod
    def at(cls, percent: int) -> Branching:
        return cls(np.uint64(min(2**64 - 1, int(2**64 * 100 / (percent * COORDINATES)))))

    def chosen(self, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, coordinate) of every choice."""
        salts = numbered(COORDINATES, SEED + 1)
        return np.nonzero(mix(paths[:, None] ^ salts[None, :]) < self.below)

    @staticmethod
    def children(paths: np.ndarray, coordinates: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        place = (coordinates.astype(np.uint64) << np.uint64(32)) | tokens.astype(np.uint64)
        return mix(paths * STEP + mix(place + np.uint64(1)))


def token_set(raw: bytes, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(np.array(shingle_hashes(raw, words), np.uint64))


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """COORDINATES minwise tokens of every set; empty sets have zeros."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), COORDINATES), np.uint32)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
    flips, factors = numbered(COORDINATES, SEED + 2), numbered(COORDINATES, SEED + 3) | np.uint64(1)
    room = np.empty_like(flat)
    for c in range(COORDINATES):
        np.bitwise_xor(flat, flips[c], out=room)
        np.multiply(room, factors[c], out=room)
        out[full, c] = np.minimum.reduceat(room, starts) >> np.uint64(32)
    return out


def sketches(tokens: np.ndarray) -> np.ndarray:
    """Two 64-bit words per row: one bit of every minwise token."""
    bits = np.packbits((tokens & 1).astype(np.uint8), axis=1)
    return np.ascontiguousarray(bits).view("<i8")


def _brief(tokens: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    full = np.ascontiguousarray(tokens[:, firsts].astype("<u4")).view(np.uint8)
    return np.concatenate((full.reshape(len(tokens), -1), tokens.astype(np.uint8)), axis=1)


def _is_new(seen: dict, key: object) -> bool:
    """Whether ``key`` is not among the last ``SEEN_TEXTS`` different ones, which it joins."""
    if key in seen:
        return False
    if len(seen) >= SEEN_TEXTS:
        seen.pop(next(iter(seen)))
    seen[key] = None
    return True


def _packed(sets: list[np.ndarray]) -> pa.Array:
    """The low ``HASH_BYTES`` bytes of every hash, as one binary value per set."""
    return pa.array([s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()
                     for s in sets], pa.binary())


def _unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // HASH_BYTES, 8), np.uint8)
    wide[:, :HASH_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, HASH_BYTES)
    return np.sort(wide.view("<u8").ravel())


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit words per set."""
    raw = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.col(text).cast("string")
    return docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"),
                       F.xxhash64(whole).alias("text_hash"))


def signed_rows(source: DataFrame, words: int, firsts: np.ndarray) -> DataFrame:
    """doc_id, text_hash, n_shingles, d0, d1 (digest of the set), tokens (minwise), brief (the
    tokens of the coordinates ``firsts``, then the low byte of all), k0, k1, fresh.

    The first row of a set in its task is always fresh, most later ones are not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], None] = {}
        for part in slices(batches, limit=SLICE_BYTES):
            sets = [token_set(raw, words) for raw in raw_texts(part)]
            tokens = minwise(sets)
            digest, bits = _digests(sets), sketches(tokens)
            fresh = [_is_new(seen, (d0, d1)) for d0, d1 in digest.tolist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(digest[:, 0]),
                 pa.array(digest[:, 1]), _binary(tokens), _binary(_brief(tokens, firsts)),
                 pa.array(bits[:, 0].copy()), pa.array(bits[:, 1].copy()), pa.array(fresh)],
                names=["doc_id", "text_hash", "n_shingles", "d0", "d1", "tokens", "brief", "k0",
                       "k1", "fresh"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, text_hash long, n_shingles long, d0 long, "
                                  "d1 long, tokens binary, brief binary, k0 long, k1 long, fresh boolean")


def _token_matrix(batch: pa.RecordBatch) -> np.ndarray:
    raw = b"".join(batch.column("tokens").to_pylist())
    return np.frombuffer(raw, np.uint32).reshape(-1, COORDINATES)


def first_nodes(sets: DataFrame, trees: int, branching: Branching) -> DataFrame:
    """sid, path, j: every set in the children of every root, which ``j`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = numbered(trees, SEED + 4)
        tree, coordinate = branching.chosen(roots)
        for batch in batches:
            tokens, sid = _token_matrix(batch), np.asarray(batch.column("sid"))
            for at in range(0, len(sid), 4096):
                some = tokens[at:at + 4096][:, coordinate]
                paths = branching.children(np.broadcast_to(roots[tree], some.shape),
                                           np.broadcast_to(coordinate, some.shape), some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(sid[at:at + 4096], len(tree))),
                     pa.array(paths.ravel().view(np.int64)),
                     pa.array(np.tile(np.arange(len(tree), dtype=np.int16), len(some)))],
                    names=["sid", "path", "j"])

    return sets.select("sid", "tokens").mapInArrow(run, "sid long, path long, j short")


def next_nodes(nodes: DataFrame, sets: DataFrame, branching: Branching) -> DataFrame:
    """sid, path: every set of ``nodes`` in the children that its node chooses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sid = _token_matrix(batch), np.asarray(batch.column("sid"))
            paths = np.asarray(batch.column("path")).view(np.uint64)
            for at in range(0, len(sid), 4096):
                row, coordinate = branching.chosen(paths[at:at + 4096])
                row = row + at
                below = branching.children(paths[row], coordinate, tokens[row, coordinate])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sid[row]), pa.array(below.view(np.int64))], names=["sid", "path"])

    return nodes.select("sid", "path").join(sets.select("sid", "tokens"), "sid").mapInArrow(
        run, "sid long, path long")


def _crowded(nodes: DataFrame) -> DataFrame:
    """Nodes with several sets, with their number."""
    sizes = nodes.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
    return nodes.drop("n").join(sizes, "path")


def _sociable(nodes: DataFrame, least: int) -> DataFrame:
    """The rows of sets that are in ``least`` nodes at least."""
    return nodes.withColumn("meets", F.count("*").over(Window.partitionBy("sid"))).where(
        F.col("meets") >= least).drop("meets")


def likely_nodes(signed: DataFrame, sets: DataFrame, trees: int, branching: Branching,
                 percent: int, leaf: int) -> DataFrame:
    """sid, path, j, n, size, k0, k1, met, mask: the first nodes, without sets that link with none.

    Two linked sets share most of their first nodes, so a set with company in few of them is
    left out, and the nodes are counted again without it. ``met`` adds up the company, ``mask``
    has a bit for each of the first ``OWNERS`` nodes that is compared whole.
    """
    _, coordinates = branching.chosen(numbered(trees, SEED + 4))
    least = least_common(np.bincount(coordinates)[np.unique(coordinates)].tolist(), percent)
    some = stage(_sociable(_crowded(first_nodes(signed, trees, branching)).join(
        sets.select("sid"), "sid", "left_semi"), least), "crowded-nodes")
    again = _sociable(_crowded(some).join(sets.select("sid", "size", "k0", "k1"), "sid"), least)
    whole = F.when((F.col("n") <= leaf) & (F.col("j") < OWNERS),
                   F.expr("shiftleft(1L, int(j))")).otherwise(0)
    by_set = Window.partitionBy("sid")
    return stage(again.withColumns({"met": F.sum("n").over(by_set),
                                    "mask": F.bit_or(whole).over(by_set)}), "likely-nodes")


def _mixed(nodes: DataFrame, facts: DataFrame, roots: DataFrame) -> DataFrame:
    """Sets of the nodes that hold several components, each with its node's size and pivot.

    ``others`` counts the sets of the node outside the pivot's component.
    """
    own = nodes.select("sid", "path").join(facts, "sid").join(roots, "sid", "left").select(
        "path", "sid", "size", "k0", "k1", "met", "mask", F.coalesce("root", "sid").alias("root"))
    seen = ("met", "sid", "size", "k0", "k1")
    parts = own.groupBy("path", "root").agg(
        F.count("*").alias("c"), F.max(F.struct(*seen)).alias("p"))
    several = parts.groupBy("path").agg(
        F.sum("c").alias("n"), F.count("*").alias("parts"),
        F.max(F.struct(*[f"p.{c}" for c in seen], "root", "c")).alias("pivot")).where(
        "parts > 1").select("path", "n", "pivot", (F.col("n") - F.col("pivot.c")).alias("others"))
    return stage(own.join(several, "path"), "nodes-mixed")


def _is_small(limit: int) -> Column:
    return (F.col("n") <= limit) | ((F.col("others") * F.col("n") <= limit * limit)
                                    & (F.col("n") <= WIDEST_LEAF * limit))


def _may_link(a: str, b: str, percent: int) -> Column:
    size_a, size_b = F.col(f"{a}.size"), F.col(f"{b}.size")
    unlike = sum((F.bit_count(F.col(f"{a}.{k}").bitwiseXOR(F.col(f"{b}.{k}")))
                  for k in ("k0", "k1")), F.lit(0))
    return ((F.col(f"{a}.root") != F.col(f"{b}.root")) & (unlike <= MOST_UNLIKE_BITS)
            & (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)))


def pivot_units(mixed: DataFrame, percent: int) -> DataFrame:
    """unit, members, pairs: the pivot first, to be checked with all other members (no pairs)."""
    rows = mixed.select(F.struct("sid", "size", "k0", "k1", "root").alias("x"), "pivot", "n")
    pairs = rows.where(_may_link("x", "pivot", percent)).groupBy(
        F.col("pivot.sid").alias("p"), F.col("x.sid").alias("x")).agg(F.max("n").alias("n"))
    part = F.pmod(F.xxhash64("x"), F.ceil(F.col("n") / CHECK_SETS)).alias("part")
    units = pairs.groupBy("p", part).agg(F.collect_list("x").alias("xs"))
    return _numbered(units.select(F.concat(F.array("p"), "xs").alias("members"),
                                  F.lit(None).cast("binary").alias("pairs")))


def _numbered(units: DataFrame) -> DataFrame:
    return stage(units.select(F.monotonically_increasing_id().alias("unit"), "*"), "units")


def _alike(rows: dict[str, np.ndarray], percent: int,
           least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a node that may link and meet in no earlier node compared whole."""
    firsts = rows["brief"].shape[1] // 4 - COORDINATES // 4
    first = np.ascontiguousarray(rows["brief"][:, :4 * firsts]).view("<u4")
    low = np.ascontiguousarray(rows["brief"][:, 4 * firsts:])
    bits = np.ascontiguousarray(np.packbits(low & 1, axis=1)).view("<u8")
    size, root, part, n = rows["size"], rows["root"], rows["part"], len(low)
    earlier = np.arange(min(firsts, OWNERS, int(rows["j"][0])))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    step = max(1, (1 << 20) // n)
    for at in range(0, n, step):
        me = slice(at, at + step)
        unlike = np.bitwise_count(bits[me, None, 0] ^ bits[None, :, 0])
        unlike = unlike + np.bitwise_count(bits[me, None, 1] ^ bits[None, :, 1])
        fits = (unlike <= MOST_UNLIKE_BITS) & (root[me, None] != root) & (
            100 * np.minimum(size[me, None], size) >= percent * np.maximum(size[me, None], size))
        # A unit of two parts leaves the pairs within a part to the unit of that part.
        fits &= (part[me, None] < part) | ((part[me, None] == part) & (part[0] == part).all()
                                           & (np.arange(at, min(at + step, n))[:, None] < np.arange(n)))
        a, b = np.nonzero(fits)
        a += at
        for lo in range(0, len(a), 1 << 16):
            x, y = a[lo:lo + (1 << 16)], b[lo:lo + (1 << 16)]
            near = (low[x] == low[y]).sum(axis=1) >= least
            x, y = x[near], y[near]
            whole = (rows["mask"][x, None] >> earlier & 1).astype(bool)
            new = ~((first[x][:, earlier] == first[y][:, earlier]) & whole).any(axis=1)
            found.append((x[new], y[new]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def leaf_units(members: DataFrame, signed: DataFrame, percent: int, leaf: int) -> DataFrame:
    """unit, members, pairs: the sets to be checked on full sets, the pairs as positions there.

    ``members``: path, sid, j, n, size, mask, root. A node is compared whole in one row, one above
    ``leaf`` sets in a row for every two of its parts. A pair is found in one of the first nodes
    only, and a unit holds ``CHECK_SETS`` sets of either side at most.
    """
    least = least_common([1] * COORDINATES, percent)
    parts = F.ceil(F.col("n") / leaf)
    rows = members.join(signed.select("sid", "brief"), "sid").select(
        "path", F.pmod(F.xxhash64("sid"), parts).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"),
        "sid", "size", "mask", "j", "root", "brief")
    nodes = rows.groupBy("path", F.least("part", "other"), F.greatest("part", "other")).agg(
        F.collect_list(F.struct("sid", "size", "mask", "j", "root", "part", "brief")).alias("sets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("sets")
            flat, ends = column.flatten(), column.offsets.to_numpy()
            ends = ends - ends[0]
            held = {c: flat.field(c).to_numpy(zero_copy_only=False)
                    for c in ("sid", "size", "mask", "j", "root", "part")}
            brief = b"".join(flat.field("brief").to_pylist())
            held["brief"] = np.frombuffer(brief, np.uint8).reshape(len(flat), -1)
            members, pairs = [], []
            for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                if end - start < 2:
                    continue
                node = {c: v[start:end] for c, v in held.items()}
                a, b = _alike(node, percent, least)
                block = (a // CHECK_SETS << 32) + b // CHECK_SETS
                order = np.argsort(block, kind="stable")
                for at in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                    if len(at):
                        used, place = np.unique(np.concatenate((a[at], b[at])), return_inverse=True)
                        members.append(node["sid"][used])
                        pairs.append(place.astype("<i4").tobytes())
            if members:
                offsets = np.cumsum([0, *map(len, members)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(members)))
                yield pa.RecordBatch.from_arrays([lists, pa.array(pairs, pa.binary())],
                                                 names=["members", "pairs"])

    return _numbered(nodes.select("sets").mapInArrow(run, "members array<long>, pairs binary"))


def _linked(mine: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets ``others`` link with the set ``mine``."""
    linked = np.zeros(len(others), bool)
    for at in range(0, len(others), 64):
        some = others[at:at + 64]
        sizes = np.array([len(o) for o in some])
        flat = np.concatenate(some)
        spot = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
        common = np.add.reduceat((mine[spot] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
        linked[at:at + 64] = 100 * common >= percent * (len(mine) + sizes - common)
    return linked


def _unit_links(full: list[np.ndarray], a: np.ndarray, b: np.ndarray,
                percent: int) -> list[tuple[int, int]]:
    """Links that connect what the linked pairs of a unit connect.

    The member with most pairs goes first; pairs already connected are not checked.
    """
    label, links = np.arange(len(full)), []
    around = np.bincount(np.concatenate((a, b)), minlength=len(full))
    for me in np.argsort(-around, kind="stable").tolist():
        mine = (a == me) | (b == me)
        near = np.where(a[mine] == me, b[mine], a[mine])
        a, b = a[~mine], b[~mine]
        near = near[label[near] != label[me]]
        if len(near):
            for x in near[_linked(full[me], [full[x] for x in near.tolist()], percent)].tolist():
                if label[x] != label[me]:
                    label[label == label[x]] = label[me]
                    links.append((me, x))
        if not len(a):
            break
    return links


def check_units(units: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect what the linked pairs of the units connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                sets, members = batch.column("sets")[i].values, batch.column("members")[i].as_py()
                by_sid = dict(zip(sets.field("sid").to_pylist(), sets.field("hashes").to_pylist(),
                                  strict=True))
                full = [_unpacked(by_sid[sid]) for sid in members]
                packed = batch.column("pairs")[i].as_py()
                if packed is None:
                    x, y = np.zeros(len(full) - 1, np.int64), np.arange(1, len(full))
                else:
                    x, y = np.frombuffer(packed, "<i4").astype(np.int64).reshape(2, -1)
                for m, n in _unit_links(full, x, y, percent):
                    a.append(members[m])
                    b.append(members[n])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])

    return units.mapInArrow(run, "a long, b long")


def full_sets(source: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """sid, hashes of the ``wanted`` sets (sid, d0, d1, text_hash)."""
    # Spark counts bits from 1, in buckets numbered from 1.
    bit = F.pmod("text_hash", F.lit(BITMAP_BITS)) + 1
    marks = wanted.select(bit.alias("bit")).groupBy(
        F.expr("bitmap_bucket_number(bit)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect()
    held = {row["bucket"]: bytes(row["bits"]) for row in marks}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(BITMAP_BITS // 8, np.uint8)
        for bucket, bits in held.items():
            at = (bucket - 1) * len(bits)
            bitmap[at:at + len(bits)] = np.frombuffer(bits, np.uint8)
        seen: dict[int, None] = {}
        for batch in batches:
            hashes = np.asarray(batch.column("text_hash"))
            place = hashes % BITMAP_BITS
            hit = bitmap[place // 8] >> (place % 8).astype(np.uint8) & 1
            fresh = []
            for i in np.flatnonzero(hit).tolist():
                if _is_new(seen, int(hashes[i])):
                    fresh.append(i)
            chosen = batch.take(pa.array(fresh, pa.int64()))
            for part in slices(iter([chosen]), limit=SLICE_BYTES):
                sets = [token_set(raw, words) for raw in raw_texts(part)]
                digest = _digests(sets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()),
                     _packed(sets)], names=["d0", "d1", "hashes"])

    made = source.select("text", "text_hash").mapInArrow(
        run, "d0 long, d1 long, hashes binary")
    return made.join(wanted.select("sid", "d0", "d1"), ["d0", "d1"]).select(
        "sid", "hashes").dropDuplicates(["sid"])


class Confirmed:
    """Links confirmed on full sets so far, and the components that they make."""

    def __init__(self, source: DataFrame, sets: DataFrame, words: int, percent: int):
        self.source, self.sets, self.words, self.percent = source, sets, words, percent
        spark = source.sparkSession
        self.full = spark.createDataFrame([], "sid long, hashes binary")
        self.links = spark.createDataFrame([], "a long, b long")
        self.roots = spark.createDataFrame([], "sid long, root long")

    def add(self, units: DataFrame) -> DataFrame:
        """Check units; their links."""
        asked = units.select("unit", F.explode("members").alias("sid"))
        ids = asked.select("sid").distinct().join(self.full.select("sid"), "sid", "left_anti")
        wanted = stage(self.sets.select("sid", "d0", "d1", "text_hash").join(ids, "sid"),
                       "sets-wanted")
        if not wanted.isEmpty():
            self.full = self.full.union(stage(
                full_sets(self.source, wanted, self.words), "sets-full"))
        held = asked.join(self.full, "sid").groupBy("unit").agg(
            F.collect_list(F.struct("sid", "hashes")).alias("sets"))
        links = stage(check_units(units.join(held, "unit"), self.percent), "links")
        self.links = self.links.union(links)
        return links

    def merge(self, links: DataFrame) -> None:
        """Hook labels that new links join onto the smallest of them, over two steps.

        Equal labels mean one component, not the reverse: that saves comparisons, while the
        components themselves are made once, from all links.
        """
        of = lambda side: self.roots.select(F.col("sid").alias(side), F.col("root").alias(f"root_{side}"))
        hooks = stage(links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
            F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y")
        ).where("x <> y").groupBy(F.greatest("x", "y").alias("node")).agg(
            F.min(F.least("x", "y")).alias("top")), "label-hooks")
        if hooks.isEmpty():
            return
        again = hooks.select(F.col("node").alias("top"), F.col("top").alias("higher"))
        tops = stage(hooks.join(again, "top", "left").select(
            "node", F.coalesce("higher", "top").alias("top")), "label-tops")
        lifted = self.roots.join(tops, F.col("root") == F.col("node"), "left").select(
            "sid", F.coalesce("top", "root").alias("root"))
        fresh = tops.join(self.roots, F.col("node") == F.col("sid"), "left_anti").select(
            F.col("node").alias("sid"), F.col("top").alias("root"))
        self.roots = stage(lifted.union(fresh), "set-labels")

    def components(self) -> DataFrame:
        """(sid, root) of all sets with a link."""
        return stage(connected_components(self.links).withColumnRenamed("node", "sid"), "set-roots")


def _large_nodes(known: Confirmed, nodes: DataFrame, signed: DataFrame, branching: Branching,
                 leaf: int) -> None:
    """Check nodes above ``leaf`` sets: pivots first, then branches of those that mix components."""
    facts = stage(nodes.groupBy("sid").agg(*(F.first(c).alias(c) for c in (
        "size", "k0", "k1", "met", "mask"))), "set-facts")
    known.merge(known.links)
    mixed, depth = _mixed(nodes, facts, known.roots), 1
    while not mixed.isEmpty():
        known.merge(known.add(pivot_units(mixed, known.percent)))
        mixed = _mixed(mixed, facts, known.roots)
        small = _is_small(leaf) if depth < DEEPEST else F.lit(True)
        known.merge(known.add(leaf_units(
            mixed.where(small).withColumn("j", F.lit(OWNERS)), signed, known.percent, leaf)))
        large = mixed.where(~small)
        if large.isEmpty():
            return
        below = stage(next_nodes(large, signed, branching), "next-nodes")
        mixed, depth = _mixed(_crowded(below), facts, known.roots), depth + 1


def similar_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 words: int = SHINGLE_WORDS, percent: int = PERCENT, recall: float = RECALL,
                 leaf: int = LEAF_SETS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id reachable)."""
    source = _source(docs, doc_id, text)
    branching, trees = Branching.at(percent), trees_for(recall)
    _, firsts = branching.chosen(numbered(trees, SEED + 4))
    rows = stage(signed_rows(source, words, firsts).select(
        F.monotonically_increasing_id().alias("row"), "*"), "signed-rows")
    sets = stage(rows.where("n_shingles > 0").groupBy("d0", "d1").agg(
        F.min("row").alias("sid"), F.first("n_shingles").alias("size"), F.first("k0").alias("k0"),
        F.first("k1").alias("k1"), F.min("text_hash").alias("text_hash"),
        F.min("doc_id").alias("low_id")), "distinct-sets")
    # A set goes by its first row, which is fresh: minwise tokens stay where they were made.
    signed = rows.where("n_shingles > 0 AND fresh").select(
        F.col("row").alias("sid"), "tokens", "brief")
    nodes = likely_nodes(signed, sets, trees, branching, percent, leaf)
    known = Confirmed(source, sets, words, percent)
    known.add(leaf_units(nodes.where(F.col("n") <= leaf).withColumn("root", F.col("sid")), signed,
                         percent, leaf))
    large = nodes.where(F.col("n") > leaf)
    if not large.isEmpty():
        _large_nodes(known, large, signed, branching, leaf)
    rooted = stage(sets.select("sid", "d0", "d1", "low_id").join(
        known.components(), "sid", "left").select(
        "d0", "d1", "low_id", F.coalesce("root", "sid").alias("root")), "sets-rooted")
    lows = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = stage(rooted.join(lows, "root").select("d0", "d1", "component_id", F.lit(True).alias("set")),
                  "sets-named")
    return rows.select("doc_id", "n_shingles", "d0", "d1").join(named, ["d0", "d1"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("set"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
