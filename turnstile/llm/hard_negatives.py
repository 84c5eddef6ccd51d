"""Hard negatives by exact search in STR-packed R-trees.

The table is range-sorted by (label, first component, id) over the cluster. Every
``TILE_ROWS`` consecutive rows are one tile: a small R-tree packed by sort-tile-recursive on the
coordinates that spread most in it, whose leaves hold one label and whose nodes are bounding
boxes. The inner product of an anchor with a box lies in an interval that follows from each
coordinate's bounds. A best-first queue visits boxes by their upper end and drops those that
are outside every score window or strictly below the worst of the best ``k`` found, so results
are exact, ties included.

Anchors are searched in blocks of ``BLOCK_ROWS`` against every tile: first for their best rows of
the same label (the positives), then, with one score window per positive, for the best rows of
other labels. A tile returns its best few per anchor; those of all tiles are ranked by a window.
Blocks and tiles meet by shuffle: a block goes to every group of tiles, which Spark's estimate of
the few blocks does not tell, so they would be broadcast through the driver.

Defined results: rows with a null id, label or vector, or with a null or non-finite component,
take no part. A component is floor(scale * x) and saturates at 64 bits, as do scores. Shorter
vectors count as filled with zeros. Repeated rows are rows of their own, but never positives of
an anchor with their id; a repeated anchor has its result as often as it is there. Equal scores
come by smaller id. Anchors without positives give no rows; an empty table gives an empty result.
Only the three named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.session import by_key, stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
TILE_ROWS = 4096
LEAF_ROWS = 64
FANOUT = 8
SPREAD_COORDINATES = 3
FIRST_LEAVES = 6
BLOCK_ROWS = 256
TILES_PER_TASK = 4
# Bounds of ranges come from rows sampled for each of them on the driver.
RANGES = 512
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                  label: str = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label, vector (integers) of the rows that take part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(
        F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & usable
    ).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
             F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vector"))


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros."""
    sizes = np.asarray(lists.value_lengths())
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = np.asarray(lists.flatten())
    return out


def widen(values: np.ndarray, width: int) -> np.ndarray:
    return np.pad(values, ((0, 0), (0, width - values.shape[1])))


class Tree(NamedTuple):
    """Rows in packed order, and per level (leaves first) the first row of each box and its
    bounds. Boxes of a level hold ``FANOUT`` boxes of the one below, or rows of one label."""

    ids: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    firsts: list[np.ndarray]
    lows: list[np.ndarray]
    highs: list[np.ndarray]


def str_order(vectors: np.ndarray, rows: np.ndarray, axes: list[int]) -> Iterator[np.ndarray]:
    """Rows cut into leaves: sorted by one axis into slabs, each by the next axis, and so on."""
    leaves = -(-len(rows) // LEAF_ROWS)
    if leaves <= 1:
        yield rows
        return
    rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
    slabs = leaves if len(axes) == 1 else int(np.ceil(leaves ** (1 / len(axes))))
    per_slab = LEAF_ROWS * -(-leaves // slabs)
    for at in range(0, len(rows), per_slab):
        yield from str_order(vectors, rows[at:at + per_slab], axes[1:] or axes)


def pack(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    """The R-tree of one tile."""
    spread = np.ptp(vectors.astype(float), axis=0) if vectors.size else np.zeros(0)
    axes = np.argsort(-spread, kind="stable")[:SPREAD_COORDINATES].tolist()
    leaves = []
    for label in np.unique(labels):
        rows = np.flatnonzero(labels == label)
        leaves += str_order(vectors, rows, axes) if axes else [rows]
    order = np.concatenate(leaves)
    first = np.cumsum([0, *map(len, leaves)])[:-1]
    packed = vectors[order]
    firsts, lows, highs = [first], [np.minimum.reduceat(packed, first)], [
        np.maximum.reduceat(packed, first)]
    while len(firsts[-1]) > FANOUT:
        at = np.arange(0, len(firsts[-1]), FANOUT)
        firsts.append(firsts[-1][at])
        lows.append(np.minimum.reduceat(lows[-1], at))
        highs.append(np.maximum.reduceat(highs[-1], at))
    return Tree(ids[order], packed, labels[order], firsts, lows, highs)


def exact_in_floats(a: np.ndarray, b: np.ndarray) -> bool:
    top = [float(np.abs(x.astype(float)).max()) if x.size else 0.0 for x in (a, b)]
    return top[0] * top[1] * max(1, a.shape[1]) < EXACT


class Searcher:
    """One tile ready for many anchors of the same block."""

    def __init__(self, tree: Tree, anchors: np.ndarray):
        width = max(tree.vectors.shape[1], anchors.shape[1])
        self.tree = tree
        self.floats = exact_in_floats(widen(tree.vectors, width), widen(anchors, width))
        kind = float if self.floats else object
        self.vectors = widen(tree.vectors, width).astype(kind)
        self.anchors = widen(anchors, width).astype(kind)
        self.ends = [np.append(f[1:], len(tree.ids)) for f in tree.firsts]
        self.leaf_rows = [np.arange(s, e) for s, e in zip(tree.firsts[0], self.ends[0], strict=True)]
        self.leaf_labels = tree.labels[tree.firsts[0]]
        self.upper, self.lower = self._intervals() if self.floats else ([], [])

    def _intervals(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Bounds of the inner product of every anchor with every box, level by level."""
        plus, minus = np.maximum(self.anchors, 0), np.minimum(self.anchors, 0)
        width, upper, lower = self.anchors.shape[1], [], []
        for low, high in zip(self.tree.lows, self.tree.highs, strict=True):
            low, high = widen(low, width).T, widen(high, width).T
            upper.append(plus @ high + minus @ low)
            lower.append(plus @ low + minus @ high)
        return upper, lower

    def scores(self, anchor: int, leaves: list[int], rows: np.ndarray) -> np.ndarray:
        """Inner products of the rows of some leaves; many leaves are not copied first."""
        if 4 * len(leaves) > len(self.leaf_rows):
            found = (self.vectors @ self.anchors[anchor])[rows]
        else:
            found = self.vectors[rows] @ self.anchors[anchor]
        if self.floats:
            return found.astype(np.int64)
        return np.array([min(max(int(s), LONG.min), LONG.max) for s in found], np.int64)

    def best(self, anchor: int, fits: np.ndarray, windows: list[tuple[int, int]], k: int,
             excluded: int | None = None) -> list[list[tuple[int, int]]]:
        """Per window the best ``k`` (score, id) among the leaves that fit, by score, then id."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        worst = [low for low, _ in windows]

        def wanted(upper: float, lower: float) -> bool:
            for floor, (_, high) in zip(worst, windows, strict=True):
                if upper >= floor and lower <= high and high >= floor:
                    return True
            return False

        if not self.floats:
            self._take(anchor, np.flatnonzero(fits).tolist(), windows, k, excluded, found, worst)
            return found
        top = len(self.upper) - 1
        queue = [(-u, top, i) for i, u in enumerate(self.upper[top][anchor].tolist())]
        heapq.heapify(queue)
        at_once, leaves = FIRST_LEAVES, []
        while queue or leaves:
            if not queue or len(leaves) == at_once:
                self._take(anchor, leaves, windows, k, excluded, found, worst)
                leaves, at_once = [], at_once * 3
                continue
            negative, level, box = heapq.heappop(queue)
            if not wanted(-negative, float(self.lower[level][anchor, box])):
                continue
            if level:
                below = range(box * FANOUT, min((box + 1) * FANOUT, len(self.ends[level - 1])))
                for child in below:
                    if level > 1 or fits[child]:
                        heapq.heappush(
                            queue, (-float(self.upper[level - 1][anchor, child]), level - 1, child))
            elif fits[box]:
                leaves.append(box)
        return found

    def _take(self, anchor: int, leaves: list[int], windows: list[tuple[int, int]], k: int,
              excluded: int | None, found: list[list[tuple[int, int]]], worst: list[int]) -> None:
        """Score the rows of some leaves and keep the best of each window."""
        if not leaves:
            return
        rows = np.concatenate([self.leaf_rows[i] for i in leaves])
        scores = self.scores(anchor, leaves, rows)
        near = np.flatnonzero((scores >= min(worst)) & (scores <= max(h for _, h in windows)))
        scores, ids = scores[near], self.tree.ids[rows[near]]
        if excluded is not None:
            scores, ids = scores[ids != excluded], ids[ids != excluded]
        for w, (_, high) in enumerate(windows):
            hit = np.flatnonzero((scores >= worst[w]) & (scores <= high))
            if not len(hit):
                continue
            if len(hit) > k:
                least = np.partition(scores[hit], -k)[-k]
                hit = hit[scores[hit] >= least]
                hit = hit[np.lexsort((ids[hit], -scores[hit]))][:k]
            merged = found[w] + list(zip(scores[hit].tolist(), ids[hit].tolist(), strict=True))
            found[w] = sorted(merged, key=lambda p: (-p[0], p[1]))[:k]
            if len(found[w]) == k:
                worst[w] = found[w][-1][0]


TILE = "ids binary, labels binary, vectors binary, width int"


def build_tiles(vectors: DataFrame, n_tiles: int) -> DataFrame:
    """One row per tile: its rows in packed order. Boxes are derived from them when read."""

    def tile(rows: pa.Table) -> pa.RecordBatch:
        part = rows.combine_chunks().to_batches()[0]
        values = matrix(part.column("vector"))
        return pa.RecordBatch.from_arrays(
            [pa.array([np.asarray(part.column("vec_id")).tobytes()]),
             pa.array([np.asarray(part.column("label")).tobytes()]),
             pa.array([values.tobytes()]), pa.array([values.shape[1]], pa.int32())],
            names=["ids", "labels", "vectors", "width"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rest = rows if rest is None else pa.concat_tables([rest, rows])
            while rest.num_rows >= TILE_ROWS:
                yield tile(rest.slice(0, TILE_ROWS))
                rest = rest.slice(TILE_ROWS)
        if rest is not None and rest.num_rows:
            yield tile(rest)

    keyed = vectors.withColumn("lead", F.try_element_at("vector", F.lit(1)))
    order = ["label", "lead", "vec_id"]
    return keyed.repartitionByRange(min(n_tiles, RANGES), *order).sortWithinPartitions(*order).select(
        "vec_id", "label", "vector").mapInArrow(run, TILE)


def read_tile(row: dict) -> Tree:
    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
    return pack(ids, labels, np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["width"]))


def _meet(queries: DataFrame, tiles: DataFrame, n_tiles: int) -> DataFrame:
    """Every block of queries beside every tile, dealt over groups of tiles of one size."""
    block = F.expr(f"key - pmod(key, {BLOCK_ROWS})").alias("block")
    blocks = queries.groupBy(block).agg(F.collect_list(F.struct(*queries.columns)).alias("queries"))
    groups = max(1, -(-n_tiles // TILES_PER_TASK))
    # The number of a tile holds its partition in the upper bits and its place there in the others.
    number = F.shiftright("tile", 33) + F.col("tile").bitwiseAND((1 << 33) - 1) * RANGES
    dealt = tiles.withColumn("deal", F.pmod(number, F.lit(groups)))
    spread = blocks.select("block", "queries",
                           F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("deal"))
    # Few bytes and much work: the number of partitions is given, so that Spark does not merge them.
    parts = min(groups, RANGES)
    return by_key(spread.repartition(parts, "deal")).join(
        by_key(dealt.repartition(parts, "deal")), "deal").select(
        "queries", "tile", "ids", "labels", "vectors", "width")


FOUND = "key long, slot int, found_id long, score long"


def _answers(met: DataFrame, k: int) -> DataFrame:
    """key, slot, found_id, score: the best ``k`` rows of each tile for every query and window.

    A query without windows looks for rows of its own label, else for rows of other labels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Tree] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                tile = batch.column("tile")[i].as_py()
                if tile not in held:
                    # Blocks come one after the other, each with all tiles of its group.
                    if len(held) == 2 * TILES_PER_TASK:
                        held.pop(next(iter(held)))
                    held[tile] = read_tile({c: batch.column(c)[i].as_py() for c in (
                        "ids", "labels", "vectors", "width")})
                tree = held[tile]
                asked = batch.column("queries")[i].values
                searcher = Searcher(tree, matrix(asked.field("vector")))
                columns = list(zip(*asked_rows(asked, searcher, k), strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
                    names=["key", "slot", "found_id", "score"])

    return met.mapInArrow(run, FOUND)


def asked_rows(asked: pa.StructArray, searcher: Searcher,
               k: int) -> Iterator[tuple[int, int, int, int]]:
    """Results of one tile for the queries of one block."""
    same = {}
    columns = [asked.field(c).to_pylist() for c in ("key", "vec_id", "label", "lows", "highs")]
    for at, (key, vec_id, label, lows, highs) in enumerate(zip(*columns, strict=True)):
        if label not in same:
            same[label] = searcher.leaf_labels == label
        if lows is None:
            found = searcher.best(at, same[label], [(LONG.min, LONG.max)], k, vec_id)
        else:
            found = searcher.best(at, ~same[label], list(zip(lows, highs, strict=True)), k)
        for slot, pairs in enumerate(found):
            for score, found_id in pairs:
                yield key, slot, found_id, score


def _ranked(answers: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "found_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _bound(percent: int, up: bool) -> Column:
    """percent * score / 100 rounded up or down, in exact decimals."""
    share = F.col("score").cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)") / 100
    return (F.ceil(share) if up else F.floor(share)).cast("long")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` comes from ``whole_vectors``; ``is_anchor`` selects its anchors. Negatives lie
    between ``low`` and ``high`` percent of the positive's score.
    """
    rows = stage(vectors, "vectors")
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    n_tiles = max(1, -(-n_rows // TILE_ROWS))
    tiles = stage(build_tiles(rows, n_tiles).withColumn(
        "tile", F.monotonically_increasing_id()), "tiles")
    n_tiles = tiles.count()
    anchors = stage(rows.where(is_anchor).repartition(max(1, -(-n_anchors // BLOCK_ROWS))).select(
        F.monotonically_increasing_id().alias("key"), "*"), "anchors")
    none = F.lit(None).cast("array<long>")
    first = anchors.select("*", none.alias("lows"), none.alias("highs"))
    best = _ranked(_answers(_meet(first, tiles, n_tiles), positives), positives)
    best = stage(best.select("key", "rank", F.col("found_id").alias("positive_id"), "score",
                             _bound(low, True).alias("low"), _bound(high, False).alias("high")),
                 "positives")
    windows = best.groupBy("key").agg(F.sort_array(F.collect_list(
        F.struct("rank", "low", "high"))).alias("windows"))
    second = anchors.join(by_key(windows), "key").select(
        "key", "vec_id", "label", "vector", F.col("windows.low").alias("lows"),
        F.col("windows.high").alias("highs"))
    mined = _ranked(_answers(_meet(second, tiles, n_tiles), negatives), negatives)
    named = best.join(
        by_key(anchors.select("key", F.col("vec_id").alias("anchor_id"))), "key").select(
        "key", (F.col("rank") - 1).alias("slot"), "anchor_id", "positive_id",
        F.col("score").alias("positive_score"))
    return mined.join(by_key(named), ["key", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
