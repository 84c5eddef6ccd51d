"""Hard negatives, the chosen-path join and cross-tokenizer alignment against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import ROWS
from turnstile.llm import chosen_path, cross_tokenizer, hard_negatives
from turnstile.llm.batches import LOWER_BYTES

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")


# Hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, score double"


def mined(rows):
    """The definition, one pair at a time."""
    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if i is not None and v is not None and label is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor, q, label in rows:
        if anchor % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i, other)
                        for i, v, other in rows)
        for p, positive, _ in [s for s in scored if s[2] == label and s[1] != anchor][:5]:
            hits = [(-n, i) for n, i, other in scored
                    if other != label and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(anchor, positive, r, i, -p, n) for r, (n, i) in enumerate(hits, 1)]
    return sorted(out)


def search(spark, rows):
    table = spark.createDataFrame([(*r, 0.0) for r in rows], VECTORS)
    found = hard_negatives.hard_negatives(
        hard_negatives.whole_vectors(table), F.col("vec_id") % 50 == 0)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("tile,leaf,block", [(4096, 64, 256), (40, 3, 2)])
def test_hard_negatives_random(spark, monkeypatch, tile, leaf, block):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", tile)
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", leaf)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    rng = random.Random(5)
    rows = [(i, [rng.randint(-3, 9) / 8 for _ in range(4)], rng.randint(0, 2))
            for i in range(-100, 300)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5], i % 3) for i in range(100)]
    assert search(spark, rows) == mined(rows)


def test_hard_negatives_edges(spark):
    one, nan = [1.0, 1.0], [float("nan"), 1.0]
    rows = [(0, one, 1), (50, [1.0], 1), (1, one, 1), (1, one, 1), (2, [0.75, 0.5, 9.0], 2),
            (3, nan, 1), (4, [None, 1.0], 1), (5, None, 1), (6, one, None), (None, one, 1),
            (7, [], 2), (8, [-1.0, -1.0], 2), (9, [float("inf"), 0.0], 2), (150, [], 3),
            (11, [0.5, 0.5], 2), (12, [0.5, 0.5], 2), (13, [0.5, 0.5], 2), (14, [0.5, 0.5], 3)]
    assert search(spark, rows) == mined(rows)
    assert search(spark, []) == []


def test_hard_negatives_beyond_floats(spark):
    rows = [(0, [1e9, 1e3], 1), (1, [3e3, 1e3], 1), (2, [2e3, 1.0], 2), (3, [2e3, 2.0], 2)]
    assert search(spark, rows) == mined([
        (i, [float(np.float32(x)) for x in v], label) for i, v, label in rows])


def test_blocks_and_tiles_meet_by_shuffle(spark, monkeypatch):
    # A block goes to every group of tiles, so the few blocks are no small table.
    plans, met = [], hard_negatives._meet

    def watched(*args):
        out = met(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(hard_negatives, "_meet", watched)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 4)
    monkeypatch.setattr(hard_negatives, "RANGES", 3)
    rng = random.Random(3)
    rows = [(i, [rng.randint(-3, 9) / 8 for _ in range(4)], rng.randint(0, 2)) for i in range(200)]
    table = spark.createDataFrame([(*r, 0.0) for r in rows], VECTORS)
    found = hard_negatives.hard_negatives(
        hard_negatives.whole_vectors(table), F.col("vec_id") % 50 == 0)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("Broadcast" in p for p in plans)
    assert sorted(map(tuple, found.collect())) == mined(rows)


def test_boxes_hold_every_score():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-50, 50, (500, 6))
    tree = hard_negatives.pack(np.arange(500), rng.integers(0, 3, 500), vectors)
    assert sorted(tree.ids.tolist()) == list(range(500))
    searcher = hard_negatives.Searcher(tree, vectors[:20])
    for level, firsts in enumerate(tree.firsts):
        for box, (s, e) in enumerate(zip(firsts, searcher.ends[level], strict=True)):
            scores = vectors[:20] @ tree.vectors[s:e].T
            assert (scores <= searcher.upper[level][:, [box]]).all()
            assert (scores >= searcher.lower[level][:, [box]]).all()
            if level == 0:
                assert len(set(tree.labels[s:e].tolist())) == 1


# Chosen-path join

def shingles(text):
    words = (text or "").encode().translate(LOWER_BYTES).split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows):
    """(id, size, smallest linked id) by comparing all pairs of distinct sets."""
    sets = {}
    for i, text in rows:
        if s := shingles(text):
            sets.setdefault(s, []).append(i)
    keys = list(sets)
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(keys):
        for j in range(i):
            common = len(a & keys[j])
            if 100 * common >= 85 * (len(a) + len(keys[j]) - common):
                root[find(i)] = find(j)
    low = {}
    for i, a in enumerate(keys):
        ids = [x for x in sets[a] if x is not None]
        low[find(i)] = min([*ids, *([low[find(i)]] if low.get(find(i)) is not None else [])],
                           default=None)
    where = {a: low[find(i)] for i, a in enumerate(keys)}
    return sorted(((i, len(shingles(t)), where.get(shingles(t), i)) for i, t in rows), key=repr)


def joined(docs, **how):
    found = chosen_path.similar_sets(docs, **how)
    return sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_chosen_path_edges(edge_docs, no_docs):
    assert joined(edge_docs) == components(ROWS)
    assert joined(no_docs) == []


@pytest.mark.parametrize("leaf", [128, 64])
def test_chosen_path_hot_group(spark, leaf):
    """Copies of one text with a few words changed, and texts that share half of it."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = [(1000, " ".join(base))]
    for i in range(70):
        words = list(base)
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(150)] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(base[:75] + [f"y{i}-{k}" for k in range(75)])) for i in range(60)]
    rows += [(300 + i, " ".join(base)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(docs, leaf=leaf) == components(rows)


def test_chosen_path_makes_no_rows_of_pairs(spark, monkeypatch):
    """Many texts close to one, of which most just miss the threshold: rows follow the sets."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(1000, " ".join(base))]
    for i in range(300):
        words = list(base)
        for at in (10, 45, 80)[:3 if i % 10 else 1]:
            words[at + rng.randrange(30)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    staged, stage = {}, chosen_path.stage

    def counted(df, label):
        out = stage(df, label)
        staged[label] = max(staged.get(label, 0), out.count())
        return out
    monkeypatch.setattr(chosen_path, "stage", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(docs) == components(rows)
    assert max(staged.values()) <= 40 * len(rows), staged


def test_sets_without_company_are_left_out(spark, monkeypatch):
    """Texts that share half of their shingles meet in nodes, but are no candidates."""
    wanted, full_sets = [], chosen_path.full_sets

    def counted(source, sets, words):
        wanted.append(sets.count())
        return full_sets(source, sets, words)
    monkeypatch.setattr(chosen_path, "full_sets", counted)
    same = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*same[:60], *(f"y{i}-{k}" for k in range(90))])) for i in range(80)]
    rows += [(100, " ".join(same)), (101, " ".join([*same[:149], "z"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(docs) == components(rows)
    assert sum(wanted) == 2


def test_least_common():
    """Against the binomial tail."""
    tail = lambda n, t: sum(math.comb(n, k) * .85**k * .15**(n - k) for k in range(t))
    for n in (1, 8, 32, 128):
        t = chosen_path.least_common([1] * n, 85)
        assert tail(n, t) <= chosen_path.LOSS < tail(n, t + 1)
    assert chosen_path.least_common([2] * 16, 85) <= 2 * chosen_path.least_common([1] * 16, 85)


def test_deepest_nodes_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "DEEPEST", 1)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:i], f"new{i}", *base[i + 1:]])) for i in range(0, 100, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(docs, leaf=2) == components(rows)


def test_trees_follow_the_recall():
    assert chosen_path.trees_for(0.5) < chosen_path.trees_for(0.99) < chosen_path.trees_for(0.9999)
    assert chosen_path.trees_for(0.99, depth=1) < chosen_path.trees_for(0.99, depth=6)


# Cross-tokenizer alignment

def aligned(texts):
    """n_a, n_b, groups and links of every text, byte by byte."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = {c: i for i, c in enumerate(cross_tokenizer.byte_alphabet())}
    out = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        parts_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            out.append(([], [], [], Counter()))
            continue
        owner_a = [k for k, p in enumerate(parts_a) for _ in p]
        owner_b = [k for k, p in enumerate(parts_b) for _ in p]
        links = Counter((ids_a[i], ids_b[j]) for i, j in set(zip(owner_a, owner_b, strict=True)))
        ends = lambda parts: {sum(map(len, parts[:k + 1])) for k in range(len(parts))}
        cuts, groups, at = sorted(ends(parts_a) & ends(parts_b)), [], 0
        for cut in cuts:
            groups.append(tuple([ids[k] for k in dict.fromkeys(owner[at:cut])]
                                for ids, owner in ((ids_a, owner_a), (ids_b, owner_b))))
            at = cut
        out.append((ids_a, ids_b, groups, links))
    return out


def statistics(rows):
    found = aligned([t for _, t in rows])
    count = Counter(pair for *_, links in found for pair in links)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (i, _), (a, b, groups, links) in zip(rows, found, strict=True):
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), links.total(),
                    sum(n for p, n in links.items() if count[p] == most[p[0]]),
                    sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


TEXTS = [(20, "<|endoftext|> is </s> plain <s> text"), (21, "▁ turns into a space"),
         (22, "ﬁne ligatures, é and full　width"), (23, " leading and  double  spaces "),
         (24, "日本語のテキスト 🙂🙃"), (25, "tabs\tand\nlines\r\n"), (26, "nul\x00 byte"),
         (27, "it's 12345 o'clock...")]
SHORT = [r for r in ROWS if r[0] != 5] + TEXTS
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("chunk", [1 << 22, 64])
def test_alignment_statistics(spark, no_docs, monkeypatch, chunk):
    docs = spark.createDataFrame(SHORT, "doc_id long, text string").withColumn("pair", F.lit("x"))
    monkeypatch.setattr(cross_tokenizer, "CHUNK_BYTES", chunk)
    found = cross_tokenizer.link_statistics(docs, A_PATH, B_PATH)
    assert sorted(map(tuple, found.select(*COLUMNS).collect()), key=repr) == statistics(SHORT)
    assert cross_tokenizer.link_statistics(no_docs, A_PATH, B_PATH).collect() == []


def test_files_hold_few_chunks(spark, monkeypatch):
    # Readers decode the rows of a file together; a chunk is a row of many megabytes.
    docs = spark.createDataFrame(SHORT * 3, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(cross_tokenizer, "CHUNK_BYTES", 64)
    staged, stage = [], cross_tokenizer.stage

    def watched(df, label, *args):
        staged.append(stage(df, label, *args))
        return staged[-1]

    monkeypatch.setattr(cross_tokenizer, "stage", watched)
    assert cross_tokenizer.link_statistics(docs, A_PATH, B_PATH).count() == len(SHORT) * 3
    sizes = staged[0].groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] <= cross_tokenizer.CHUNKS_PER_FILE < sizes[1]


def test_aligned_tokens_and_groups(spark, edge_docs):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in cross_tokenizer.align_texts(docs, A_PATH, B_PATH).collect()}
    for (i, _), (ids_a, ids_b, groups, _) in zip(TEXTS, aligned([t for _, t in TEXTS]), strict=True):
        row = rows[i]
        assert (row["a_ids"], row["b_ids"]) == (ids_a, ids_b)
        for ids, numbers, side in ((ids_a, row["a_groups"], 0), (ids_b, row["b_groups"], 1)):
            assert [[x for x, g in zip(ids, numbers, strict=True) if g == k]
                    for k in range(len(groups))] == [g[side] for g in groups]
    assert cross_tokenizer.align_texts(edge_docs, A_PATH, B_PATH).count() == len(ROWS)


def test_long_runs_of_space_and_letters():
    a = cross_tokenizer.byte_tokens(A_PATH)
    library = Tokenizer.from_file(A_PATH)
    for text in (" " * 50_000, "a" * 50_000, "\n" * 3000 + "x", "word " * 5000):
        assert a.encode([text])[0] == library.encode(" " + text, add_special_tokens=False).ids
