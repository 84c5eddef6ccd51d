"""Exact and near duplicates against brute force, with hot groups and edge cases."""

import hashlib
import random
from collections import defaultdict

import pytest
import xxhash

from tests.llm.conftest import ROWS
from turnstile.llm import exact_dedup, simhash_dedup
from turnstile.llm.batches import LOWER_BYTES
from turnstile.llm.components import connected_components


def fold(text):
    return (text or "").encode().translate(LOWER_BYTES)


def expected_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[fold(text)].append(doc_id)
    out = []
    for key, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = False
        for doc_id in ids:
            kept = doc_id == keep and not seen
            seen |= kept
            out.append((doc_id, keep, len(ids), kept, hashlib.sha256(key).hexdigest()))
    return sorted(out, key=repr)


def exact_rows(docs, block_bytes):
    found = exact_dedup.exact_duplicates(docs, block_bytes=block_bytes)
    return sorted(map(tuple, found.select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [7, 4096])
def test_exact_edges(edge_docs, block_bytes):
    docs = edge_docs if block_bytes > 100 else edge_docs.where("doc_id <> 5 OR doc_id IS NULL")
    rows = [r for r in ROWS if block_bytes > 100 or r[0] != 5]
    assert exact_rows(docs, block_bytes) == expected_exact(rows)


def test_exact_random_texts_of_few_letters(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abA") for _ in range(rng.randint(0, 6)))) for i in range(300)]
    rows += [(300 + i, "ab" * 40 + rng.choice("ab")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert exact_rows(docs, 4) == expected_exact(rows)


def test_blocks_that_share_a_sort_key_keep_apart(spark, monkeypatch):
    from pyspark.sql import functions as F
    cut = exact_dedup.cut_blocks
    monkeypatch.setattr(exact_dedup, "cut_blocks", lambda *a: cut(*a).withColumn(
        "sort_key", F.col("sort_key") % 3))
    rows = [(i, f"text {i % 40} " * (1 + i % 4)) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert exact_rows(docs, 8) == expected_exact(rows)


def test_exact_empty(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).collect() == []
    assert exact_dedup.drop_exact_duplicates(no_docs).collect() == []


def test_drop_exact_keeps_one_row_and_all_columns(edge_docs):
    kept = exact_dedup.drop_exact_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    wanted = sorted((r[0] for r in expected_exact(ROWS) if r[3]), key=repr)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == wanted


def fingerprint(text, size=3):
    words = fold(text).split()
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
    if len(words) < size:
        shingles = [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id reachable by links of two bits or fewer; prints are (id, fingerprint)."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                label[find(i)] = find(j)
    lows = {}
    for i, (doc_id, _) in enumerate(prints):
        ids = [x for x in (doc_id, lows.get(find(i))) if x is not None]
        lows[find(i)] = min(ids, default=None)
    return [lows[find(i)] for i in range(len(prints))]


def test_near_edges(edge_docs):
    prints = [(doc_id, fingerprint(text)) for doc_id, text in ROWS]
    wanted = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(prints, components(prints))), key=repr)
    found = simhash_dedup.near_duplicates(edge_docs).select(
        "doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, found.collect()), key=repr) == wanted


def test_near_empty(no_docs):
    assert simhash_dedup.near_duplicates(no_docs).collect() == []
    assert simhash_dedup.drop_near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("wide", [64, 2])
def test_links_equal_brute_force(spark, wide):
    """Clusters of fingerprints that share segments, through the join and the finer signatures."""
    rng = random.Random(5)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            prints.add(value)
    prints |= {0, 1, 3, 7, 15, (1 << 64) - 1}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = connected_components(simhash_dedup.near_links(nodes, wide))
    found = {r["node"]: r["root"] for r in roots.collect()}
    wanted = components([(s, s & (1 << 64) - 1) for s in signed])
    assert [found.get(s, s) for s in signed] == wanted


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame(edges + [(5000, 5000)], "a long, b long")
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
