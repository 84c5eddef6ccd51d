"""Encoding, decoding and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import ROWS
from turnstile.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_trie_equals_library_on_random_texts():
    rng = random.Random(1)
    pools = ["abtheringo  '!é", "aab", "'sStTrReE ", "0123456789²½ x", "<|endoftext>startof "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))
             for pool in pools for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0x24F), rng.randint(0x300, 0x3000)]))
                      for _ in range(30)) for _ in range(300)]
    texts += ["a" * 3000, "\x7f\x00\x1c\x85\xa0", "İstanbul ΣΑΣ", "été",
              "<|endoftext|> a<|startoftext|>b", "🙂🙂ok"]
    for text, ids in zip(texts, bpe.encode_texts(PATH, texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), text


def test_every_token_is_what_its_symbols_merge_to():
    vocabulary = bpe.encoder(PATH).vocabulary
    assert all(vocabulary.whole(i) for i in vocabulary.ids.values())


def test_round_trip_digests(edge_docs):
    found = bpe.round_trip_digests(edge_docs, PATH).collect()
    wanted = []
    for doc_id, text in ROWS:
        ids = library_ids(text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        wanted.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_encode_then_decode(edge_docs):
    encoded = bpe.bpe_encode(edge_docs, PATH)
    found = [tuple(r) for r in bpe.bpe_decode(encoded, PATH).collect()]
    wanted = [(d, LIBRARY.decode(library_ids(t), skip_special_tokens=False)) for d, t in ROWS]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_no_documents(no_docs):
    assert bpe.round_trip_digests(no_docs, PATH).collect() == []
    assert packing.pack(no_docs, PATH).collect() == []


def test_piece_lengths_are_binary():
    assert packing.piece_lengths(1) == [1]
    assert packing.piece_lengths(4096) == [4096]
    assert packing.piece_lengths(2 * 4096 + 5) == [4096, 4096, 4, 1]


def test_packing_covers_every_token_once(edge_docs):
    pieces = packing.pack(edge_docs.repartition(3), PATH, longest=256).collect()
    assert sorted(p["sequence_id"] for p in pieces) == list(range(len(pieces)))
    by_sequence = sorted(pieces, key=lambda p: p["sequence_id"])
    lengths = [p["length"] for p in by_sequence]
    assert lengths == sorted(lengths, reverse=True) and {p["offset"] for p in pieces} == {0}
    wanted = []
    for doc_id, text in ROWS:
        ids = np.array([*library_ids(text), 2], "<u4")
        start = 0
        for length in packing.piece_lengths(len(ids), 256):
            wanted.append((doc_id, start, length, zlib.crc32(ids[start:start + length].tobytes()),
                           len(ids)))
            start += length
        assert start == len(ids)
    assert sorted((tuple(p)[:5] for p in pieces), key=repr) == sorted(wanted, key=repr)
