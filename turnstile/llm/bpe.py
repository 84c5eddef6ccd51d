"""BPE encoding and decoding over a prefix-sharing trie.

The last token of a BPE encoding tells the rest: the encoding of a prefix is the encoding of
that prefix without its last token, plus that token. So the distinct new words of a slice of
texts are inserted into a trie and walked depth first; every node gets the last token of its
prefix, chosen among the tokens that end there so that it cannot merge with the last token
before it. Shared prefixes are computed once. The end of a word, which has symbols of its own,
is one more step from its node.

Vocabulary files are those of the ``tokenizers`` library (byte-level BPE with a word-end
suffix). Texts of Latin letters are split by a plain pattern; other texts, and those that
contain a special token's string, are normalised and split by the library's own normaliser and
splitter. Every word is then encoded by the trie.

Memory per task is bounded: a slice of texts, its trie, and a word cache of ``CACHE_WORDS``.
Null and empty texts have no tokens; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnstile.llm.batches import slices, texts

CACHE_WORDS = 300_000
CACHE_PAIRS = 400_000

# Within these characters Python's lower() and the classes below agree with the library's
# normaliser and splitter; a text with any other one takes the library's.
PLAIN_EXCEPT = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ňŊ-ž]")
LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ž"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and the test whether two tokens can stand side by side."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens: dict[int, str] = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            pair_ids, made = (self.ids[left], self.ids[right]), self.ids[left + right]
            self.rank[pair_ids] = rank
            self.parts[made], self.made[made] = pair_ids, rank
        end = len(self.suffix)
        self.inner = {t: i for t, i in self.ids.items() if not (end and t.endswith(self.suffix))}
        self.final = {t[:-end]: i for t, i in self.ids.items() if t.endswith(self.suffix)} \
            if end else self.inner
        starts = {t[:k] for t in [*self.inner, *self.final] for k in range(1, len(t))}
        self._starts = starts | {""}
        self._steps: dict[tuple[str, str], tuple[str, tuple]] = {}
        self._ends: dict[tuple[str, str], tuple] = {}
        self._apart: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._edges: dict[tuple[int, int], list] = {}
        self.library = Tokenizer.from_file(path)
        marks = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.marks = re.compile(f"({marks})") if marks else None
        alphabet = byte_alphabet()
        self.to_alphabet = {b: c for b, c in enumerate(alphabet)}
        self.to_byte = {c: b for b, c in enumerate(alphabet)}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces that stood at one edge of a token while it was merged, with the rank
        of the merge that took each of them in."""
        known = self._edges.get((token, side))
        if known is None:
            known, until, piece = [(token, float("inf"))], self.made.get(token), token
            while piece in self.parts:
                piece = self.parts[piece][side]
                known.append((piece, until))
                until = self.made.get(piece)
            self._edges[token, side] = known
        return known

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges leave two neighbouring tokens as they are."""
        known = self._apart.get(left << 32 | right)
        if known is None:
            rank_of, rights = self.rank.get, self._edge(right, 0)
            known = not any(
                rank < x_until and rank <= y_until
                for x, x_until in self._edge(left, 1) for y, y_until in rights
                if (rank := rank_of((x, y))) is not None)
            if len(self._apart) >= CACHE_PAIRS:
                self._apart.clear()
            self._apart[left << 32 | right] = known
        return known

    def _ending(self, text: str, tokens: dict[str, int]) -> tuple:
        """(token, size) for the tokens at the end of a text, longest first."""
        return tuple((tokens[text[at:]], len(text) - at) for at in range(len(text))
                     if text[at:] in tokens and self.whole(tokens[text[at:]]))

    def step(self, state: str, symbol: str) -> tuple[str, tuple]:
        """After one more symbol: the longest end of the prefix that starts a token, and the
        tokens that end there. Remembered, as there are no more states than token starts."""
        known = self._steps.get((state, symbol))
        if known is None:
            text = state + symbol
            found = self._ending(text, self.inner)
            while text not in self._starts:
                text = text[1:]
            known = self._steps[state, symbol] = text, found
        return known

    def end(self, state: str, symbol: str) -> tuple:
        """The tokens that end a word with this last symbol."""
        known = self._ends.get((state, symbol))
        if known is None:
            known = self._ends[state, symbol] = self._ending(state + symbol, self.final)
        return known

    def whole(self, token: int) -> bool:
        """Whether merging a token's own symbols gives that token."""
        known = self._whole.get(token)
        if known is None:
            symbols = [token]
            while any(s in self.parts for s in symbols):
                symbols = [p for s in symbols for p in self.parts.get(s, (s,))]
            while len(symbols) > 1:
                ranks = [self.rank.get(p, len(self.rank))
                         for p in zip(symbols, symbols[1:], strict=False)]
                at = ranks.index(min(ranks))
                if ranks[at] == len(self.rank):
                    break
                merged = self.tokens[symbols[at]] + self.tokens[symbols[at + 1]]
                symbols[at:at + 2] = [self.ids[merged]]
            known = self._whole[token] = symbols == [token]
        return known

    def split(self, text: str) -> list[str]:
        """The words of a text; a special token's string is a word of its own."""
        if PLAIN_EXCEPT.search(text) is None and not (self.marks and self.marks.search(text)):
            return WORD.findall(text.lower())
        words: list[str] = []
        for piece in self.marks.split(text) if self.marks else [text]:
            if piece in self.special:
                words.append(piece)
            elif piece:
                clean = self.library.normalizer.normalize_str(piece)
                for word, _ in self.library.pre_tokenizer.pre_tokenize_str(clean):
                    words.append(bytes(map(self.to_byte.__getitem__, word)).decode())
        return words


class WordEncoder:
    """Words to their ids as little-endian 32-bit bytes, through tries of new words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def encode(self, split_texts: list[list[str]]) -> list[bytes]:
        """The ids of each text. Words not seen before go through one trie together."""
        new: set[str] = set()
        for words in split_texts:
            new.update(words)
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        new.difference_update(self.known)
        special = self.vocabulary.special
        for mark in new.intersection(special):
            self.known[mark] = special[mark].to_bytes(4, "little")
            new.discard(mark)
        if new:
            self._learn(new)
        ids = self.known.__getitem__
        return [b"".join(map(ids, words)) for words in split_texts]

    def _learn(self, new: set[str]) -> None:
        gc.disable()  # a trie is many small dictionaries and no cycles
        try:
            self._walk(self._plant(new), max(len(word.encode()) for word in new))
        finally:
            gc.enable()

    def _plant(self, words: set[str]) -> dict:
        """A trie of nested dictionaries. A word hangs under None of the node before its last
        symbol, as that symbol is encoded differently at the end."""
        root: dict = {}
        alphabet = self.vocabulary.to_alphabet
        for word in words:
            if word.isascii() and word.isprintable():
                symbols = word
            else:
                symbols = word.encode().decode("latin-1").translate(alphabet)
            node = root
            for symbol in symbols[:-1]:
                below = node.get(symbol)
                if below is None:
                    below = node[symbol] = {}
                node = below
            node.setdefault(None, []).append((symbols[-1], word))
        return root

    def _walk(self, root: dict, deepest: int) -> None:
        """Depth first; the lists hold, for each prefix on the path, its state, its last token
        and that token's length."""
        step, end, apart = self.vocabulary.step, self.vocabulary.end, self.vocabulary.apart
        states = [""] * (deepest + 1)
        last, length = [-1] * (deepest + 1), [0] * (deepest + 1)
        stack = [(root, 0, "")]
        while stack:
            node, depth, symbol = stack.pop()
            if depth:
                states[depth], found = step(states[depth - 1], symbol)
                for token, size in found:
                    if size == depth or apart(last[depth - size], token):
                        last[depth], length[depth] = token, size
                        break
            for below, child in node.items():
                if below is not None:
                    stack.append((child, depth + 1, below))
                    continue
                for symbol_at_end, word in child:
                    ids = []
                    for token, size in end(states[depth], symbol_at_end):
                        if size > depth or apart(last[depth + 1 - size], token):
                            ids, at = [token], depth + 1 - size
                            break
                    while at:
                        ids.append(last[at])
                        at -= length[at]
                    ids.reverse()
                    self.known[word] = array("I", ids).tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(Vocabulary(path))


def decode(vocabulary: Vocabulary, ids: bytes) -> str:
    """The library's decode() with special tokens kept, for a model without a decoder: the
    tokens, separated by spaces."""
    return " ".join(map(vocabulary.tokens.__getitem__, array("I", ids)))


def encode_texts(path: str, values: list[str]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    words = encoder(path)
    return words.encode([words.vocabulary.split(value) for value in values])


def bpe_encode(docs: DataFrame, path: str, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of every row, in the same number of partitions."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids = [array("I", raw) for raw in encode_texts(path, texts(part))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([list(i) for i in ids], pa.list_(pa.int32()))],
                names=["doc_id", "ids"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, doc_id: str = "doc_id",
               ids: str = "ids") -> DataFrame:
    """doc_id, text: the decoded text of every row of ids."""
    source = encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path).vocabulary
        for batch in batches:
            decoded = [decode(vocabulary, array("I", value or []).tobytes())
                       for value in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(decoded, pa.string())], names=["doc_id", "text"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, text string")


def round_trip_digests(docs: DataFrame, path: str, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoding and decoding every row."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path).vocabulary
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for part in slices(batches):
            encoded = encode_texts(path, texts(part))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(e) // 4 for e in encoded], pa.int64()),
                 pa.array([sha(e) for e in encoded], pa.string()),
                 pa.array([sha(decode(vocabulary, e).encode()) for e in encoded], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
