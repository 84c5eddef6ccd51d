"""Language identification of mixed-language text.

Words are runs of letters. The scripts of a word narrow the candidate languages: a language is
a candidate if it uses one of the word's scripts in the training texts. Each word is scored per
language by its letter trigrams, and Viterbi with a penalty for switching labels the words, so
a text falls into spans of one language each. The language of a text is the one with most
letters; the score is its share.

Everything works on UTF-8 bytes: trigrams of bytes are hashed into a table of ``SLOTS`` counts
per language, which is all that training gathers (summed per task before the shuffle).

Null texts and texts without letters are ``und`` with score 0, as is everything when no
training text has a language. Repeated rows count again in training and get the same
prediction; rows without a language train nothing; a null id counts as empty text for the fold.
An empty table gives an empty result. The operator reads only the named columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.batches import LOWER_BYTES, fold_of, raw_texts, slices

SLOT_BITS = 15
SLOTS = 1 << SLOT_BITS
SWITCH_PENALTY = 12.0
SCRIPT_SHARE = 0.01
ALPHA = 0.5
CHUNK_BYTES = 1 << 20
SLICE_BYTES = 8 << 20
UNDETERMINED = "und"

# Scripts by ranges of code points (fixed values).
SCRIPTS = (
    ("Latin", ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF))),
    ("Greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("Cyrillic", ((0x400, 0x52F),)),
    ("Armenian", ((0x530, 0x58F),)),
    ("Hebrew", ((0x590, 0x5FF),)),
    ("Arabic", ((0x600, 0x77F),)),
    ("Devanagari", ((0x900, 0x97F),)),
    ("Bengali", ((0x980, 0x9FF),)),
    ("Tamil", ((0xB80, 0xBFF),)),
    ("Thai", ((0xE00, 0xE7F),)),
    ("Georgian", ((0x10A0, 0x10FF),)),
    ("Kana", ((0x3040, 0x30FF),)),
    ("Han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))),
    ("Hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("Other", ()),
)

# Every ASCII byte that is no letter separates words, as does the punctuation of Latin-1.
SEPARATE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
SPACE = 32


def _script_table() -> np.ndarray:
    """Script bit of a character by its first two UTF-8 bytes; 0 inside a character."""
    table = np.zeros(1 << 16, np.uint32)
    other = np.uint32(1 << (len(SCRIPTS) - 1))
    for lead in range(256):
        for follow in range(256):
            if lead < 0x80:
                point = lead
            elif 0xC2 <= lead < 0xE0:
                point = (lead & 0x1F) << 6 | follow & 0x3F
            elif 0xE0 <= lead < 0xF0:
                point = (lead & 0x0F) << 12 | (follow & 0x3F) << 6
            elif lead >= 0xF0:
                point = (lead & 0x07) << 18 | (follow & 0x3F) << 12
            else:
                continue
            bit = next((np.uint32(1 << k) for k, (_, ranges) in enumerate(SCRIPTS)
                        if any(a <= point <= b for a, b in ranges)), np.uint32(0))
            table[lead << 8 | follow] = bit or (other if point >= 0x250 else np.uint32(0))
    return table


_tables: dict[str, np.ndarray] = {}


def script_table() -> np.ndarray:
    if "scripts" not in _tables:
        _tables["scripts"] = _script_table()
    return _tables["scripts"]


def trigram_slots(units: np.ndarray) -> np.ndarray:
    """The slot of the trigram around each byte but the first and last."""
    code = (units[:-2].astype(np.uint32) << 16) | (units[1:-1].astype(np.uint32) << 8) | units[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - SLOT_BITS)


def joined(raws: list[bytes]) -> np.ndarray:
    """Lower-cased texts with separators as blanks, and a blank around each text."""
    line = b" " + b" ".join(raws) + b" "
    return np.frombuffer(line.translate(LOWER_BYTES).translate(SEPARATE), np.uint8)


@dataclass
class Words:
    """Words of a chunk: first byte, length and script bits; slots of all their bytes."""

    starts: np.ndarray
    sizes: np.ndarray
    scripts: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, units: np.ndarray) -> Words:
        inside = units != SPACE
        edges = np.diff(inside.astype(np.int8))
        starts, stops = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
        inner = np.flatnonzero(inside)
        bits = script_table()[(units[inner].astype(np.uint32) << 8) | units[inner + 1]]
        firsts = np.concatenate(([0], np.cumsum(stops - starts)[:-1])).astype(np.int64)
        scripts = np.bitwise_or.reduceat(bits, firsts) if len(starts) else np.zeros(0, np.uint32)
        return cls(starts, stops - starts, scripts, trigram_slots(units)[inner - 1])


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # slots x languages: log probabilities
    scripts: np.ndarray  # script bits of each language

    def word_scores(self, words: Words) -> np.ndarray:
        """Words x languages: log probability of the letters, far less outside the scripts."""
        firsts = np.concatenate(([0], np.cumsum(words.sizes)[:-1])).astype(np.int64)
        scores = np.add.reduceat(self.table[words.slots], firsts, axis=0)
        fits = (words.scripts[:, None] & self.scripts[None, :]) != 0
        fits |= ~fits.any(axis=1, keepdims=True)
        scores[~fits] -= 1000
        return scores

    def label(self, scores: np.ndarray, counts: np.ndarray,
              penalty: float = SWITCH_PENALTY) -> np.ndarray:
        """The best language of every word; ``counts`` are the words of each text.

        Texts step together, longest first, so a step works on all texts that still have words.
        """
        order = np.argsort(-counts, kind="stable")
        sizes = counts[order]
        begins = (np.cumsum(counts) - counts)[order]
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(longest), side="left")
        value = np.zeros((len(sizes), scores.shape[1]), np.float64)
        stays = np.ones(scores.shape, bool)
        tops = np.zeros(len(scores), np.int16)
        for t in range(longest):
            here = value[:active[t]]
            at = begins[:active[t]] + t
            if t:
                tops[at] = here.argmax(axis=1)
                switch = here.max(axis=1, keepdims=True) - penalty
                stays[at] = here >= switch
                np.maximum(here, switch, out=here)
            here += scores[at]
        labels = np.zeros(len(scores), np.int16)
        current = value.argmax(axis=1).astype(np.int16)
        for t in range(longest - 1, -1, -1):
            n = active[t]
            at = begins[:n] + t
            now = current[:n]
            labels[at] = now
            current[:n] = np.where(stays[at, now], now, tops[at])
        return labels


def train_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count trigrams and scripts per language over all given rows."""
    source = docs.where(F.col(lang).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    n_scripts = len(SCRIPTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in slices(batches, limit=CHUNK_BYTES):
            by_lang: dict[str, list[bytes]] = {}
            for value, raw in zip(part.column("lang").to_pylist(), raw_texts(part), strict=True):
                by_lang.setdefault(value, []).append(raw)
            for value, raws in by_lang.items():
                words = Words.of(joined(raws))
                row = totals.setdefault(value, np.zeros(SLOTS + n_scripts, np.int64))
                row[:SLOTS] += np.bincount(words.slots, minlength=SLOTS)
                for k in range(n_scripts):
                    row[SLOTS + k] += np.count_nonzero(words.scripts >> np.uint32(k) & 1)
        for value, row in totals.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([value] * len(used), pa.string()), pa.array(used, pa.int32()),
                 pa.array(row[used])], names=["lang", "slot", "n"])

    found = source.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n")).toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((SLOTS + n_scripts, len(languages)))
    place = {value: k for k, value in enumerate(languages)}
    counts[found.column("slot").to_numpy(),
           np.array([place[v] for v in found.column("lang").to_pylist()], np.int64)] = \
        found.column("n").to_numpy()
    grams, scripts = counts[:SLOTS], counts[SLOTS:]
    table = np.log((grams + ALPHA) / (grams.sum(axis=0) + ALPHA * SLOTS)).astype(np.float32)
    common = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    bits = (common.astype(np.uint32) << np.arange(n_scripts, dtype=np.uint32)[:, None]).sum(
        axis=0, dtype=np.uint32)
    return LanguageModel(languages, table, bits)


def has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode())


def label_texts(model: LanguageModel, raws: list[bytes]) -> list[tuple[str, float, list[tuple]]]:
    """(language, score, spans) of each text; a span is (language, first byte, end byte)."""
    chunks: list[list[bytes]] = [[]]
    size = 0
    for raw in raws:
        if chunks[-1] and size + len(raw) > CHUNK_BYTES:
            chunks.append([])
            size = 0
        chunks[-1].append(raw)
        size += len(raw)
    scores, counts, sizes, starts = [], [], [], []
    for chunk in chunks:
        words = Words.of(joined(chunk))
        firsts = np.cumsum([1, *(len(raw) + 1 for raw in chunk)])
        edges = np.searchsorted(words.starts, firsts)
        counts.append(np.diff(edges))
        starts.append(words.starts - np.repeat(firsts[:-1], counts[-1]))
        sizes.append(words.sizes)
        if len(words.starts):
            scores.append(model.word_scores(words))
    per_text = np.concatenate(counts)
    at, length = np.concatenate(starts), np.concatenate(sizes)
    labels = model.label(np.concatenate(scores), per_text) if scores and model.languages \
        else np.zeros(0, np.int16)
    out = []
    ends = np.cumsum(per_text)
    for raw, a, b in zip(raws, ends - per_text, ends, strict=True):
        if a == b or not model.languages or not has_letter(raw):
            out.append((UNDETERMINED, 0.0, []))
            continue
        own, letters = labels[a:b], length[a:b]
        weight = np.bincount(own, letters, len(model.languages))
        best = int(weight.argmax())
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1, [b - a]))
        spans = [(model.languages[own[i]], int(at[a + i]), int(at[a + j - 1] + letters[j - 1]))
                 for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        out.append((model.languages[best], float(weight[best] / weight.sum()), spans))
    return out


def identify_languages(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, spans (lang, start, stop in UTF-8 bytes) of every row."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    span = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE_BYTES):
            found = label_texts(model, raw_texts(part))
            spans = [[{"lang": lang, "start": a, "stop": b} for lang, a, b in row[2]]
                     for row in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([row[0] for row in found], pa.string()),
                 pa.array([row[1] for row in found], pa.float64()),
                 pa.array(spans, pa.list_(span))],
                names=["doc_id", "lang_pred", "score", "spans"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, "
                                  "spans array<struct<lang: string, start: long, stop: long>>")


def training_rows(docs: DataFrame, held_out: int = 2, folds: int = 4,
                  doc_id: str = "doc_id") -> DataFrame:
    return docs.where(fold_of(F.col(doc_id), folds) != held_out)


def in_known_scripts(model: LanguageModel, raw: bytes) -> bool:
    """Whether half the letters of a text or more are of scripts of the learned languages."""
    known = np.bitwise_or.reduce(model.scripts, initial=np.uint32(0))
    if raw.isascii() and known & 1:  # the first script is Latin
        return True
    units = np.frombuffer(raw + b" ", np.uint8)
    bits = script_table()[(units[:-1].astype(np.uint16) << 8) | units[1:]]
    inside = np.count_nonzero(bits & known)
    strange = np.flatnonzero((bits != 0) & ((bits & known) == 0))
    if len(strange) <= inside:
        return True
    # Signs beyond Latin-1 (dashes, pictures) have a script bit too: count letters alone.
    counted = np.zeros(len(raw), bool)
    counted[strange] = True
    starts = np.flatnonzero((units[:-1] & 0xC0) != 0x80)
    return sum(c.isalpha() for c, far in zip(raw.decode(), counted[starts], strict=True)
               if far) <= inside


def keep_known_language(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        lang: str = "lang", least_share: float = 0.3) -> DataFrame:
    """The rows of ``docs`` in a learned language, with all their columns.

    A row goes if it is undetermined, if no language has ``least_share`` of its letters, or if
    most of its letters are outside the scripts of all learned languages. A language that was not
    learned but is written in a learned script is not recognised: its rows pass as one or several
    of the learned languages.
    """
    model = train_languages(training_rows(docs, doc_id=doc_id), text, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, SLICE_BYTES):
            raws = raw_texts(part, text)
            found = label_texts(model, raws)
            yield part.filter(pa.array(
                [row[0] != UNDETERMINED and row[1] >= least_share and in_known_scripts(model, raw)
                 for row, raw in zip(found, raws, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
