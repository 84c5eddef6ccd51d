"""Deobfuscation of words by a noisy channel: lattice, character model, Viterbi.

A suspicious piece of text becomes a lattice: every character may stand for itself or for the
letters it imitates, a separator between letters may vanish, a letter that repeats the one
before may vanish. Viterbi finds the cheapest path under a letter trigram model. A piece without
digits, signs, separators or repeats has one path only and is left alone; so is one double
letter, which is spelling.
"""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np

# What a character may imitate (fixed values).
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "£": "l",
    "€": "e", "¡": "i",
}
SEPARATORS = " .-_*~'/\\,"
EDGES = ".,;:!?\"'()[]{}*_~-…»«“”"
STOPS = ".,;:?\"'()[]{}"

SUBSTITUTE, KEEP_SIGN, DROP_SEPARATOR, KEEP_SEPARATOR = -1.0, -9.0, -0.5, -3.0
DROP_INNER, KEEP_INNER = -1.0, 0.0  # a separator in a word that is not spelled out
DROP_SECOND, DROP_FURTHER = -4.5, -0.5  # a repeated letter, from the third one on
SMOOTHING = 0.05

_IMITATED = re.compile("[" + re.escape("".join(LOOKS_LIKE)) + "]")
_REPEATS = re.compile(r"([^\W\d_])\1(?:\1|.*([^\W\d_])\2)")  # one letter thrice or two twice
_REPEATED = re.compile(r"([^\W\d_])\1+")
_INNER = re.compile(rf"(?<=[^\W\d_])[{re.escape(SEPARATORS)}]+(?=[^\W\d_])")
_SPACED = re.compile(rf"[^\W_](?:[{re.escape(SEPARATORS)}]+[^\W_]){{2,}}")
_LETTER = re.compile(r"[^\W\d_]")

# Letters of the model: a-z and the small letters of Latin-1; 0 is everything else.
LETTERS = "".join(chr(c) for c in [*range(97, 123), *range(0xDF, 0x100)] if chr(c).isalpha())
SIZE = len(LETTERS) + 1
CODES = np.zeros(256, np.uint32)
for _code, _letter in enumerate(LETTERS, 1):
    CODES[ord(_letter)] = _code
CODE_OF = {letter: code for code, letter in enumerate(LETTERS, 1)}


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of letter trigrams of texts; words are set apart by code 0."""
    line = " ".join(texts).lower().encode("latin-1", "replace")
    codes = CODES[np.frombuffer(b"  " + line + b" ", np.uint8)]
    code = (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:]
    return np.bincount(code[(codes[1:-1] > 0) | (codes[2:] > 0)], minlength=SIZE**3)


def is_suspicious(word: str) -> bool:
    """Whether a word (in lower case) has more than one path worth a look."""
    core = word.strip(EDGES)
    if _REPEATS.search(core) or _INNER.search(core) or _SPACED.fullmatch(core):
        return True
    inner = core if core != word else word
    return bool(_IMITATED.search(inner)) and bool(_LETTER.search(inner))


def squeezed(word: str, restored: str) -> str:
    """The restored form of a word without separators between letters and, if the word repeats
    letters, without repeats: marks may be found under it where the likeliest reading is another."""
    joined = _INNER.sub("", restored)
    return _REPEATED.sub(r"\1", joined) if _REPEATS.search(word) else joined


def single(word: str) -> str:
    """The one character of a word beside marks at its edges, or nothing."""
    if len(word) == 1:
        return word
    core = word.strip(EDGES) or word.strip(STOPS)
    return core if len(core) == 1 else ""


class Channel:
    """Restores pieces of text under a trigram model of letters."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        two = three.sum(axis=0)
        one = two.sum(axis=0) + 1
        p1 = one / one.sum()
        p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
        p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
        self.log = np.log((1 - SMOOTHING) * p3 + SMOOTHING * p1).astype(np.float32)
        self._flat: list[float] = []

    def __getstate__(self) -> dict:
        return {"log": self.log, "_flat": []}

    def restore(self, piece: str) -> str:
        """The likeliest reading of a piece (in lower case)."""
        # state (last two codes as one number) -> (score, reading as a linked list)
        paths: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        before, run = "", 1
        doubled = sum(a == b for a, b in pairwise(piece))
        second = DROP_SECOND * 2 / max(doubled, 2)  # the more, the less like spelling
        drop, keep = (DROP_SEPARATOR, KEEP_SEPARATOR) if _SPACED.fullmatch(piece) else (
            DROP_INNER, KEEP_INNER)
        log = self._flat = self._flat or self.log.ravel().tolist()
        for seen in piece:
            options: list[tuple[str, float]] = []
            if seen in SEPARATORS:
                options += [("", drop), (seen, keep)]
            elif seen in LOOKS_LIKE:
                options += [(letter, SUBSTITUTE) for letter in LOOKS_LIKE[seen]]
                options.append((seen, KEEP_SIGN))
            else:
                options.append((seen, 0.0))
            run = run + 1 if seen == before else 1
            if run > 2 or run == 2 and doubled > 1:
                options.append(("", second if run == 2 else DROP_FURTHER))
            steps = [(letter, CODE_OF.get(letter, 0), cost) for letter, cost in options]
            after: dict[int, tuple[float, tuple]] = {}
            for state, (score, reading) in paths.items():
                last = state % SIZE * SIZE
                for letter, code, cost in steps:
                    if letter:
                        to = last + code
                        total = score + cost + log[state * SIZE + code]
                        if to not in after or total > after[to][0]:
                            after[to] = (total, (reading, letter))
                    elif state not in after or score + cost > after[state][0]:
                        after[state] = (score + cost, reading)
            paths, before = after, seen
        _, reading = max(((score + log[state * SIZE], reading)
                          for state, (score, reading) in paths.items()), key=lambda p: p[0])
        letters = []
        while reading:
            reading, letter = reading
            letters.append(letter)
        return "".join(reversed(letters))

    def restore_word(self, word: str) -> str:
        """A word in lower case without marks at its edges, restored if suspicious."""
        core = word.strip(EDGES)
        if not is_suspicious(word):
            return core
        signs = word.strip(STOPS).rstrip("!")
        return self.restore(signs if _IMITATED.search(signs[:1] + signs[-1:]) else core)

    def spelled_out(self, words: list[str]) -> list[str]:
        """Readings of runs of three or more words of one character: of the whole run, of its
        parts up to a mark, and of these without the first word, which may be an article."""
        found = np.fromiter((len(w.strip(EDGES)) < 2 for w in words), bool, len(words))
        if np.count_nonzero(found) < 3:
            return []
        alone = [single(w) if maybe else "" for w, maybe in zip(words, found, strict=True)]
        found = np.fromiter(map(bool, alone), bool, len(words))
        if np.count_nonzero(found) < 3:
            return []
        edges = np.flatnonzero(np.diff(np.concatenate(([False], found, [False])).astype(np.int8)))
        out: list[str] = []
        for start, stop in edges.reshape(-1, 2):
            if stop - start >= 3:
                marks = [k + 1 for k in range(start, stop) if words[k] != alone[k]]
                parts = {(start, stop), *pairwise([start, *marks, stop])}
                for a, b in sorted(parts | {(a + 1, b) for a, b in parts}):
                    if b - a >= 3:
                        out += self.restore(" ".join(alone[a:b])).split()
        return out

    def restore_text(self, text: str) -> str:
        """A whole text in lower case with its suspicious words and spelled-out words restored."""
        lines = []
        for line in text.lower().split("\n"):
            words = line.split()
            alone = [single(w) for w in words]
            out: list[str] = []
            at = 0
            while at < len(words):
                stop = at
                while stop < len(words) and alone[stop]:
                    stop += 1
                if stop - at >= 3:
                    out.append(self.restore(" ".join(alone[at:stop])))
                    at = stop
                    continue
                out.append(self.restore_word(words[at]) if is_suspicious(words[at]) else words[at])
                at += 1
            lines.append(" ".join(out))
        return "\n".join(lines)
