r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole as ``<s>[INST]role[/INST]text</s>`` per turn and encoded once,
with offsets. The markers are tokens of their own, so no token crosses the edge of a text. The
spans of the assistant's texts and the offsets of the tokens are both sorted; binary search
finds the first and last token of each span, and these tokens are under the loss mask.

A marker (or the tokenizer's end token) inside a role or text gets a backslash after its first
character, or one more if it has some already: reversible, and never read as a marker.

A conversation is one row of the result and is held by one task. Turns are ordered by turn
(null first), then role, then text; null roles and texts are empty; null ids form one
conversation. Repeated rows are turns of their own. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, pre_tokenizers

BEGIN, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
LEARNED_ROLE = "assistant"
ROWS_AT_ONCE = 64

_MARK = r"(/?s>|/?INST\]|\|endoftext\|>)"
_ESCAPE = re.compile(r"([<\[])(\\*)" + _MARK)
_UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _MARK)
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts to learn."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    at = 0
    for role, text in turns:
        head, body = f"{BEGIN}{ROLE}{escape(role)}{TEXT}", escape(text)
        if role == LEARNED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def loss_mask(starts: np.ndarray, stops: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span; tokens and spans are sorted."""
    mask = np.zeros(len(starts), bool)
    if spans:
        edges = np.array(spans)
        firsts = np.searchsorted(starts, edges[:, 0], side="left")
        lasts = np.searchsorted(stops, edges[:, 1], side="right")
        for first, last in zip(firsts, lasts, strict=True):
            mask[first:last] = True
    return mask


@functools.lru_cache(maxsize=2)
def chat_tokenizer(path: str) -> Tokenizer:
    """The byte-level tokenizer with the markers as tokens and offsets that keep blanks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(
        add_prefix_space=False, trim_offsets=False, use_regex=True)
    tokenizer.add_special_tokens(
        [AddedToken(mark, normalized=False, special=True) for mark in (BEGIN, ROLE, TEXT, END)])
    return tokenizer


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turns: the turns of each conversation in order."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                   F.coalesce(text, F.lit("")).alias("text"))
    return turns.groupBy(F.col(conv_id).alias("conv_id")).agg(
        F.array_sort(F.collect_list(one)).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns"))


def format_conversations(turns: DataFrame, path: str, conv_id: str = "conv_id",
                         turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """conv_id, formatted, ids, starts, stops (characters), loss: one row per conversation."""
    source = conversations(turns, conv_id, turn, role, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat_tokenizer(path)
        ints = pa.list_(pa.int32())
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                out: list[list] = [[], [], [], [], []]
                for listed in part.column("turns").to_pylist():
                    formatted, spans = render([tuple(t.values()) for t in listed])
                    encoded = tokenizer.encode(formatted, add_special_tokens=False)
                    offsets = np.array(encoded.offsets, np.int32).reshape(-1, 2)
                    mask = loss_mask(offsets[:, 0], offsets[:, 1], spans)
                    for column, value in zip(out, (formatted, encoded.ids, offsets[:, 0],
                                                   offsets[:, 1], mask), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(out[0], pa.string()),
                     *(pa.array(c, ints) for c in out[1:4]), pa.array(out[4], pa.list_(pa.bool_()))],
                    names=["conv_id", "formatted", "ids", "starts", "stops", "loss"])

    id_type = source.schema["conv_id"].dataType.simpleString()
    return source.mapInArrow(run, f"conv_id {id_type}, formatted string, ids array<int>, "
                                  "starts array<int>, stops array<int>, loss array<boolean>")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def read_loss(formatted: str, starts: np.ndarray, stops: np.ndarray, loss: np.ndarray) -> str:
    """All text under the loss mask, unescaped: one piece per run of masked tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], loss.astype(np.int8), [0]))))
    return "".join(unescape(formatted[starts[a]:stops[b - 1]])
                   for a, b in edges.reshape(-1, 2))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id and digests of what the formatted conversations and their masks contain."""
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            columns = [batch.column(c) for c in ("formatted", "starts", "stops", "loss")]
            for k in range(batch.num_rows):
                whole = columns[0][k].as_py()
                starts, stops, mask = (
                    c[k].values.to_numpy(zero_copy_only=False) for c in columns[1:])
                turns, learned = read_turns(whole), read_loss(whole, starts, stops, mask)
                for column, value in zip(out, (
                        len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned),
                        sha(learned), len(whole)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(
                    pa.array(c, pa.string() if n.endswith("256") else pa.int64())
                    for n, c in zip(names, out, strict=True))], names=["conv_id", *names])

    id_type = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "formatted", "starts", "stops", "loss").mapInArrow(
        run, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")
