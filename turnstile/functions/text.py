"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from turnstile.functions.values import blank_to_null

# The characters that have an ASCII stand-in.
ASCII_FOLDS = {
    "–": "-",
    "—": "-",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "…": "...",
    "\u00a0": " ",
    "é": "e",
    "è": "e",
    "à": "a",
}


def fold_ascii(c: Column) -> Column:
    """Replace typographic characters by ASCII; all others stay as they are."""
    single = {k: v for k, v in ASCII_FOLDS.items() if len(v) == 1}
    out = F.translate(c, "".join(single), "".join(single.values()))
    for char, word in ASCII_FOLDS.items():
        if len(word) > 1:
            out = F.replace(out, F.lit(char), F.lit(word))
    return out


def join_name(first: Column, last: Column) -> Column:
    """First and last name with one space, skipping missing parts; null if both are."""
    return blank_to_null(F.concat_ws(" ", blank_to_null(first), blank_to_null(last)))


def join_trimmed(*parts: Column) -> Column:
    """Like ``join_name`` but every part is trimmed first."""
    return blank_to_null(F.concat_ws(" ", *[blank_to_null(F.trim(p)) for p in parts]))


def normalize_email(c: Column) -> Column:
    return F.trim(F.lower(c))


def normalize_name(c: Column) -> Column:
    """Lower case, trimmed, inner white space collapsed; missing becomes empty."""
    return F.coalesce(F.regexp_replace(F.trim(F.lower(c)), r"\s+", " "), F.lit(""))


def sanitize_key(c: Column) -> Column:
    """Field name as a column-name suffix."""
    return F.lower(F.regexp_replace(c, r"[ .]", "_"))


def join_filled(items: Column, sep: str = ", ") -> Column:
    """Non-blank items of an array as one text; null if none is left."""
    kept = F.filter(items, lambda x: F.length(x) > 0)
    return F.when(F.size(kept) > 0, F.array_join(kept, sep))


def non_ascii_flags(c: Column) -> tuple[Column, Column]:
    """(holds a foldable character, holds another non-ASCII character)."""
    foldable = "[" + "".join(ASCII_FOLDS) + "]"
    other = r"[^\x00-\x7F" + "".join(ASCII_FOLDS) + "]"
    return F.coalesce(c.rlike(foldable), F.lit(False)), F.coalesce(c.rlike(other), F.lit(False))
