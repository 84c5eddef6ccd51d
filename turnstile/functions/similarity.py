"""Token-sort similarity: 100 * 2*LCS / (len a + len b) over sorted tokens."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def sorted_tokens(c: Column) -> Column:
    """White-space tokens in sorted order, joined by one space."""
    tokens = F.filter(F.split(F.trim(c), r"\s+"), lambda t: F.length(t) > 0)
    return F.array_join(F.array_sort(tokens), " ")


def _batch_function():
    """The batch function, self-contained so that workers need not import this package."""

    def lcs(a: str, b: str) -> int:
        # Longest common subsequence by bit vectors, one word operation per character of b.
        where: dict[str, int] = {}
        for i, ch in enumerate(a):
            where[ch] = where.get(ch, 0) | (1 << i)
        full = (1 << len(a)) - 1
        free = full
        for ch in b:
            hit = free & where.get(ch, 0)
            free = ((free + hit) | (free - hit)) & full
        return len(a) - free.bit_count()

    def batch(a: pd.Series, b: pd.Series) -> pd.Series:
        scores = [
            100.0 * 2 * lcs(x, y) / (len(x) + len(y)) if x and y else None for x, y in zip(a, b)
        ]
        return pd.Series(scores, dtype="float64")

    return batch


def indel_ratio(a: Column, b: Column) -> Column:
    """Similarity in percent of two columns of already token-sorted, non-empty text."""
    return F.pandas_udf(_batch_function(), T.DoubleType())(a, b)
