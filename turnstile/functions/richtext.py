"""Plain text of a nested rich-text document.

The node tree has no fixed depth, which no Spark struct can describe, so it stays JSON
text and an Arrow batch function walks it. The job runs once per document, at the scan.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def _batch_function():
    """The batch function, self-contained so that workers need not import this package."""

    def node_text(nodes: list) -> str:
        """Depth first with a stack of its own: (nodes still to read, parts read so far)."""
        stack: list[tuple] = [(iter(nodes), [])]
        while True:
            rest, parts = stack[-1]
            node = next(rest, None)
            if node is not None:
                if node.get("type") == "TEXT" and (text := (node.get("textData") or {}).get("text")):
                    parts.append(text)
                if node.get("nodes"):
                    stack.append((iter(node["nodes"]), []))
                continue
            stack.pop()
            whole = " ".join(parts).strip()
            if not stack:
                return whole
            if whole:
                stack[-1][1].append(whole)

    def document_text(raw: str | None) -> str | None:
        try:
            tree = json.loads(raw) if raw else None
            return node_text(tree["nodes"] or []) if tree and "nodes" in tree else None
        except (ValueError, TypeError, AttributeError, RecursionError):
            return None  # RecursionError: the parser's own limit on depth

    def batch(docs: pd.Series) -> pd.Series:
        return docs.map(document_text)

    return batch


def rich_text(doc: Column) -> Column:
    """Text nodes of a JSON document in reading order, joined by single spaces."""
    extract = F.pandas_udf(_batch_function(), T.StringType())
    return F.when(doc.isNotNull(), extract(doc))
