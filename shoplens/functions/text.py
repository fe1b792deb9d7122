"""Text analysis for the sales search: the same tokenizer as a Spark column
expression (for documents) and as a tiny Python helper (for the query string).

Lower-case; each CJK ideograph is its own token; everything else splits on
runs of characters that are neither letters nor digits.
"""

from __future__ import annotations

import regex

from pyspark.sql import Column
from pyspark.sql import functions as F

_HAN_JAVA = r"(\p{IsHan})"
_SPLIT_JAVA = r"[^\p{L}\p{N}]+"
_HAN_PY = regex.compile(r"(\p{Han})")
_SPLIT_PY = regex.compile(r"[^\p{L}\p{N}]+")


_EDGES_JAVA = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def tokens(c) -> Column:
    """array<string> of tokens of a text column.

    Separators at both ends are stripped before splitting, so no empty token
    appears and no lambda (interpreted) is needed; empty text -> [].
    """
    c = F.col(c) if isinstance(c, str) else c
    spaced = F.regexp_replace(F.lower(c), _HAN_JAVA, " $1 ")
    trimmed = F.regexp_replace(spaced, _EDGES_JAVA, "")
    return F.when(trimmed == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, _SPLIT_JAVA))


def term_count(toks: Column, token: str) -> Column:
    """Occurrences of ``token`` in a token array (no lambda)."""
    return F.size(toks) - F.size(F.array_remove(toks, F.lit(token)))


def query_tokens(text: str | None) -> list[str]:
    """Tokens of a search string, de-duplicated in first-seen order."""
    if not text:
        return []
    spaced = _HAN_PY.sub(r" \1 ", text.lower())
    out: list[str] = []
    for t in _SPLIT_PY.split(spaced):
        if t and t not in out:
            out.append(t)
    return out
