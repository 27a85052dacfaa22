"""Term matching and highlighting."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_NOT_WORD = r"[^\p{L}\p{N}]+"


def terms(query: str) -> list[str]:
    return [t for t in re.split(r"[\W_]+", query.lower()) if t]


def matches_any(text: Column, query: str) -> Column:
    """True when the text holds at least one term of the query, whatever the case."""
    wanted = F.array(*[F.lit(t) for t in terms(query)])
    return F.arrays_overlap(F.split(F.lower(text), _NOT_WORD), wanted)


def highlight(text: Column, query: str, pre: str = "<em>", post: str = "</em>") -> Column:
    """Wrap every matched term, keeping the case it has in the text."""
    alternatives = "|".join(re.escape(t) for t in terms(query))
    pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}])({alternatives})(?![\p{{L}}\p{{N}}])"
    return F.regexp_replace(text, pattern, f"{pre}$1{post}")
