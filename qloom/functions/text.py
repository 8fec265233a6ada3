"""Text helpers: stripping, splitting and templates as Spark columns."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, functions as F

_EDGES = r"(?U)^\s+|\s+$"
_TAIL = r"(?U)\s+$"
_BLANKS = r"(?U)\s+"


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.regexp_replace(col, _EDGES, "")


def rstrip(col: Column) -> Column:
    return F.regexp_replace(col, _TAIL, "")


def words(col: Column) -> Column:
    """White-space separated words; no empty entries."""
    return F.filter(F.split(col, _BLANKS), lambda w: w != "")


def same_words(a: Column, b: Column) -> Column:
    """Equal word by word, ignoring case and spacing."""
    return words(F.lower(a)) == words(F.lower(b))


def is_match(said: Column, wanted: Column) -> Column:
    """Whether an answer has the words of a reference; a missing answer has not."""
    return F.coalesce(same_words(said, wanted), F.lit(False))


def word_count(col: Column) -> Column:
    """Number of words, null for null; no array of words is made."""
    return F.regexp_count(col, F.lit(r"(?U)\S+"))


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` marks of a fixed template by columns."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(values[piece])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def split_once(col: Column, mark: str) -> tuple[Column, Column]:
    """Text before and after the first mark; the second is null where the mark is absent."""
    at = F.instr(col, mark)
    before = F.when(at > 0, F.substring(col, F.lit(1), at - 1)).otherwise(col)
    after = F.when(at > 0, F.substring(col, at + len(mark), F.length(col)))
    return before, after


def contains_all(col: Column, tokens: Column) -> Column:
    """Every token occurs, ignoring case."""
    low = F.lower(col)
    return F.forall(tokens, lambda t: F.contains(low, F.lower(t)))


def contains_any(col: Column, tokens: Column) -> Column:
    """Some token occurs, case kept."""
    return F.exists(tokens, lambda t: F.contains(col, t))
