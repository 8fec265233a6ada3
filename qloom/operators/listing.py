"""Listings whose columns are chosen by role."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from qloom.operators.filters import conjunction
from qloom.operators.ordering import order_by


@dataclass(frozen=True)
class Roles:
    """Which columns of a table are its id, name, numbers, dates and categories."""

    id: str | None = None
    name: str | None = None
    category: Sequence[str] = field(default_factory=tuple)
    numeric: Sequence[str] = field(default_factory=tuple)
    date: Sequence[str] = field(default_factory=tuple)


def listing_columns(roles: Roles, columns: Sequence[str]) -> list[str]:
    """Id, name, one category, two numbers and one date; the first five columns if none has a role."""
    wanted = [roles.id, roles.name, *roles.category[:1], *roles.numeric[:2], *roles.date[:1]]
    chosen = list(dict.fromkeys(c for c in wanted if c))
    return chosen or list(columns[:5])


def listing(
    df: DataFrame,
    roles: Roles,
    where: Sequence[Column] = (),
    order: str | None = None,
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Filtered, ordered listing of an entity table."""
    out = conjunction(df, list(where))
    out = order_by(out, order, roles.numeric, roles.id, descending)
    out = out.select(*listing_columns(roles, df.columns))
    return out.limit(limit) if limit else out


def joined_listing(joined: DataFrame, primary: Roles, secondary_numeric: Sequence[str]) -> DataFrame:
    """Id and name of the primary table beside the first number found on another one.

    ``secondary_numeric`` lists the candidates in table order. Without any role, all columns stay.
    """
    chosen = [c for c in (primary.id, primary.name, *secondary_numeric[:1]) if c]
    return joined.select(*chosen) if chosen else joined
