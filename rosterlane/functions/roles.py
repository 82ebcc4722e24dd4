"""Ranking of contact roles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNLISTED = 2147483647


def role_rank(
    column: Column, hierarchy: Sequence[str], part: str, unlisted: int = UNLISTED
) -> Column:
    """Rank of a role: one that contains ``part`` comes right after the listed ones, which rank by
    place (the part is tested first); every other role, and null, is last."""
    rank = F.when(column.contains(part), len(hierarchy))
    for place, role in enumerate(hierarchy):
        rank = rank.when(column == role, place)
    return rank.otherwise(unlisted)
