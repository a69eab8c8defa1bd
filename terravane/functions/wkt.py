"""WKT text to vertices, as Column expressions on separators rather than regex captures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring_body(text: Column) -> Column:
    """Coordinates of the first ring in ``text``; null when it holds no ring."""
    head = F.substring_index(text, ")", 1)
    return F.when(F.contains(text, F.lit("(")), F.substring_index(head, "(", -1))


def ring_bodies(text: Column) -> Column:
    """Coordinates of every ring in ``text``, outer ring first."""
    body = F.substring_index(text, "((", -1)
    return F.when(
        F.contains(text, F.lit("((")), F.split(F.rtrim(F.translate(body, ")", " ")), r"\s+,\s*\(")
    )


def member_bodies(text: Column) -> Column:
    """Members of a multipolygon, each still holding its rings."""
    return F.when(F.contains(text, F.lit("(((")), F.split(text, r"\)\)\s*,\s*\(\("))


def member_ring(member: Column) -> Column:
    """Outer ring of a member cut from its neighbours, with or without leading brackets."""
    return F.substring_index(F.substring_index(member, ")", 1), "(", -1)


def vertices(body: Column) -> Column:
    """The coordinate texts of a ring, in order; a leading blank may remain."""
    return F.split(body, ",")


def ordinate(vertex: Column, position: int) -> Column:
    """Number at ``position`` of a coordinate text, null if absent or malformed."""
    return F.get(F.split(F.ltrim(vertex), " "), F.lit(position)).try_cast("double")
