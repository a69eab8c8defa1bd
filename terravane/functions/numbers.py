"""Fixed-point text of doubles."""

from __future__ import annotations

from terravane import constants as K


def fixed_text(value: str, decimals: int = K.WKT_DECIMALS) -> str:
    """SQL for the decimal text of ``value`` with exactly ``decimals`` digits after the point.

    Between 1 and 100 (every Dutch longitude and latitude) the shortest text of a double has
    at most 16 decimals, so appended zeros cut to length give the same text as ``%.16f`` at a
    fraction of the formatter's cost. Other values and precisions use the formatter.
    """
    # the formatter spells out nulls and non-numbers, which are no coordinates
    formatted = f"if(abs({value}) < 1e300D, format_string('%.{decimals}f', {value}), NULL)"
    if decimals < 16:
        return formatted
    padded = f"concat(string({value}), '{'0' * decimals}')"
    return f"""CASE
        WHEN {value} >= 1D AND {value} < 10D THEN left({padded}, {decimals + 2})
        WHEN {value} >= 10D AND {value} < 100D THEN left({padded}, {decimals + 3})
        ELSE {formatted} END"""
