"""Join computed values back to their records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(
    left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "full"
) -> DataFrame:
    """Equi-join on nested keys: ``keys`` maps a left path to a right path.

    The column names of the two sides must differ.

    Spark cannot split a hot key of a full outer join over several tasks, so the full join is
    put together from joins that adaptive execution can split on either side:

    * rows with a null key match nothing and pass without a shuffle, however many there are;
    * matched rows come from an inner join;
    * unmatched rows come from an outer join with the other side's distinct keys.

    The last two read the same exchanges: each side is shuffled once in full, plus its distinct
    keys, which are reduced before their shuffle.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    a = left.select("*", *[F.col(p).alias(f"l{n}") for p, n in zip(keys, names, strict=True)])
    b = right.select(
        "*", *[F.col(p).alias(f"r{n}") for p, n in zip(keys.values(), names, strict=True)]
    )
    same = _all(F.col(f"l{n}") == F.col(f"r{n}") for n in names)
    if how != "full":
        return a.join(b, same, how).drop(*[f"{side}{n}" for n in names for side in "lr"])

    a_keyed, b_keyed = _all(F.col(f"l{n}").isNotNull() for n in names), _all(
        F.col(f"r{n}").isNotNull() for n in names
    )
    a_known, b_known = a.where(a_keyed), b.where(b_keyed)
    a_keys = a_known.select(*[f"l{n}" for n in names]).distinct()
    b_keys = b_known.select(*[f"r{n}" for n in names]).distinct()

    matched = a_known.join(b_known, same, "inner").select(*left.columns, *right.columns)
    rest = [
        a_known.join(b_keys, same, "left").where(f"r{names[0]} IS NULL").select(*left.columns),
        b_known.join(a_keys, same, "left").where(f"l{names[0]} IS NULL").select(*right.columns),
        a.where(~a_keyed).select(*left.columns),
        b.where(~b_keyed).select(*right.columns),
    ]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), rest, matched)


def _all(conditions) -> Column:
    return reduce(Column.__and__, conditions)
