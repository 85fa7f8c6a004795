"""Array expressions over a policy's ranked factors.

A factor list is ``array<struct<feature:string,value:double>>`` in rank order.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapsewise.fixed_values import ACTIONS, DEFAULT_ACTION, DESCRIPTIONS, NOT_ACTIONABLE, TOP_FACTORS
from lapsewise.functions.scalars import half_even
from lapsewise.schemas import FACTORS


def _lookup(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(entries.items())])


def _texts_for_risk(factors: Column, entries: dict[str, str]) -> Column:
    """Texts of the factors that push towards risk and have an entry, in rank order."""
    table = _lookup(entries)
    pushing = F.filter(
        factors,
        lambda f: (f["feature"] != NOT_ACTIONABLE)
        & (f["value"] > 0)
        & F.map_contains_key(table, f["feature"]),
    )
    return F.transform(pushing, lambda f: F.element_at(table, f["feature"]))


def recommended_action(
    factors: Column, actions: dict[str, str] = ACTIONS, default: str = DEFAULT_ACTION
) -> Column:
    """The action of the first actionable factor, else ``default``."""
    return F.coalesce(F.get(_texts_for_risk(factors, actions), F.lit(0)), F.lit(default))


def described(
    factors: Column, max_items: int = 3, descriptions: dict[str, str] = DESCRIPTIONS
) -> Column:
    """Up to ``max_items`` plain descriptions, in rank order."""
    if max_items < 1:
        raise ValueError("max_items must be at least 1")
    texts = F.coalesce(_texts_for_risk(factors, descriptions), F.array().cast("array<string>"))
    return F.slice(texts, 1, max_items)


def why_flagged(factors: Column) -> Column:
    reasons = described(factors)
    return F.when(F.size(reasons) == 0, F.lit("-")).otherwise(F.array_join(reasons, "; "))


def strongest(contributions: Column, names: list[str], n: int) -> Column:
    """Positions and values of the ``n`` largest contributions by magnitude, in order.

    ``contributions`` is an ``array<double>`` aligned with ``names``; ties keep
    that order. The result is ``array<struct<rank, i, v>>``.
    """
    labelled = F.zip_with(
        F.sequence(F.lit(0), F.lit(len(names) - 1)),
        contributions,
        lambda i, v: F.struct((-F.abs(v)).alias("rank"), i.alias("i"), v.alias("v")),
    )
    return F.slice(F.array_sort(labelled), 1, n)


def name_at(names: list[str], position: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in names]), position)


def top_factors(contributions: Column, names: list[str], n: int = TOP_FACTORS) -> Column:
    """The factor list of a score: rounded after ranking, before anyone tests a sign."""
    return F.transform(
        strongest(contributions, names, n),
        lambda entry: F.struct(
            name_at(names, entry["i"]).alias("feature"), half_even(entry["v"], 4).alias("value")
        ),
    )


def factors_to_json(factors: Column) -> Column:
    """``[{"feature": ..., "value": ...}, ...]`` for sinks that only store text."""
    return F.to_json(factors)


def factors_from_json(text: Column) -> Column:
    return F.from_json(text, FACTORS)
