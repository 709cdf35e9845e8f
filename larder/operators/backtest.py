"""Rolling origin: every day is scored by a model that was fitted on earlier days only."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fold:
    """A model is fitted on days before ``first`` (at least ``gap`` days before) and scores ``first`` to ``last``."""

    number: int
    first: dt.date
    last: dt.date
    gap: int = 0

    @property
    def known_until(self) -> dt.date:
        return self.first - dt.timedelta(days=1 + self.gap)


def folds(first_day: dt.date, last_day: dt.date, n: int, days: int, gap: int = 0) -> list[Fold]:
    """The last ``n`` stretches of ``days`` days up to ``last_day``, in order.

    A stretch before which no day is known is left out. ``gap`` keeps days away whose outcome was
    not yet known when the model was fitted, such as the horizon of a forecast.
    """
    found = []
    for i in range(n):
        last = last_day - dt.timedelta(days=days * (n - 1 - i))
        fold = Fold(i, last - dt.timedelta(days=days - 1), last, gap)
        if fold.known_until >= first_day:
            found.append(fold)
    return found


def rolling_origin(
    rows: DataFrame,
    day: str,
    origins: Sequence[Fold],
    fit: Callable[[DataFrame], object],
    score: Callable[[object, DataFrame], DataFrame],
    at_once: int = 3,
) -> DataFrame:
    """Scores of all folds with ``fold``, ``known_until`` and the day they are for.

    ``score`` must keep the day. Folds are fitted side by side; a fold without rows on either side of
    its origin gives none.
    """
    spark = rows.sparkSession

    def one(fold: Fold) -> DataFrame | None:
        known = rows.filter(F.col(day) <= F.lit(fold.known_until))
        ahead = rows.filter(F.col(day).between(F.lit(fold.first), F.lit(fold.last)))
        if known.isEmpty() or ahead.isEmpty():
            return None
        return score(fit(known), ahead).withColumns(
            {"fold": F.lit(fold.number), "known_until": F.lit(fold.known_until)}
        )

    with ThreadPoolExecutor(at_once) as pool:
        parts = [p for p in pool.map(inheritable_thread_target(spark)(one), origins) if p is not None]
    if not parts:
        raise ValueError("no fold has rows before and after its origin")
    return reduce(DataFrame.unionByName, parts)
