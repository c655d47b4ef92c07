"""Aggregates by name, and aggregates over the groups that enclose a group.

``Agg(x, n)`` is the aggregate over the group that remains when the last ``n`` keys are
dropped. It is computed from the finer groups' partial results, so the input is read and
shuffled once; rows of the enclosing level are as many as its groups.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Aggregate:
    """Partial columns from the input, how two partials merge, and the result of the partials."""

    partial: Callable[[Column], list[Column]]
    merge: list[Callable[[Column], Column]]
    finish: Callable[[list[Column]], Column] = lambda parts: parts[0]


_positive = lambda c: F.when(c > 0, c).otherwise(F.lit(0))
_negative = lambda c: F.when(c < 0, c).otherwise(F.lit(0))
_flat = lambda c: F.flatten(F.collect_list(c))
_latest = Aggregate(lambda c: [F.max_by(c, c["CommittedWhen"]), F.max(c["CommittedWhen"])], [], lambda p: p[0])
_earliest = Aggregate(lambda c: [F.min_by(c, c["CommittedWhen"]), F.min(c["CommittedWhen"])], [], lambda p: p[0])

AGGREGATES: dict[str, Aggregate] = {
    "count": Aggregate(lambda c: [F.count(c)], [F.sum]),
    "sum": Aggregate(lambda c: [F.sum(c)], [F.sum]),
    "min": Aggregate(lambda c: [F.min(c)], [F.min]),
    "max": Aggregate(lambda c: [F.max(c)], [F.max]),
    "avg": Aggregate(lambda c: [F.sum(c), F.count(c)], [F.sum, F.sum], lambda p: F.try_divide(p[0], p[1])),
    "sumincome": Aggregate(lambda c: [F.sum(_positive(c))], [F.sum]),
    "sumoutcome": Aggregate(lambda c: [F.sum(_negative(c))], [F.sum]),
    "maxcommit": _latest,
    "mincommit": _earliest,
    "aggregatefiles": Aggregate(lambda c: [F.collect_list(c)], [_flat]),
    "aggregatedirectories": Aggregate(lambda c: [F.collect_list(c)], [_flat]),
    "aggregatevalues": Aggregate(lambda c: [F.collect_list(c)], [_flat], lambda p: F.array_join(F.transform(p[0], lambda x: x.cast("string")), ",")),
}


def _merged(name: str, parts: list[Column]) -> list[Column]:
    if name in ("maxcommit", "mincommit"):
        pick, best = (F.max_by, F.max) if name == "maxcommit" else (F.min_by, F.min)
        return [pick(parts[0], parts[1]), best(parts[1])]
    return [m(p) for m, p in zip(AGGREGATES[name].merge, parts)]


def aggregate(df: DataFrame, keys: list[Column], wanted: list[tuple[str, Column, int, bool]]) -> tuple[DataFrame, list[str], list[str]]:
    """Group by ``keys`` and compute ``wanted`` (name, argument, parent level, distinct).

    Returns the table with the names of its key columns and result columns. Without keys
    there is one group, also of no rows.
    """
    names = [f"__key{i}" for i in range(len(keys))]
    partials: list[Column] = []
    own: list[list[str]] = []
    for i, (name, arg, parent, distinct) in enumerate(wanted):
        if distinct:
            if parent:
                raise ValueError("distinct aggregates have no parent level")
            parts = [{"count": F.count_distinct, "sum": F.sum_distinct}[name](arg)]
        else:
            parts = AGGREGATES[name].partial(arg)
        own.append([f"__a{i}_{k}" for k in range(len(parts))])
        partials += [p.alias(n) for p, n in zip(parts, own[i])]
    rows = df.groupBy(*[k.alias(n) for k, n in zip(keys, names)])
    if not partials:
        partials = [F.count(F.lit(1)).alias("__rows")]
    base = rows.agg(*partials)
    out, results = base, []
    for i, (name, _, parent, distinct) in enumerate(wanted):
        finish = (lambda p: p[0]) if distinct else AGGREGATES[name].finish
        results.append(f"__r{i}")
        if not parent:
            out = out.withColumn(f"__r{i}", finish([F.col(c) for c in own[i]]))
    for level in sorted({w[2] for w in wanted if w[2]}):
        prefix = names[: max(0, len(names) - level)]
        at = [i for i, w in enumerate(wanted) if w[2] == level]
        merged = [m.alias(c) for i in at for m, c in zip(_merged(wanted[i][0], [F.col(c) for c in own[i]]), own[i])]
        upper = base.groupBy(*prefix).agg(*merged)
        upper = upper.select(*[F.col(p).alias(f"__up{k}") for k, p in enumerate(prefix)], *[AGGREGATES[wanted[i][0]].finish([F.col(c) for c in own[i]]).alias(f"__r{i}") for i in at])
        if prefix:
            on = [F.col(p).eqNullSafe(F.col(f"__up{k}")) for k, p in enumerate(prefix)]
            out = out.join(upper, on).drop(*[f"__up{k}" for k in range(len(prefix))])
        else:
            out = out.join(F.broadcast(upper))  # one row
    return out.select(*names, *results), names, results
