"""Exact order statistics of a distributed column.

Spark's ``percentile`` keeps every distinct value of the column in one task, which does not
hold for an event-grain metric. Here a mergeable sketch proposes an interval around the wanted
rank and a counting pass proves on which side the rank lies, so the interval shrinks by orders
of magnitude per round. When no more rows are left inside than a sketch keeps apart, the sketch
names the value itself and the same count proves it, so there is one way for every size. Each
round is two map-side aggregations; the rows themselves are never shuffled or gathered, and a
value that fills a third of the table becomes an interval end and drops out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import scratch

SKETCH_ACCURACY = 10_000
SKETCH_GROUPS = 32
MAX_CLASSES = 1_000
LOWER_HALF = 2**32 - 1


@dataclass
class _Search:
    """One wanted rank, and the open interval (low, high) that still holds it."""

    column: str
    rank: int  # among the rows inside the interval, from 0
    inside: int  # rows strictly inside the interval
    low: Any = None
    high: Any = None
    answer: Any = None
    done: bool = False

    def within(self) -> Column:
        value = F.col(self.column)
        kept = value.isNotNull()
        if self.low is not None:
            kept = kept & (value > F.lit(self.low))
        if self.high is not None:
            kept = kept & (value < F.lit(self.high))
        return kept

    def settle(self, answer: Any) -> None:
        self.answer, self.done = answer, True


def order_statistics(df: DataFrame, wanted: Sequence[tuple[Column, int, int]]) -> list[Any]:
    """Values at the given ranks. ``wanted`` holds (expression, rank from 0, non-null count).

    The wanted expressions alone are written below the shared folder first, and removed at the
    end: every round compares a value several times, which would evaluate its expression as often.
    So the source is read once, and each round reads eight bytes per row.

    Sketches hold doubles, in which a long such as a row hash loses its last digits. Longs are
    therefore searched by their upper half first, then by the lower half among equals.
    """
    for _, rank, count in wanted:
        if not 0 <= rank < count:
            raise ValueError(f"rank {rank} is outside 0..{count - 1}")
    if not wanted:
        return []
    distinct = list({id(e): e for e, _, _ in wanted}.values())
    names = {id(e): f"v{i}" for i, e in enumerate(distinct)}
    columns = df.select([e.alias(names[id(e)]) for e in distinct])
    long = {f.name for f in columns.schema.fields if isinstance(f.dataType, T.LongType)}
    with scratch(columns, "ranked-values") as values:
        return _ranked(values, [(names[id(e)], rank, count) for e, rank, count in wanted], long)


def _ranked(values: DataFrame, wanted: Sequence[tuple[str, int, int]], long: set[str]) -> list[Any]:
    columns = {name: F.col(name) for name, _, _ in wanted}
    upper = {name: F.shiftright(columns[name], 32) for name in long}
    found = _search(values, [(upper.get(name, columns[name]), rank, count) for name, rank, count in wanted])
    halves = [(n, columns[name], upper[name], rank) for n, (name, rank, _) in enumerate(wanted) if name in long]
    if halves:
        parts = [part for n, _, half, _ in halves for part in (
            F.count_if(half < F.lit(found[n])).alias(f"under{n}"), F.count_if(half == F.lit(found[n])).alias(f"at{n}"))]
        seen = values.agg(*parts).first()
        rests = _search(values, [
            (F.when(half == F.lit(found[n]), e.bitwiseAND(F.lit(LOWER_HALF))), rank - seen[f"under{n}"], seen[f"at{n}"])
            for n, e, half, rank in halves
        ])
        for (n, _, _, _), rest in zip(halves, rests):
            found[n] = (found[n] << 32) + rest
    return found


def _search(df: DataFrame, wanted: Sequence[tuple[Column, int, int]]) -> list[Any]:
    columns: dict[int, tuple[str, Column]] = {}
    searches: dict[tuple[str, int], _Search] = {}
    for expression, rank, count in wanted:
        name, _ = columns.setdefault(id(expression), (f"v{len(columns)}", expression))
        searches.setdefault((name, rank), _Search(name, rank, count))
    values = df.select([expression.alias(name) for name, expression in columns.values()])
    todo = list(searches.values())
    while todo:
        rows = values.filter(reduce(or_, [s.within() for s in todo]))
        _narrow(rows, _propose(rows, todo))
        todo = [s for s in todo if not s.done]
    return [searches[columns[id(expression)][0], rank].answer for expression, rank, _ in wanted]


def _fits(search: _Search) -> bool:
    """Whether a sketch of this accuracy still keeps all rows inside apart."""
    return 2 * search.inside < SKETCH_ACCURACY


def _propose(rows: DataFrame, searches: list[_Search]) -> list[tuple[_Search, Any, Any]]:
    """Two values that should enclose each wanted rank.

    Sketches are merged in a few groups of tasks, not all in one place; the middle proposal of
    the groups is taken. What fits a sketch whole goes into one, which then knows the value. A
    poor proposal costs a round, never a wrong answer.
    """
    sketches = []
    for i, search in enumerate(searches):
        # The middle of the rank's own step; the sketch answers with the value of that step.
        share = (search.rank + 0.5) / search.inside
        margin = 0.0 if _fits(search) else 2 / SKETCH_ACCURACY
        ends = [max(0.0, share - margin), min(1.0, share + margin)]
        inside = F.when(search.within(), F.col(search.column))
        sketches.append(F.percentile_approx(inside, ends, SKETCH_ACCURACY).alias(f"p{i}"))
    if all(_fits(search) for search in searches):
        found = rows.agg(*sketches).collect()
    else:
        group = (F.spark_partition_id() % SKETCH_GROUPS).alias("_group")
        found = rows.groupBy(group).agg(*sketches).drop("_group").collect()
    proposals = []
    for i, search in enumerate(searches):
        ends = [row[i] for row in found if row[i] is not None]
        lows, highs = sorted(e[0] for e in ends), sorted(e[1] for e in ends)
        proposals.append((search, lows[len(lows) // 2], highs[len(highs) // 2]))
    return proposals


def _narrow(rows: DataFrame, narrowing: list[tuple[_Search, Any, Any]]) -> None:
    """Count exactly around each proposed interval and keep the part that holds the rank."""
    counts = []
    for i, (search, left, right) in enumerate(narrowing):
        value, inside = F.col(search.column), search.within()
        counts += [
            F.count_if(inside & (value < F.lit(left))).alias(f"under{i}"),
            F.count_if(inside & (value == F.lit(left))).alias(f"left{i}"),
        ]
        if left != right:
            counts += [
                F.count_if(inside & (value > F.lit(left)) & (value < F.lit(right))).alias(f"between{i}"),
                F.count_if(inside & (value == F.lit(right))).alias(f"right{i}"),
            ]
    seen = iter(rows.agg(*counts).first())
    for search, left, right in narrowing:
        under, at_left = next(seen), next(seen)
        between, at_right = (next(seen), next(seen)) if left != right else (0, 0)
        above = search.inside - under - at_left - between - at_right
        if search.rank < under:
            search.high, search.inside = left, under
        elif search.rank < under + at_left:
            search.settle(left)
        elif search.rank < under + at_left + between:
            search.rank -= under + at_left
            search.low, search.high, search.inside = left, right, between
        elif search.rank < under + at_left + between + at_right:
            search.settle(right)
        else:
            search.rank -= search.inside - above
            search.low, search.inside = right, above


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[Any, Sequence[float]],
    expressions: Mapping[Any, Column] | None = None,
    counts: Mapping[Any, int] | None = None,
) -> dict[Any, list[float | None]]:
    """Linearly interpolated quantiles per name; nulls and NaN are skipped, none left gives None.

    A name is a column of ``df``, or any key that ``expressions`` defines. A caller that knows how many
    values are neither null nor NaN passes these ``counts`` and saves a pass.
    """
    source = {c: (expressions[c] if c in (expressions or {}) else F.col(c)).cast("double") for c in wanted}
    names = {c: f"v{i}" for i, c in enumerate(wanted)}
    clean = df.select([F.nanvl(value, F.lit(None)).alias(names[c]) for c, value in source.items()])
    requests: list[tuple[str, int, int]] = []
    with scratch(clean, "ranked-values") as values:
        seen = None if counts else values.agg(*[F.count(name) for name in names.values()]).first()
        counted = counts or dict(zip(names, seen))
        for column, shares in wanted.items():
            count = counted[column]
            if count:
                for share in shares:
                    position = share * (count - 1)
                    requests += [(names[column], rank, count) for rank in (math.floor(position), math.ceil(position))]
        answers = iter(_ranked(values, requests, set()))
    result: dict[Any, list[float | None]] = {}
    for column, shares in wanted.items():
        count = counted[column]
        result[column] = []
        for share in shares:
            if not count:
                result[column].append(None)
                continue
            low, high = next(answers), next(answers)
            position = share * (count - 1)
            # The same operations as the built-in percentile, so that both agree to the last digit.
            between = (math.ceil(position) - position) * low + (position - math.floor(position)) * high
            result[column].append(low if low == high or position == math.floor(position) else between)
    return result


def group_counts(df: DataFrame, by: str) -> dict[Any, int]:
    """Rows per non-null value of a label; a column with over ``MAX_CLASSES`` values is refused."""
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).count().limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"'{by}' has over {MAX_CLASSES} values; it is no class label")
    return {row[0]: row[1] for row in counts}


def first_shares(
    df: DataFrame,
    by: str,
    order: Column,
    shares: Sequence[float],
    counts: Mapping[Any, int] | None = None,
) -> dict[Any, list[Any]]:
    """Per value of ``by``, the ``order`` value that closes the first round(share * count) rows.

    A row-numbering window would put a whole class into one task; these cutoffs make any
    stratified split a plain filter. ``by`` must have few values (class labels); pass their
    ``counts`` where known. ``None`` stands for an empty share.
    """
    if counts is None:
        counts = group_counts(df, by)
    requests, sizes = [], {}
    for value, count in counts.items():
        sizes[value] = [min(count, math.floor(share * count + 0.5)) for share in shares]
        member = F.when(F.col(by) == F.lit(value), order)
        requests += [(member, size - 1, count) for size in sizes[value] if size]
    answers = iter(order_statistics(df, requests) if requests else [])
    return {value: [next(answers) if size else None for size in wanted] for value, wanted in sizes.items()}
