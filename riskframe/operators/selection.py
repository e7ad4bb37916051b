"""Exact percentiles by distributed selection.

A sketch as fine as the table is no bounded sketch.  Here a coarse one only says where to
look: a first pass brackets every wanted rank between two values, passes that count and
sketch inside the bracket narrow it while it holds too many rows, and a last pass lists
the distinct values inside the brackets with their counts and counts what lies below.
The value at the rank is read off that list, so it is exact whatever the sketch said; a
bracket that turns out not to hold its rank is widened and the pass repeated.

Each pass is one aggregate over the table for all columns and ranks.  A task keeps a sketch
of ``accuracy`` entries a rank, the driver ``listed`` values a rank; neither grows with the
table.  A pass narrows a bracket some hundredfold, so 10^13 rows take five passes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Context, Decimal
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

from riskframe.functions.columns import qcol

#: Entries of a sketch, and values of a bracket that are listed.
ACCURACY, LISTED = 10_000, 10_000


_WIDE = Context(prec=80)


@dataclass
class _Target:
    """One wanted rank of a column, from 0, and its bracket ``low <= value <= high`` (None: open)."""

    column: str
    share: Fraction
    slack: Fraction
    low: object = None
    high: object = None
    inside: float = 0.0  # rows expected in the bracket
    value: object = None
    rank: int = 0
    done: bool = False


def _rank(share: Fraction, n: int) -> int:
    """Place, from 0, of the least value that ``share`` of the rows do not exceed."""
    return max(ceil(share * n), 1) - 1


def _within(t: _Target, strictly: bool = False) -> Column:
    c, keep = qcol(t.column), F.lit(True)
    if t.low is not None:
        keep = keep & (c > F.lit(t.low) if strictly else c >= F.lit(t.low))
    if t.high is not None:
        keep = keep & (c < F.lit(t.high) if strictly else c <= F.lit(t.high))
    return keep & c.isNotNull()


def _padded(value, side: int):
    """A sketch holds numbers as doubles: integers and decimals of more than 15 digits come back rounded, so
    their bounds give way by that much."""
    if isinstance(value, Decimal):
        exponent = value.as_tuple().exponent
        whole = int(value.scaleb(-exponent, _WIDE))
        return Decimal(whole + side * (abs(whole) >> 51)).scaleb(exponent, _WIDE)
    if isinstance(value, int):
        return max(min(value + side * (abs(value) >> 51), 2 ** 63 - 1), -2 ** 63 + 1)
    return value


def _grid(rows: int) -> list[float]:
    return [i / rows for i in range(rows + 1)]


def _sketch(column: str, condition: Column | None, shares: list[float], accuracy: int) -> Column:
    c = qcol(column)
    return F.percentile_approx(c if condition is None else F.when(condition, c), [float(min(max(s, 0.0), 1.0)) for s in shares], accuracy)


def _bracket(df: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """First pass: rows of each column, and values just below and above each wanted share."""
    columns = list(dict.fromkeys(t.column for t in targets))
    own = {c: [t for t in targets if t.column == c] for c in columns}
    ends = {c: [float(t.share + side * t.slack) for t in own[c] for side in (-1, 1)] for c in columns}
    row = df.agg(*[x for i, c in enumerate(columns) for x in (F.count(qcol(c)).alias(f"n{i}"), _sketch(c, None, ends[c], accuracy).alias(f"s{i}"))]).first()
    for i, c in enumerate(columns):
        n, found = row[f"n{i}"], row[f"s{i}"]
        for k, t in enumerate(own[c]):
            if not n:
                t.done = True
                continue
            t.rank = _rank(t.share, n)
            t.low = _padded(found[2 * k], -1) if t.share - t.slack > 0 else None
            t.high = _padded(found[2 * k + 1], 1) if t.share + t.slack < 1 else None
            t.inside = min(1.0, float(4 * t.slack)) * n


def _narrow(df: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """Count each bracket's ends and inside, and sketch the inside as a grid."""
    steps = max(accuracy // 20, 16)  # a bracket of five steps is then narrower than what it came from, so each pass gets on
    parts = []
    for i, t in enumerate(targets):
        c = qcol(t.column)
        below = F.count_if(c < F.lit(t.low)) if t.low is not None else F.lit(0)
        at_low = F.count_if(c == F.lit(t.low)) if t.low is not None else F.lit(0)
        at_high = F.count_if(c == F.lit(t.high)) if t.high is not None and t.high != t.low else F.lit(0)
        parts += [below.alias(f"b{i}"), at_low.alias(f"l{i}"), at_high.alias(f"h{i}"), F.count_if(_within(t, True)).alias(f"m{i}"),
                  _sketch(t.column, _within(t, True), _grid(steps), accuracy).alias(f"g{i}")]
    row = df.agg(*parts).first()
    for i, t in enumerate(targets):
        below, low, inside, high = (row[f"{k}{i}"] for k in "blmh")
        place = t.rank - below
        if place < 0:
            t.low = None  # the sketch's promise did not hold: open that side and look again
        elif place < low:
            t.value, t.done = t.low, True
        elif place < low + inside:
            grid, at = row[f"g{i}"], (place - low) / inside * steps
            left, right, before = int(at) - 2, int(at) + 3, (t.low, t.high)
            if left >= 0:
                t.low = _padded(grid[left], -1) if t.low is None else max(t.low, _padded(grid[left], -1))
            if right <= steps:
                t.high = _padded(grid[right], 1) if t.high is None else min(t.high, _padded(grid[right], 1))
            # where doubles are too coarse to get on, the values left are listed
            t.inside = inside * 6 / steps if before != (t.low, t.high) else 0
        elif place < low + inside + high:
            t.value, t.done = t.high, True
        else:
            t.high = None


def _parser(kind: DataType):
    """Reads a value back from its text, exactly."""
    return int if isinstance(kind, IntegralType) else Decimal if isinstance(kind, DecimalType) else float


def _list(df: DataFrame, targets: list[_Target]) -> None:
    """Last pass: the distinct values inside each bracket with their counts, and the rows below it as one."""
    cells = F.array(*[F.struct(
        F.lit(i).alias("t"),
        F.when(qcol(t.column) < F.lit(t.low) if t.low is not None else F.lit(False), 0).when(_within(t), 1).alias("side"),
        F.when(_within(t), qcol(t.column).cast("string")).alias("v")) for i, t in enumerate(targets)])
    rows = df.select(F.inline(cells)).filter("side is not null").groupBy("t", "side", "v").count()
    below, inside = {}, {}
    for r in rows.collect():  # a bounded number of values for each target
        if r["side"]:
            inside.setdefault(r["t"], []).append((r["v"], r["count"]))
        else:
            below[r["t"]] = r["count"]
    types = {f.name: _parser(f.dataType) for f in df.schema.fields}
    for i, t in enumerate(targets):
        place = t.rank - below.get(i, 0)
        total = sum(n for _, n in inside.get(i, ()))
        if not 0 <= place < total:
            t.slack = min(t.slack * 16, Fraction(1))
            t.low, t.high = (None if place < 0 else t.low), (None if place >= total else t.high)
            t.inside = float("inf")  # widened: narrow again
            continue
        parse = types[t.column]
        for value, n in sorted(((parse(v), n) for v, n in inside[i]), key=lambda x: (x[0] != x[0], x[0])):  # NaN last, as Spark orders
            place -= n
            if place < 0:
                t.value, t.done = value, True
                break


def exact_percentiles(df: DataFrame, wanted: Mapping[str, tuple[Column, list[float]]], accuracy: int = ACCURACY, listed: int = LISTED) -> dict[str, list]:
    """Per name the exact (discrete) percentiles of a column expression at the shares given: the least
    value that so many of the non-null rows do not exceed, None without rows.  ``df`` is read a few
    times; give a table or a materialised frame."""
    df = df.select(*[c.alias(name) for name, (c, _) in wanted.items()])
    targets = [_Target(name, Fraction(str(p)), Fraction(2, accuracy)) for name, (_, shares) in wanted.items() for p in shares]
    if targets:
        _bracket(df, targets, accuracy)
    while left := [t for t in targets if not t.done]:
        wide = [t for t in left if t.inside > listed]
        _narrow(df, wide, accuracy) if wide else _list(df, left)
    values = iter(targets)
    return {name: [next(values).value for _ in shares] for name, (_, shares) in wanted.items()}


def percentile_columns(df: DataFrame, wanted: Mapping[str, tuple[Column, list[float]]], accuracy: int | None) -> dict[str, list[Column]]:
    """For an aggregate over ``df``: per name the percentiles as columns, exact ones (literals, selected
    beforehand) for ``accuracy=None``, else a sketch of ``accuracy`` entries."""
    if accuracy is not None:
        return {name: [F.percentile_approx(c, float(p), accuracy) for p in shares] for name, (c, shares) in wanted.items()}
    types = dict(df.select(*[c.alias(name) for name, (c, _) in wanted.items()]).dtypes)
    exact = exact_percentiles(df, wanted)
    return {name: [F.lit(v).cast(types[name]) for v in exact[name]] for name in wanted}


def percentile_values(df: DataFrame, wanted: Mapping[str, tuple[Column, list[float]]], accuracy: int | None) -> dict[str, list]:
    """The percentiles themselves, one pass with a sketch or exact ones for ``accuracy=None``."""
    if not wanted:
        return {}
    if accuracy is None:
        return exact_percentiles(df, wanted)
    row = df.agg(*[F.percentile_approx(c, [float(p) for p in shares], accuracy).alias(name) for name, (c, shares) in wanted.items()]).first()
    return {name: list(row[name]) if row[name] is not None else [None] * len(shares) for name, (_, shares) in wanted.items()}
