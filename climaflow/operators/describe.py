"""Descriptive statistics with exact interpolated quantiles, by distributed selection.

No column is sorted. A pass over the table is one aggregate with one row as its result. The first one sketches every column;
the sketch proposes a few pivots around the rank that is sought. The next pass counts exactly how many values lie below
and up to each pivot, so the rank is either at a pivot or strictly between two, and sketches what lies between for the
pass after. Each pass leaves a share of the values that the sketch's accuracy sets, whatever their distribution; ties
only help, as a pivot takes all values equal to it away. When few values are left between two pivots they are counted
by value and read. Passes grow with the logarithm of the table to the base of some hundreds: two or three for any table
of readings.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixedpoint import exact_sum, usable

QUANTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}
# Values between two pivots that are read by the driver, for each rank sought.
KEEP = 4000
# Pieces of equal counts that a sketch proposes, and its accuracy.
PIECES, ACCURACY = 200, 10_000


@dataclass
class _Open:
    """Ranks of a column (from 0) known to lie strictly between two values; ``before`` values come earlier."""

    column: str
    ranks: list[int]
    low: float | None
    high: float | None
    before: int
    inside: int
    pieces: list[float] | None = None  # of a sketch of what lies between

    def within(self) -> Column:
        x = F.col(self.column)
        held = x.isNotNull()
        if self.low is not None:
            held &= x > self.low
        return held if self.high is None else held & (x < self.high)

    def pivots(self) -> list[float]:
        """The sketch's values next to the ranks, nearer ones between farther ones."""
        found = set()
        for rank in self.ranks:
            at = (rank - self.before) / max(self.inside - 1, 1) * PIECES
            for k in (math.floor(at) - 2, math.floor(at), math.ceil(at), math.ceil(at) + 2):
                found.add(self.pieces[min(max(k, 0), PIECES)])
        return sorted(found)


def _sketch(x: Column) -> Column:
    return F.percentile_approx(x, [k / PIECES for k in range(PIECES + 1)], ACCURACY)


def select_ranks(df: DataFrame, ranks: dict[str, list[int]], counts: dict[str, int], sketches: dict[str, list[float]] | None = None,
                 keep: int = KEEP) -> dict[tuple[str, int], float]:
    """The values of the given ranks (from 0, nulls left out) of columns of doubles with ``counts`` values."""
    found: dict[tuple[str, int], float] = {}
    waiting = [_Open(c, sorted(set(r)), None, None, 0, counts[c], (sketches or {}).get(c)) for c, r in ranks.items() if counts[c]]
    while large := [o for o in waiting if o.inside > keep]:
        small = [o for o in waiting if o.inside <= keep]
        asked = [(o, o.pivots() if o.pieces else []) for o in large]
        exprs = []
        for k, (o, pivots) in enumerate(asked):
            x, held = F.col(o.column), o.within()
            for p in pivots:
                exprs += [F.count_if(held & (x < p)), F.count_if(held & (x <= p))]
            if pivots:
                held &= (x > pivots[0]) & (x < pivots[-1])
            exprs.append(_sketch(F.when(held, x)))
        got = iter(df.agg(*[e.alias(f"a{k}") for k, e in enumerate(exprs)]).first())
        waiting = small
        for o, pivots in asked:
            cuts = [(p, o.before + next(got), o.before + next(got)) for p in pivots]
            pieces = next(got)
            edges = [(o.low, o.before, o.before), *cuts, (o.high, o.before + o.inside, o.before + o.inside)]
            for rank in o.ranks:
                at = next((p for p, below, upto in cuts if below <= rank < upto), None)
                if at is not None:
                    found[o.column, rank] = at
                    continue
                k = next(k for k in range(len(edges) - 1) if edges[k][2] <= rank < edges[k + 1][1])
                low, high = edges[k], edges[k + 1]
                same = next((w for w in waiting if (w.column, w.low, w.high) == (o.column, low[0], high[0])), None)
                if same:
                    same.ranks.append(rank)
                    continue
                inner = _Open(o.column, [rank], low[0], high[0], low[2], high[1] - low[2])
                if pieces and (not pivots or (0 < k < len(cuts))):
                    # What the sketch saw of this gap, as pieces of it.
                    seen = [p for p in pieces if (low[0] is None or p > low[0]) and (high[0] is None or p < high[0])]
                    inner.pieces = [seen[min(j * len(seen) // (PIECES + 1), len(seen) - 1)] for j in range(PIECES + 1)] if seen else None
                waiting.append(inner)
    if waiting:
        held = [F.when(o.within(), F.struct(F.lit(k).alias("at"), F.col(o.column).alias("v"))) for k, o in enumerate(waiting)]
        rows = df.select(F.explode(F.array_compact(F.array(*held))).alias("p")).groupBy("p.at", "p.v").agg(F.count(F.lit(1)).alias("n"))
        values: dict[int, list] = {}
        for row in rows.orderBy("at", "v").collect():
            values.setdefault(row["at"], []).append((row["v"], row["n"]))
        for k, o in enumerate(waiting):
            upto, left = o.before, iter(values[k])
            for rank in sorted(o.ranks):
                while upto <= rank:
                    v, n = next(left)
                    upto += n
                found[o.column, rank] = v
    return found


def exact_quantiles(df: DataFrame, columns: list[str], shares: dict[str, float] = QUANTILES, keep: int = KEEP) -> dict[str, dict[str, float | None]]:
    """Quantiles of each column, interpolated between the two nearest ranks, of the usable values as they are."""
    return {c: row["quantiles"] for c, row in _figures(df, columns, shares, keep).items()}


def _figures(df: DataFrame, columns: list[str], shares: dict[str, float], keep: int) -> dict[str, dict]:
    slim = df.select(*[usable(F.col(c).cast("double")).alias(c) for c in columns])
    parts = {"rows": F.count, "total": exact_sum, "std": F.stddev_samp, "min": F.min, "max": F.max, "sketch": lambda c: _sketch(F.col(c))}
    first = slim.agg(*[make(c).alias(f"{name}_{k}") for k, c in enumerate(columns) for name, make in parts.items()]).first()
    out = {c: {name: first[f"{name}_{k}"] for name in parts} for k, c in enumerate(columns)}
    places = {(c, q): (out[c]["rows"] - 1) * p for c in columns for q, p in shares.items() if out[c]["rows"]}
    ranks: dict[str, list[int]] = {}
    for (c, _), at in places.items():
        ranks.setdefault(c, []).extend([math.floor(at), math.ceil(at)])
    values = select_ranks(slim, ranks, {c: out[c]["rows"] for c in columns}, {c: out[c]["sketch"] for c in columns}, keep)
    for c in columns:
        out[c]["quantiles"] = {}
        for q in shares:
            at = places.get((c, q))
            if at is None:
                out[c]["quantiles"][q] = None
                continue
            low, high = values[c, math.floor(at)], values[c, math.ceil(at)]
            out[c]["quantiles"][q] = low + (high - low) * (at - math.floor(at))
    return out


def describe(df: DataFrame, columns: list[str], keep: int = KEEP) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max, one row per column that has usable values."""
    rows = []
    for c, f in _figures(df, columns, QUANTILES, keep).items():
        if f["rows"]:
            rows.append((c, f["rows"], float(f["total"]) / f["rows"], f["std"], f["min"], *f["quantiles"].values(), f["max"]))
    measures = ["mean", "std", "min", *QUANTILES, "max"]
    found = df.sparkSession.createDataFrame(rows, ", ".join(["column_name string", "rows bigint", *[f"{c} double" for c in measures]]))
    return found.select("column_name", "rows", *[F.col(c) if c in ("min", "max") else F.round(c, 6).alias(c) for c in measures])
