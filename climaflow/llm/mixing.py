"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic) that weigh as many tokens as they hold. Raking scales the cells to
the target share of each source, then of each language, then of each topic, again and again until no factor moves, or
until the factors stop improving, as they do where empty cells put the targets out of reach: a warning then names the
remaining deviation of each dimension. The raked share of a cell over its tokens says how likely its documents should be kept; the probabilities are scaled to a
token budget, and a seeded hash of the id draws the sample.

Cells are a grouped sum of the documents; raking and scaling are joins and sums over the cells, which are written out
after every sweep, so nothing is collected but a few totals. Documents meet their cell by a join that broadcasts
the cells only after they have been counted, and otherwise salts them against a source with a third of all rows.

Defined results: null or unlisted values take the target's ``rest`` weight; a listed value without tokens is left out
and the other targets share its part; texts without words are drawn like their cell, or kept where the cell has no
token at all (they cost none); where the budget asks for more than a cell holds, the cell is kept whole and the others make up for
it; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import cut, join_small, unit_hash

DIMENSIONS = ("source", "lang", "topic")
SEED = 4117
TOLERANCE = 1e-8
# Factors have stopped improving when they move as much as so many sweeps ago, but for a hundredth.
PATIENCE, IMPROVED = 10, 0.99


@dataclass(frozen=True)
class Target:
    """Relative weights of listed values and of every other value."""

    weights: dict[str, float] = field(default_factory=dict)
    rest: float = 1.0

    def column(self, name: str) -> Column:
        if not self.weights:
            return F.lit(float(self.rest))
        pairs = [F.lit(x) for kv in self.weights.items() for x in (kv[0], float(kv[1]))]
        return F.coalesce(F.element_at(F.create_map(*pairs), F.col(name)), F.lit(float(self.rest)))


# The largest source counts five times, every other one once; languages and forms of text have fixed shares.
TARGETS = {
    "source": Target({"src0": 5.0}),
    "lang": Target({"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11}, rest=0.01),
    "topic": Target({"long prose": 0.47, "prose": 0.435, "note": 0.005, "table": 0.045, "marked": 0.045}),
}
BUDGET_SHARE = 0.5


def tokens_of(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: str = "text", tokens: str = "n_tokens") -> Column:
    """A stand-in topic by the form of a text; documents carry none. Any other column can be raked instead."""
    body = F.coalesce(F.col(text), F.lit(""))
    symbols = F.regexp_count(body, F.lit(r"[#*$%&<>]"))
    return (
        F.when(F.regexp_count(body, F.lit(r" \| ")) >= 3, "table")
        .when(symbols * 50 > F.length(body), "marked")
        .when(F.col(tokens) < 50, "note")
        .when(F.col(tokens) < 600, "prose")
        .otherwise("long prose")
    )


def _cells(rows: DataFrame, targets: dict[str, Target], dims) -> DataFrame:
    """Tokens, target share per dimension and a starting weight (share of all tokens) of every cell with tokens."""
    cells = rows.groupBy(*dims).agg(F.sum("n_tokens").cast("double").alias("mass")).where("mass > 0")
    cells = cut(cells)
    total = cells.agg(F.sum("mass")).first()[0] or 0.0
    cells = cells.withColumn("weight", F.col("mass") / F.lit(total or 1.0))
    for d in dims:
        values = cells.select(d).distinct().withColumn("rel", targets[d].column(d))
        everything = values.agg(F.sum("rel")).first()[0] or 1.0
        cells = cells.withColumn(f"t_{d}", targets[d].column(d) / F.lit(everything))
    return cells.where(" and ".join(f"t_{d} > 0" for d in dims))


def _same(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    right = right.withColumnRenamed(key, "_key")
    return left.join(right, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def deviations(cells: DataFrame, dims=DIMENSIONS) -> dict[str, float]:
    """The largest relative deviation of raked from target shares in each dimension."""
    out = {}
    for d in dims:
        sums = cells.groupBy(d).agg(F.sum("weight").alias("_now"), F.first(f"t_{d}").alias("_target"))
        out[d] = sums.agg(F.max(F.abs(F.col("_now") / F.col("_target") - 1))).first()[0] or 0.0
    return out


def rake(cells: DataFrame, dims=DIMENSIONS, tolerance: float = TOLERANCE, patience: int = PATIENCE) -> DataFrame:
    """``cells`` with ``weight`` fitted to the marginal shares ``t_<dimension>``, the last dimension exactly.

    Warns with the remaining deviations where the factors stop improving before they stop moving.
    """
    moved: list[float] = []
    while True:
        cells = cells.withColumn("moved", F.lit(0.0))
        for d in dims:
            sums = cells.groupBy(d).agg(F.sum("weight").alias("_now"))
            factor = F.col(f"t_{d}") / F.col("_now")
            cells = _same(cells, sums, d).withColumn("_f", factor).withColumns({
                "weight": F.col("weight") * F.col("_f"), "moved": F.greatest("moved", F.abs(F.col("_f") - 1)),
            }).drop("_now", "_f")
        # Each dimension doubles the plan, as it uses the cells twice; so every sweep is written out.
        cells = cut(cells)
        moved.append(cells.agg(F.max("moved")).first()[0] or 0.0)
        if moved[-1] <= tolerance:
            break
        if len(moved) > patience and moved[-1] > IMPROVED * moved[-1 - patience]:
            left = ", ".join(f"{d} {x:.3g}" for d, x in deviations(cells, dims).items())
            warnings.warn(f"raking stopped after {len(moved)} sweeps without meeting its targets; relative deviations: {left}", RuntimeWarning, stacklevel=2)
            break
    return cells.drop("moved")


def calibrate(cells: DataFrame, budget_share: float) -> DataFrame:
    """``probability`` per cell: raked weight over tokens, scaled so that the expected tokens meet the budget."""
    mass, weight = cells.agg(F.sum("mass"), F.sum("weight")).first()
    budget = (mass or 0.0) * budget_share
    scale = budget / weight if weight else 0.0
    while True:
        full = F.lit(scale) * F.col("weight") >= F.col("mass")
        whole, rest = cells.agg(F.sum(F.when(full, F.col("mass")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        better = (budget - (whole or 0.0)) / rest if rest else scale
        # A larger scale can only fill more cells, so this ends.
        if better <= scale * (1 + 1e-12):
            break
        scale = better
    return cells.withColumn("probability", F.least(F.lit(1.0), F.lit(scale) * F.col("weight") / F.col("mass")))


def probabilities(rows: DataFrame, targets: dict[str, Target] = TARGETS, budget_share: float = BUDGET_SHARE,
                  dims=DIMENSIONS) -> tuple[DataFrame, int]:
    """One row per cell with its probability, and how many there are. ``rows``: the dimensions and n_tokens."""
    cells = cut(calibrate(rake(_cells(rows, targets, dims), dims), budget_share).select(*dims, "mass", "weight", "probability"))
    return cells, cells.count()


def _drawn(rows: DataFrame, cells: DataFrame, n_cells: int, seed: int, dims) -> DataFrame:
    # A cell without any token has no row; its documents cost nothing.
    joined = join_small(rows, cells.select(*dims, "weight", "probability"), list(dims), n_cells)
    chance = F.coalesce(F.col("probability"), F.lit(1.0))
    return joined.withColumn("probability", chance).withColumn("selected", unit_hash(seed, F.col("doc_id")) < chance)


def described(docs: DataFrame) -> DataFrame:
    """Id, source, language, topic and tokens of every document."""
    counted = docs.select("doc_id", "source", "lang", "text", tokens_of().alias("n_tokens"))
    return counted.select("doc_id", "source", "lang", topic_of().alias("topic"), "n_tokens")


def sample(docs: DataFrame, targets: dict[str, Target] = TARGETS, budget_share: float = BUDGET_SHARE, seed: int = SEED) -> DataFrame:
    """The drawn documents, with their columns as they were; texts stay where they are up to the size check."""
    cells, n_cells = probabilities(described(docs), targets, budget_share)
    packed = docs.select(F.struct("*").alias("_row"), "doc_id", "source", "lang", "text")
    rows = packed.withColumn("n_tokens", tokens_of()).withColumn("topic", topic_of()).drop("text")
    return _drawn(rows, cells, n_cells, seed, DIMENSIONS).where("selected").select("_row.*")


def op1_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(described(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    cells, n_cells = probabilities(rows)
    return _drawn(rows, cells, n_cells, SEED, DIMENSIONS).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "selected")
