"""Quality rules: hard limits, then robust multivariate outliers per language and source.

Every text gives a vector of transformed statistics. For each (language, source) a minimum-covariance-determinant
estimate is fitted: from two starts, concentration steps keep the share ``COVERAGE`` of rows that lie closest to the
current centre and fit centre and scatter anew; the start with the smaller determinant wins. A text is rejected when
its Mahalanobis distance from the robust centre is beyond the chi-square limit.

All of it is column expressions and grouped sums. A step needs the counts of distances per histogram bin (bins of 1.1%
in width) and the sums of products up to the bin that completes the coverage; both combine map-side, so a source with a
third of all rows costs no task more than its share. Estimates are one short row per group and are broadcast only
after they have been counted. Groups below ``MIN_ROWS`` are pooled within their language, and languages that are still
too small with one another; if that pool is too small as well, only the hard limits decide.

Defined results: a null text counts as one without words; null language or source is a value of its own; repeated rows
weigh as often as they occur; an empty table gives no rows; other columns are carried along untouched by ``keep``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import cut, join_small

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
COVERAGE = 0.75
STEPS = 6
MIN_ROWS = 60
# Share of clean texts that the limit would reject if their statistics were normal.
TAIL = 1e-6
# Names of the transformed statistics and the least deviation that counts as ordinary in each.
FLOORS = {"x_length": 0.6, "x_word": 0.10, "x_symbols": 0.06, "x_lines": 0.15, "x_repeats": 0.12}

_WHITE = " \t\n\x0b\f\r"
_GROUP = ["g_level", "g_lang", "g_source"]


# Statistics of one text ------------------------------------------------------------------------------------------

def words_of(text: Column) -> Column:
    """Words between bytes 0x20 and 0x09 to 0x0D; an empty array without any."""
    trimmed = F.btrim(text, F.lit(_WHITE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _named(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside the functions of arrays."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are hashed and sorted with their places, so equal ones are neighbours. Texts without a repeated window,
    which a set of the hashes shows, skip the sort.
    """
    def covered(windows: Column) -> Column:
        twin = lambda k, other: F.coalesce(F.get(windows, k)["h"] == F.get(windows, other)["h"], F.lit(False))
        hits = F.filter(F.sequence(F.lit(0), F.size(windows) - 1), lambda k: twin(k, k - 1) | twin(k, k + 1))
        return F.size(F.array_distinct(F.flatten(F.transform(
            hits, lambda k: F.sequence(F.get(windows, k)["i"], F.get(windows, k)["i"] + 2)))))

    def repeated(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_named(placed, covered))

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return _named(hashes, repeated)

    return F.when(F.size(words) < 4, 0).otherwise(_named(words, counted)).cast("long")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of every text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    whole = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    split = whole.withColumns({
        "_words": words_of(F.col("_text")),
        "_lines": F.filter(F.split("_text", "\n", -1), lambda line: F.length(F.btrim(line, F.lit(_WHITE))) > 0),
    })
    return split.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeat_words(F.col("_words")),
    }).drop("_text", "_words", "_lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vector() -> dict[str, Column]:
    """The transformed statistics: logarithms of sizes, square roots of shares."""
    share = lambda part, whole: F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))
    return {
        "x_length": F.log(F.col("n_words") + 1.0),
        "x_word": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        "x_symbols": share("n_symbols", "word_chars"),
        "x_lines": share("n_dup_lines", "n_lines"),
        "x_repeats": share("n_repeat_words", "n_words"),
    }


# Chi-square constants --------------------------------------------------------------------------------------------

def chi_square_below(x: float, dims: int) -> float:
    """Probability of a chi-square variable up to ``x``, by the series of the incomplete gamma function."""
    a, half = dims / 2, x / 2
    if half <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi_square_limit(share: float, dims: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_below(middle, dims) < share else (low, middle)
    return high


# Estimates -------------------------------------------------------------------------------------------------------

class Robust:
    """Minimum-covariance-determinant estimates of the columns in ``floors``, one per group."""

    def __init__(self, floors: dict[str, float], coverage: float = COVERAGE, steps: int = STEPS):
        self.names, self.floors, self.coverage, self.steps = list(floors), floors, coverage, steps
        d = len(self.names)
        inner = chi_square_limit(coverage, d)
        # Scatter of the closest rows of a normal sample is too small by this factor.
        self.consistency = coverage / chi_square_below(inner, d + 2)

    def _pairs(self):
        return [(i, j) for i in range(len(self.names)) for j in range(i + 1)]

    def _moments(self, grouped, where: Column | None = None) -> DataFrame:
        use = (lambda c: F.when(where, c)) if where is not None else (lambda c: c)
        sums = [F.sum(use(F.lit(1))).alias("n")]
        sums += [F.sum(use(F.col(x))).alias(f"s_{i}") for i, x in enumerate(self.names)]
        sums += [F.sum(use(F.col(self.names[i]) * F.col(self.names[j]))).alias(f"p_{i}_{j}") for i, j in self._pairs()]
        return grouped.agg(*sums)

    def _from_moments(self, sums: DataFrame, scale: float) -> DataFrame:
        """Centre and covariance out of sums; ``scale`` multiplies the covariance."""
        n = F.col("n")
        out = sums.withColumns({f"m_{i}": F.col(f"s_{i}") / n for i in range(len(self.names))})
        out = out.withColumns({
            f"c_{i}_{j}": (F.col(f"p_{i}_{j}") / n - F.col(f"m_{i}") * F.col(f"m_{j}")) * scale for i, j in self._pairs()
        })
        return self._factored(out)

    def _factored(self, out: DataFrame) -> DataFrame:
        """The triangular factor ``l_i_j`` of covariance plus squared floors, and the logarithm of its determinant."""
        keep = [c for c in out.columns if c in _GROUP or c == "start"]
        for i, j in self._pairs():
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            if i == j:
                floor = self.floors[self.names[i]] ** 2
                # Rounding may leave a little less than the floor of a column that depends on the ones before.
                cell = F.sqrt(F.greatest(rest + floor, F.lit(floor / 4)))
            else:
                cell = rest / F.col(f"l_{j}_{j}")
            out = out.withColumn(f"l_{i}_{j}", cell)
        spread = F.lit(0.0)
        for i in range(len(self.names)):
            spread = spread + F.log(f"l_{i}_{i}")
        return out.select(
            *keep, *[f"m_{i}" for i in range(len(self.names))], *[f"l_{i}_{j}" for i, j in self._pairs()],
            (2 * spread).alias("log_det"),
        )

    def distance2(self, rows: DataFrame) -> DataFrame:
        """``rows`` that carry estimate columns, with the squared Mahalanobis distance ``d2``."""
        for i, x in enumerate(self.names):
            z = F.col(x) - F.col(f"m_{i}")
            for k in range(i):
                z = z - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
            rows = rows.withColumn(f"z_{i}", z / F.col(f"l_{i}_{i}"))
        total = F.lit(0.0)
        for i in range(len(self.names)):
            total = total + F.col(f"z_{i}") * F.col(f"z_{i}")
        return rows.withColumn("d2", total).drop(*[f"z_{i}" for i in range(len(self.names))])

    def fit(self, rows: DataFrame, n_groups: int) -> DataFrame:
        """One estimate per group of ``rows`` (group columns and statistics): centre, factor, ``log_det``."""
        both = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
        keys = [*_GROUP, "start"]
        # The first start is the plain mean and covariance, the second one ignores all correlation and every row
        # that is far from the mean in any single column.
        plain = cut(self._from_moments(self._moments(rows.groupBy(*_GROUP)), 1.0))
        near = F.lit(True)
        for i, x in enumerate(self.names):
            near = near & (F.abs(F.col(x) - F.col(f"m_{i}")) <= F.sqrt(F.col(f"l_{i}_{i}") * F.col(f"l_{i}_{i}") + self.floors[x] ** 2))
        own = self._moments(join_small(rows, plain, _GROUP, n_groups).groupBy(*_GROUP), near).where("n > 0")
        diagonal = own.withColumns({f"p_{i}_{j}": F.col(f"s_{i}") * F.col(f"s_{j}") / F.col("n") for i, j in self._pairs() if i != j})
        starts = plain.withColumn("start", F.lit(0)).unionByName(
            self._from_moments(diagonal, 1.0).withColumn("start", F.lit(1)))
        estimate = cut(starts)
        bins = F.floor(64 * F.log2(F.col("d2") + 1)).cast("int")
        order = W.partitionBy(*[F.col(k) for k in keys]).orderBy("bin")
        for _ in range(self.steps):
            scored = self.distance2(join_small(both, estimate, keys, 2 * n_groups).where("log_det is not null"))
            scored = scored.select(*keys, *self.names, bins.alias("bin"))
            counts = scored.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("in_bin"))
            counts = counts.withColumns({
                "upto": F.sum("in_bin").over(order.rowsBetween(W.unboundedPreceding, 0)),
                "all": F.sum("in_bin").over(W.partitionBy(*[F.col(k) for k in keys])),
            })
            last = counts.where(F.col("upto") >= self.coverage * F.col("all")).groupBy(*keys).agg(F.min("bin").alias("last_bin"))
            closest = join_small(scored, last, keys, 2 * n_groups).where("bin <= last_bin")
            estimate = cut(self._from_moments(self._moments(closest.groupBy(*keys)), self.consistency))
        least = W.partitionBy(*[F.col(k) for k in _GROUP]).orderBy("log_det", "start")
        return cut(estimate.withColumn("_place", F.row_number().over(least)).where("_place = 1").drop("_place", "start"))


def _groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """``g_*`` columns for every (lang, source): its own group, its language's pool, the common pool, or none (null)."""
    counts = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    enough = F.col("n") >= min_rows
    by_lang = W.partitionBy(F.struct("lang"))
    counts = counts.withColumn("lang_rest", F.sum(F.when(enough, 0).otherwise(F.col("n"))).over(by_lang))
    level = F.when(enough, 2).when(F.col("lang_rest") >= min_rows, 1).otherwise(0)
    return counts.select(
        "lang", "source", level.alias("g_level"), F.when(level >= 1, F.col("lang")).alias("g_lang"),
        F.when(level == 2, F.col("source")).alias("g_source"),
    )


class QualityRules:
    """Rules fitted on documents with columns text, lang and source."""

    def __init__(self, estimates: DataFrame, groups: DataFrame, n_groups: int, robust: Robust, tail: float):
        self.estimates, self.groups, self.n_groups, self.robust = estimates, groups, n_groups, robust
        self.limit = chi_square_limit(1 - tail, len(robust.names))

    @classmethod
    def fit(cls, vectors: DataFrame, min_rows: int = MIN_ROWS, tail: float = TAIL, coverage: float = COVERAGE,
            steps: int = STEPS, floors: dict[str, float] = FLOORS) -> QualityRules:
        """``vectors``: lang, source and statistics of the texts that pass the hard limits."""
        robust = Robust(floors, coverage, steps)
        groups = cut(_groups(vectors, min_rows))
        n_groups = groups.count()
        keyed = join_small(vectors, groups, ["lang", "source"], n_groups).select(*_GROUP, *robust.names)
        # A common pool that is still too small has no estimate.
        counted = keyed.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows).drop("n")
        estimates = robust.fit(join_small(keyed, counted.withColumn("_enough", F.lit(True)), _GROUP, n_groups).where("_enough").drop("_enough"), n_groups)
        return cls(estimates, groups, n_groups, robust, tail)

    def judge(self, rows: DataFrame) -> DataFrame:
        """``rows`` with lang, source and statistics, plus ``d2`` (null without an estimate), base_failed and kept."""
        grouped = join_small(rows, self.groups, ["lang", "source"], self.n_groups)
        placed = join_small(grouped, self.estimates, _GROUP, self.n_groups)
        scored = self.robust.distance2(placed)
        near = F.coalesce(F.col("d2") <= self.limit, F.lit(True))
        estimate_columns = [c for c in self.estimates.columns if c not in _GROUP]
        # One expression over both sides of the joins: a plain "and" would be split and its first part, with all the
        # counting it needs, be computed once more below them.
        kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(near)
        return scored.withColumn("base_failed", base_failed()).withColumn("kept", kept).drop(
            *_GROUP, *estimate_columns)


def measured(docs: DataFrame) -> DataFrame:
    """Id, lang, source, counts and transformed statistics of every document, without the text."""
    counts = statistics(docs.select("doc_id", "lang", "source", "text")).drop("text")
    return counts.withColumns(vector())


def keep(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their columns as they were."""
    # Written out before the limits are applied, which would else be computed from the texts a second time.
    rows = cut(measured(docs).select("lang", "source", "n_words", "n_repeat_words", *FLOORS))
    rules = QualityRules.fit(rows.where(~base_failed()).select("lang", "source", *FLOORS), **options)
    packed = docs.select(F.struct("*").alias("_row"), "lang", "source", "text")
    judged = rules.judge(statistics(packed).withColumns(vector()))
    return judged.where("kept").select("_row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(measured(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    rules = QualityRules.fit(rows.where(~base_failed()).select("lang", "source", *FLOORS))
    return rules.judge(rows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "source", "d2",
    )
