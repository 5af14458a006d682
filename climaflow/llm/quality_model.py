"""Quality classifier: histogram gradient-boosted trees over statistics of documents.

Every text becomes a vector of statistics of its bytes, words, word runs and lines, computed for many texts at a time
from the byte buffer of a column. Labels of at most ``TRAIN_ROWS`` documents, chosen by a hash of their ids, are learnt
from; the vectors of these rows, some megabytes, are all that the driver sees. Trees are grown on histograms of binned
features: per level one weighted count of (node, bin) per feature gives the gain of every split. A forest is
kept as flat arrays (feature, bin, value) of complete trees, so that scoring steps all rows through all nodes of one
level at once.

Texts are read once: the vectors are written out, and both the training rows and all scores come from them.

Defined results: null and empty texts have the vector of no bytes and get its score; ids without labels are scored
like all others; a null id is in the remainder of the empty text and has no label; several labels of one id count
as their smallest; without labels of both kinds every score is the share of label 1 (one half without any label);
repeated rows stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import run_dir
from .common import remainder_of_id
from .words import hashed, mix, runs, text_buffers, white_space_words

PARTS, HELD_OUT = 4, 2
# Labelled rows that are learnt from, at most.
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS = 80, 4, 0.15, 64
PENALTY, LEAST_WEIGHT = 1.0, 5.0
ACCEPT = 0.7

FEATURES = [
    "log_words", "word_length", "distinct_share", "top_word_share", "repeat_run_share", "short_word_share", "long_word_share",
    "upper_share", "digit_share", "symbol_share", "pipe_share", "stop_share", "comma_share", "shout_share", "other_punct_share",
    "beyond_ascii_share", "log_lines", "dup_line_share", "words_per_line", "words_per_stop", "longest_repeat_share",
]

_CHUNK_BYTES = 1 << 20


def _byte_class(*ranges) -> np.ndarray:
    out = np.zeros(256, bool)
    for r in ranges:
        out[list(r)] = True
    return out


_SYMBOLS = _byte_class(b"#*$%&<>")
_CLASSES = {
    "upper_share": _byte_class(range(65, 91)), "digit_share": _byte_class(range(48, 58)), "symbol_share": _SYMBOLS,
    "pipe_share": _byte_class(b"|"), "stop_share": _byte_class(b".?"), "comma_share": _byte_class(b",;:"),
    "shout_share": _byte_class(b"!"), "other_punct_share": _byte_class(b"\"'()[]{}=_/\\@~^`+-"),
    "beyond_ascii_share": _byte_class(range(128, 256)),
}


def _per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive edges."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


def _repeats(of: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: distinct keys, occurrences of the most frequent one, occurrences of keys that occur twice or more."""
    order = np.lexsort((keys, of))
    of, keys = of[order], keys[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(of)))
    owner = of[first]
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, times)
    return np.bincount(owner, minlength=n), top, np.bincount(owner, weights=np.where(times > 1, times, 0), minlength=n)


def vectors(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    at, data = text_buffers(texts)
    out = np.zeros((len(at) - 1, len(FEATURES)), np.float32)
    alphabet, first = white_space_words(), 0
    while first < len(out):
        last = max(first + 1, int(np.searchsorted(at, at[first] + _CHUNK_BYTES, "right")) - 1)
        last = min(last, len(out))
        out[first:last] = _chunk_vectors(data[at[first]:at[last]], at[first:last + 1] - at[first], alphabet)
        first = last
    return out


def _chunk_vectors(data: np.ndarray, edges: np.ndarray, alphabet) -> np.ndarray:
    n = len(edges) - 1
    words, starts = hashed(data, edges, alphabet)
    n_words = np.diff(starts)
    of = np.repeat(np.arange(n), n_words)
    size = np.maximum(np.diff(edges), 1)
    some = np.maximum(n_words, 1)
    column = {name: _per_text(c[data], edges) / size for name, c in _CLASSES.items()}
    letters = _per_text(alphabet.in_word[data], edges)
    inside = alphabet.in_word[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = edges[(edges > 0) & (edges < len(data))]
    begin[cuts] = inside[cuts]
    begins = np.flatnonzero(begin)
    # A word's length is what its text's running count of word bytes grows by up to the next word.
    running = np.concatenate([[0], np.cumsum(inside)])
    length = np.diff(np.append(running[begins], running[-1])) if len(begins) else np.zeros(0, np.int64)
    distinct, top, _ = _repeats(of, words, n)
    three = runs(words, 3)
    whole = of[:len(three)] == of[2:] if len(three) else np.zeros(0, bool)
    _, _, repeated = _repeats(of[:len(three)][whole], three[whole], n)
    same_next = (words[1:] == words[:-1]) & (of[1:] == of[:-1]) if len(words) else np.zeros(0, bool)
    twins = np.bincount(of[1:][same_next], minlength=n) if len(words) else np.zeros(n)

    # Lines: a hash per line of its words, for lines with a word.
    breaks = np.flatnonzero(data == 10) + 1
    line_edges = np.unique(np.concatenate([edges, breaks]))
    line_first = np.searchsorted(begins, line_edges)
    line_words = np.diff(line_first)
    line_of = np.searchsorted(edges, line_edges[:-1], "right") - 1
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(words * (np.arange(len(words), dtype=np.uint64) * np.uint64(0) + np.uint64(3))), dtype=np.uint64)])
    key = total[line_first[1:]] - total[line_first[:-1]]
    real = line_words > 0
    lines = np.bincount(line_of[real], minlength=n)
    line_kinds, _, _ = _repeats(line_of[real], key[real], n)
    stops = _per_text(_CLASSES["stop_share"][data], edges)
    column |= {
        "log_words": np.log1p(n_words), "word_length": letters / some, "distinct_share": distinct / some,
        "top_word_share": top / some, "repeat_run_share": repeated / some,
        "short_word_share": np.bincount(of[length <= 2], minlength=n) / some,
        "long_word_share": np.bincount(of[length >= 12], minlength=n) / some,
        "log_lines": np.log1p(lines), "dup_line_share": (lines - line_kinds) / np.maximum(lines, 1),
        "words_per_line": np.log1p(n_words / np.maximum(lines, 1)), "words_per_stop": np.log1p(n_words / np.maximum(stops, 1)),
        "longest_repeat_share": twins / some,
    }
    return np.stack([column[f] for f in FEATURES], axis=1).astype(np.float32)


# Trees -----------------------------------------------------------------------------------------------------------

@dataclass
class Trees:
    """Complete trees of one depth in flat arrays: node k has children 2k + 1 and 2k + 2."""

    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # trees x inner nodes: greater values go right
    value: np.ndarray  # trees x leaves
    base: float

    @property
    def depth(self) -> int:
        return int(self.value.shape[1]).bit_length() - 1

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - inner]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def bin_limits(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Upper limits of the bins of every feature: its quantiles, without repeats."""
    shares = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, f], shares, method="lower")).astype(np.float32) for f in range(x.shape[1])]


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Trees:
    """Trees boosted on the logistic loss; splits are searched in histograms of gradients."""
    share = float(np.mean(y)) if len(y) else 0.5
    inner, leaves = (1 << depth) - 1, 1 << depth
    if not len(y) or not 0 < share < 1:
        base = 0.0 if not len(y) else (40.0 if share else -40.0)
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, leaves)), base)
    limits = bin_limits(x, bins)
    binned = np.stack([np.searchsorted(limits[f], x[:, f], "left") for f in range(x.shape[1])])
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    features, cuts, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        pull, weight = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-9)
            at_level = node - first
            chosen = np.full(width, -1)
            chosen_bin = np.zeros(width, np.int64)
            for f in range(x.shape[1]):
                cells = at_level * bins + binned[f]
                g = np.bincount(cells, weights=pull, minlength=width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(cells, weights=weight, minlength=width * bins).reshape(width, bins).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + PENALTY) + (all_g - g) ** 2 / (all_h - h + PENALTY) - all_g**2 / (all_h + PENALTY)
                gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = 0
                gain = gain[:, :max(len(limits[f]), 1)]
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best
                best = np.where(better, gain[np.arange(width), top], best)
                chosen, chosen_bin = np.where(better, f, chosen), np.where(better, top, chosen_bin)
            for k in np.flatnonzero(chosen >= 0):
                feature[first + k], cut[first + k] = chosen[k], limits[chosen[k]][chosen_bin[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        g, h = (np.bincount(leaf, weights=w, minlength=leaves) for w in (pull, weight))
        value = rate * g / (h + PENALTY)
        margin += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Trees(np.array(features), np.array(cuts), np.array(values), base)


# The operator ----------------------------------------------------------------------------------------------------

def _vector_rows(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = vectors(batch.column(1))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.record_batch([batch.column(0), lists], names=["doc_id", "vector"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, vector array<float>")


def _matrix(column) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(), np.float32).reshape(-1, len(FEATURES))


def fit(rows: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees for ``labels`` (doc_id, quality) on ``rows`` (doc_id, vector), from rows that are not held out."""
    known = labels.where("doc_id is not null and quality is not null").where(remainder_of_id("doc_id", PARTS) != HELD_OUT)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(train_rows)
    found = rows.join(sample, "doc_id").select("doc_id", "quality", "vector").toArrow().sort_by("doc_id")
    return grow(_matrix(found.column("vector")), found.column("quality").to_numpy().astype(np.float64))


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    path = f"{run_dir(spark, 'vectors')}/rows.parquet"
    _vector_rows(docs).write.parquet(path)
    rows = spark.read.parquet(path)
    shared = spark.sparkContext.broadcast(fit(rows, labels, train_rows))

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(_matrix(batch.column(2)))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= ACCEPT).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    held = (remainder_of_id("doc_id", PARTS) == HELD_OUT).alias("held_out")
    return rows.select("doc_id", held, "vector").mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def op4_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
