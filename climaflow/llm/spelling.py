r"""Spelling variants of words, grouped through a dictionary of pairs of trie nodes.

Words are counted over all texts. Every prefix of a word is a node of the trie of all words, every suffix one of the trie
of the words read backwards, and nodes are integers. A word split before position ``i`` is the pair (node of the prefix,
node of the suffix); with position ``i`` skipped, the suffix begins one later. Two words that differ by a replaced
character have the same pair with that position skipped; the pair of a word with a position skipped is a pair of the
word that lacks this character. So all words whose pairs meet in one key of the dictionary are near each other, and all
near words meet. Equal pairs mean equal prefixes and suffixes, hence nothing has to be verified.

A key holds at most one word as it is and one word per letter with that position skipped: it is bounded by the alphabet,
however many words there are. Each word needs from a key only the number of others and the most frequent other, so
pairs of words are never written out. In a run of equal letters only the first one counts as left out.

Tries are numbered from sorted words: a word adds the nodes beyond what it shares with the word before it. Words are
sorted and cut into ranges by Spark, each range is numbered in one pass, and one row per range (first and last word, path
of the last) goes through the driver to tell which nodes begin in an earlier range. A word's work and
its dictionary entries are linear in its length.

Forms point to words at least twice as frequent, so there are no rings, and a chain is at most the logarithm of the
largest count long; roots are found by doubling the pointers.

Defined results: a null or empty text has no words; a null id counts as an empty text in the checksum; equal rows count
each; ties of frequency go to the word that is smaller in code-point order; an empty table gives no rows. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import cut

LETTER = r"[A-Za-z\u00C0-\u00FF]"
# At least 1.
LEAST_LENGTH = 5
LEAST_COUNT = 3
# A word is a variant of a near word that is this many times as frequent.
TIMES = 2
# One of so many runs loses a letter.
SLIPS = 97

_RUN = 1 << 14  # words numbered before a batch is passed on


def word_counts(docs: DataFrame, slips: int = SLIPS, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and its occurrences ``n`` over all texts of ``docs`` (doc_id, text), letters left out where the checksum says so.

    The table is written; words too short by the lost letter are left out as it is read, as a filter on the grouped word
    would be moved below the grouping and compute every word twice.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc"),
                       F.explode(F.regexp_extract_all("text", F.lit(f"{LETTER}{{{least_length},}}"), F.lit(0))).alias("_run"))
    runs = runs.select("_doc", F.translate("_run", string.ascii_uppercase, string.ascii_lowercase).alias("_run"))
    h = F.crc32(F.concat_ws(":", "_doc", "_run").cast("binary"))
    at = (F.col("_h") % F.char_length("_run")).cast("int")
    slip = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.char_length("_run")))
    words = runs.withColumn("_h", h).select(F.when(F.col("_h") % slips == 0, slip).otherwise(F.col("_run")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
    return cut(counted).where(F.char_length("word") >= least_length)


def _shared(a: str, b: str) -> int:
    """Characters that both begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(k for k in range(n) if a[k] != b[k])


def _number_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted words (word, tag), numbered from 1 within this range; then one row about the range."""
    part = TaskContext.get().partitionId()
    before, path, nodes, words, first = "", [], 0, 0, None
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.int32(), pa.string(), pa.int64()]
    names = ["word", "tag", "place", "nodes", "begins", "part", "first", "n_nodes"]

    def table(rows):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        given = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for some in iter(lambda: list(itertools.islice(given, _RUN)), []):
            rows = []
            for word, tag in some:
                k = _shared(before, word)
                new = len(word) - k
                path = path[:k] + list(range(nodes + 1, nodes + 1 + new))
                begins = [True] + [a != b for a, b in itertools.pairwise(word)]
                rows.append((word, tag, words, path, begins, part, None, None))
                before, nodes, words = word, nodes + new, words + 1
                first = word if first is None else first
            yield table(rows)
    if words:
        yield table([(before, None, words, path, [], part, first, nodes)])


_NUMBERED = ("word string, tag bigint, place bigint, nodes array<bigint>, begins array<boolean>, part int, first string, n_nodes bigint")


def number_trie(words: DataFrame) -> DataFrame:
    """Rows (word, tag) of distinct words with ``place`` in sorted order and the ``nodes`` of their prefixes by length."""
    spark = words.sparkSession
    ranged = words.select("word", "tag").repartitionByRange("word").sortWithinPartitions("word")
    numbered = cut(ranged.mapInArrow(_number_range, _NUMBERED))
    # One row per range.
    ends = numbered.where("first is not null").select("part", "word", "first", "place", "n_nodes", "nodes").orderBy("part").collect()
    starts, last, path, words_before, nodes_before = [], "", [], 0, 0
    for end in ends:
        carried = path[:_shared(last, end["first"])]
        starts.append((end["part"], words_before, nodes_before, carried))
        # The first word of a range has the numbers 1, 2, ...; those it shares with the range before have one already.
        path = [carried[m - 1] if m <= len(carried) else nodes_before + m for m in end["nodes"]]
        last, words_before, nodes_before = end["word"], words_before + end["place"], nodes_before + end["n_nodes"]
    starts = spark.createDataFrame(starts, "part int, words_before bigint, nodes_before bigint, carried array<bigint>")
    rows = numbered.where("first is null").join(F.broadcast(starts), "part")
    whole = F.transform("nodes", lambda m: F.when(m <= F.size("carried"), F.get("carried", (m - 1).cast("int"))).otherwise(F.col("nodes_before") + m))
    return rows.select("word", "tag", (F.col("words_before") + F.col("place")).alias("place"), whole.alias("nodes"), "begins")


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words (word_id, word, n) numbered in code-point order, and their dictionary entries.

    An entry is a pair (``before``, ``after``) of nodes; ``whole`` says that no position is skipped, ``counts`` that the
    skipped letter is the first of a run.
    """
    forward = cut(number_trie(words.select("word", F.col("n").alias("tag"))).select(
        F.col("place").alias("word_id"), "word", F.col("tag").alias("n"), "nodes", "begins"))
    backward = number_trie(forward.select(F.reverse("word").alias("word"), F.col("word_id").alias("tag")))
    backward = backward.select(F.col("tag").alias("word_id"), F.col("nodes").alias("back"))
    root = F.array(F.lit(0).cast("bigint"))
    both = forward.join(backward, "word_id").select(
        "word_id", "n", "begins", F.concat(root, "nodes").alias("ahead"), F.concat(root, "back").alias("back"), F.size("nodes").alias("length"))
    # The root stands at 0, so a prefix of i letters is at i, and the suffix after it at length - i.
    split = F.transform(F.sequence(F.lit(0), F.col("length")), lambda i: F.struct(
        F.get("ahead", i).alias("before"), F.get("back", F.col("length") - i).alias("after"), F.lit(True).alias("whole"), F.lit(False).alias("counts")))
    skip = F.transform(F.sequence(F.lit(0), F.col("length") - 1), lambda i: F.struct(
        F.get("ahead", i).alias("before"), F.get("back", F.col("length") - i - 1).alias("after"), F.lit(False).alias("whole"), F.get("begins", i).alias("counts")))
    entries = both.select("word_id", "n", F.explode(F.concat(split, skip)).alias("e")).select("word_id", "n", "e.*")
    return forward.select("word_id", "word", "n"), entries


def nearest(entries: DataFrame) -> DataFrame:
    """For each word with near words: their number ``n_near`` and the most frequent one (``best_n``, ``best_id``)."""
    key = W.partitionBy("before", "after")
    ranked = key.orderBy(F.desc("n"), "word_id").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    one = F.struct((-F.col("n")).alias("less"), "word_id")
    met = entries.select(
        "word_id", "whole", "counts",
        F.count(F.lit(1)).over(ranked).alias("all"), F.max("whole").over(ranked).alias("has_whole"),
        F.count_if("counts").over(ranked).alias("counting"),
        F.first(one).over(ranked).alias("top"), F.nth_value(one, 2).over(ranked).alias("second"),
    ).where(F.col("all") > 1)
    skipped = F.col("all") - F.col("has_whole").cast("long")
    near = F.when(F.col("whole"), F.col("counting")).otherwise(skipped - 1 + (F.col("has_whole") & F.col("counts")).cast("long"))
    best = F.when(F.col("top.word_id") == F.col("word_id"), F.col("second")).otherwise(F.col("top"))
    found = met.select("word_id", near.alias("near"), best.alias("best")).groupBy("word_id").agg(
        F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return found.select("word_id", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.word_id").alias("best_id"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``root_id`` behind each word's chain of forms (word_id, form_id)."""
    now = cut(forms.select("word_id", F.col("form_id").alias("root_id")))
    while True:
        on = now.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("further"))
        now = cut(now.join(on, "root_id", "left").select("word_id", F.coalesce("further", "root_id").alias("root_id"), "further"))
        if not now.where("further is not null").count():
            return now.select("word_id", "root_id")
        now = now.select("word_id", "root_id")


def group_variants(docs: DataFrame, slips: int = SLIPS, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs`` (doc_id, text)."""
    words, entries = node_pairs(word_counts(docs, slips, least_length, least_count))
    near = cut(words.select("word_id", "n").join(nearest(entries), "word_id"))
    formed = near.where(F.col("best_n") >= TIMES * F.col("n")).select("word_id", F.col("best_id").alias("form_id"), F.col("best_n").alias("form_n"))
    roots = last_forms(formed)
    named = lambda key, name: words.select(F.col("word_id").alias(key), F.col("word").alias(name))
    ends = formed.join(roots, "word_id").join(named("form_id", "form"), "form_id").join(named("root_id", "root"), "root_id")
    whole = words.join(near.select("word_id", "n_near"), "word_id", "left").join(ends.select("word_id", "form", "form_n", "root"), "word_id", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(0, 256))::BIGINT AS b)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc,
    translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
said AS (SELECT doc, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY doc, run),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(doc || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))),
    lambda c, b: xor(t[(xor(c, b) % 256) + 1], c // 256)), 4294967295) AS h
  FROM said, crc_table),
slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times
  FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
places AS (SELECT word, n, unnest(range(0, length(word)))::INT AS i FROM words),
skipped AS (SELECT word, n, left(word, i) AS a, substr(word, i + 2) AS b FROM places),
pairs AS (
  SELECT x.word, y.word AS other, y.n FROM skipped x JOIN skipped y ON x.a = y.a AND x.b = y.b AND x.word != y.word
  UNION SELECT x.word, w.word, w.n FROM skipped x JOIN words w ON w.word = x.a || x.b
  UNION SELECT w.word, x.word, x.n FROM skipped x JOIN words w ON w.word = x.a || x.b),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS best_n FROM pairs GROUP BY word),
top AS (
  SELECT b.word, b.n_near, b.best_n, min(p.other) AS best FROM best b JOIN pairs p ON p.word = b.word AND p.n = b.best_n GROUP BY ALL),
formed AS (
  SELECT w.word, w.n, coalesce(t.n_near, 0) AS n_near, CASE WHEN t.best_n >= 2 * w.n THEN t.best END AS form,
    CASE WHEN t.best_n >= 2 * w.n THEN t.best_n END AS form_n
  FROM words w LEFT JOIN top t ON t.word = w.word),
chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root AND f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root AND f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near::BIGINT AS n_near, f.form_n FROM formed f JOIN ends e ON e.word = f.word
"""
