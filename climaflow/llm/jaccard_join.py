"""Documents joined by the Jaccard similarity of their n-gram sets, by rare-first prefix filtering.

Sets hold the hashes of the distinct five-word shingles of a text (``words.shingle_sets``). All sets are sorted by one
order, rare n-grams first: frequent n-grams, found by counting all texts, come last by their counts, and all others before
them by hash. Two sets of similarity 3/4 or more then share an n-gram in their prefixes, the first quarter of each.

1. Copies. Texts with the same set (by size and two sums over its hashes) form a class; one of each class goes on.
2. Prefixes. Every prefix n-gram of every set is dealt by n-gram (frequent ones by n-gram and a salt of the document),
   sorted, and streamed through a filter that knows each list's smallest id and drops the documents of short lists that
   no other document of the list can be paired with.
3. First pairs. In each n-gram's list every document is paired with the list's smallest id only, under the length
   filter and the positional filter (what both prefixes leave can still reach the needed overlap). Pairs are made
   distinct and verified once: the suffix filter bounds the overlap by how many hashes fall into each of 64 parts of the
   hash range, then into each of so many that a part holds a few hashes, and pairs that pass are intersected. Groups of
   near copies collapse to components here, without all pairs of a group being formed.
4. Remaining pairs. Lists that still hold documents of different components are joined with themselves, under the
   same filters, without their smallest ids and documents that only these can be paired with; pairs of one component are already connected and are left out. So are pairs that a common partner
   rules out: with distance d = 1 - similarity, d(a, b) >= |d(a, c) - d(b, c)|. What is left is verified the same way.

So every pair of similarity 3/4 or more is either verified or lies in one component already; no list is cut short.

Lists are joined by equality joins, which adaptive execution splits where one n-gram has very many documents. Sets are
made again from the texts of the documents that are in a pair; ids that choose texts are broadcast only up to a counted
``LOCAL_IDS``, beyond that texts are joined with them.

Defined results: texts without words (nulls too) have an empty set and are linked with nothing; a text of one to four
words has its whole sequence as one shingle; rows with the same id are one document, whose links are those of any of
its texts; rows without an id get their size and the smallest id of their class, if any; repeated rows stay; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import cut, delete, join_small, run_dir
from .components import roots
from .words import Chunk, chunks, mix, shingle_sets, white_space_words

WORDS = 5
# Similarity: 100 * intersection >= PERCENT * union.
PERCENT = 75
# Frequent n-grams that the order knows by their count, and how many a task proposes at a time.
FREQUENT, PROPOSED = 200_000, 20_000
# Documents of one frequent n-gram that share a salt, about.
PER_SALT = 2_000
# Ids that are broadcast to choose texts.
LOCAL_IDS = 4_000_000
BROADCAST_IDS = 1_000_000
# Hash ranges of the suffix filter, powers of 2: at the first look, and at least for pairs that pass it. A range should hold
# a few hashes of a set: where it holds many, unlike sets have about as many each, and the bound says nothing. So sets of
# more than ``RANGES * FILL`` hashes have more ranges, with up to ``FILL`` hashes each on average.
COARSE = 64
RANGES = 256
FILL = 4
# Lists up to this many rows are looked through for documents that no other can be paired with.
SHORT_LIST = 16

_BUFFER = 4_000_000


def _sets(batch: pa.RecordBatch, column: int) -> Iterator[tuple[Chunk, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of texts with (text index, hash) of all sets and the size of each set."""
    for c in chunks(batch.column(column), white_space_words()):
        of, grams = shingle_sets(c, WORDS)
        yield c, of, grams, np.bincount(of, minlength=c.last - c.first).astype(np.int64)


def _sums(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; equal sets have equal sums, and others have not but for a chance of 2^-128."""
    ends = np.cumsum(sizes)
    out = []
    for salt in (np.uint64(0), np.uint64(0x7FB5D329728EA185)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ salt), dtype=np.uint64)])
        out.append((total[ends] - total[ends - sizes]).view(np.int64))
    return out[0], out[1]


def _row_key(doc_id: np.ndarray, known: np.ndarray, first_sum: np.ndarray) -> np.ndarray:
    """A row's id and set in one number."""
    return mix(np.where(known, doc_id, -1).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ first_sum.view(np.uint64))


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known


# 1. Sizes, copies and frequent n-grams ---------------------------------------------------------------------------

_FIRST = "doc_id bigint, n bigint, sum_1 bigint, sum_2 bigint, key bigint, gram bigint, times bigint"


def _measured(batches):
    held, size = [], 0
    names = [f.split()[0] for f in _FIRST.split(", ")]

    def proposals():
        grams, times = np.unique(np.concatenate(held), return_counts=True)
        often = np.flatnonzero(times > 1)
        if len(often) > PROPOSED:
            often = often[np.argpartition(-times[often], PROPOSED)[:PROPOSED]]
        none = pa.nulls(len(often), pa.int64())
        return pa.record_batch([none] * 5 + [pa.array(grams[often].view(np.int64)), pa.array(times[often])], names=names)

    for batch in batches:
        for c, of, grams, sizes in _sets(batch, 1):
            rows = batch.column(0)[c.first:c.last]
            ids, known = _ids(rows)
            one, two = _sums(grams, sizes)
            none = pa.nulls(len(sizes), pa.int64())
            key = _row_key(ids, known, one).view(np.int64)
            yield pa.record_batch([rows, *[pa.array(x) for x in (sizes, one, two, key)], none, none], names=names)
            held.append(grams)
            size += len(grams)
            if size >= _BUFFER:
                yield proposals()
                held, size = [], 0
    if held:
        yield proposals()


def _measure(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per row: doc_id, size and sums of its set, and ``rep``, the smallest id of its class. Frequent n-grams."""
    spark = docs.sparkSession
    path = f"{run_dir(spark, 'sets')}/measured.parquet"
    docs.select("doc_id", "text").mapInArrow(_measured, _FIRST).write.parquet(path)
    found = spark.read.parquet(path)
    rows = found.where("n is not null").drop("gram", "times")
    same = ["n", "sum_1", "sum_2"]
    counted = rows.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"))
    # Written out, so that the join with a class of a third of all rows is one that can be spread.
    repeated = cut(counted.where("members > 1 and n > 0").select(*same, "rep"))
    frequent = found.where("gram is not null").groupBy("gram").agg(F.sum("times").alias("times"))
    copies = join_small(rows, repeated, same, repeated.count())
    # Without words a row stays alone.
    rows = cut(copies.withColumn("rep", F.coalesce("rep", "doc_id")))
    return rows, frequent.orderBy(F.desc("times"), "gram").limit(FREQUENT)


# Choosing texts --------------------------------------------------------------------------------------------------

def _over_sets(docs: DataFrame, work, schema: str, choose=None) -> DataFrame:
    """``work`` over the sets of rows with an id and words; ``choose`` (row keys, ids) says which of them.

    The same document twice in a chunk counts once.
    """
    def run(batches):
        for batch in batches:
            for c, of, grams, sizes in _sets(batch, 1):
                ids, known = _ids(batch.column(0)[c.first:c.last])
                keys = _row_key(ids, known, _sums(grams, sizes)[0]).view(np.int64)
                use = np.zeros(len(ids), bool)
                use[np.unique(keys, return_index=True)[1]] = True
                use &= known & (sizes > 0)
                if choose is not None:
                    use &= choose(keys, ids)
                if use.any():
                    mine = use[of]
                    yield from work(ids, of[mine], grams[mine], sizes)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _numbers(column: DataFrame) -> np.ndarray:
    return np.sort(column.toArrow().column(0).to_numpy().astype(np.int64))


def _one_per_class(docs: DataFrame, rows: DataFrame, work, schema: str, local_ids: int) -> DataFrame:
    """``work`` over the sets of the smallest id of each class."""
    copies = rows.where("doc_id != rep").select("key").distinct()
    if copies.count() > local_ids:
        reps = rows.select(F.col("rep").alias("_rep")).distinct()
        return _over_sets(docs.join(reps, F.col("doc_id") == F.col("_rep"), "left_semi"), work, schema)
    shared = docs.sparkSession.sparkContext.broadcast(_numbers(copies))
    return _over_sets(docs, work, schema, lambda keys, ids: ~np.isin(keys, shared.value))


def _of_ids(docs: DataFrame, ids: DataFrame, work, schema: str, local_ids: int) -> DataFrame:
    """``work`` over the sets of the documents with these ids (column ``doc``)."""
    if ids.count() > local_ids:
        return _over_sets(docs.join(ids, F.col("doc_id") == F.col("doc"), "left_semi"), work, schema)
    shared = docs.sparkSession.sparkContext.broadcast(_numbers(ids))
    return _over_sets(docs, work, schema, lambda keys, own: np.isin(own, shared.value))


# 2. Prefixes -----------------------------------------------------------------------------------------------------

_POSTING = "gram bigint, salt int, doc bigint, n int, pos int"


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many of the first n-grams two sets must share one of: n - ceil(n * PERCENT / 100) + 1."""
    return n - -(-n * PERCENT // 100) + 1


def _prefixes(frequent: np.ndarray, times: np.ndarray):
    """The prefix of each set in the common order, given the frequent n-grams (sorted) and their counts.

    ``salt`` is -1 for n-grams that need none.
    """
    def work(ids, of, grams, sizes):
        count = np.zeros(len(grams), np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
            count = np.where(frequent[at] == grams, times[at], 0)
        order = np.lexsort((grams, count, of))
        of, grams, count = of[order], grams[order], count[order]
        first = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
        pos = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
        head = pos < prefix_length(sizes)[of]
        of, grams, count, pos = of[head], grams[head], count[head], pos[head]
        doc = ids[of]
        salts = 1 + count // PER_SALT
        salt = (mix(doc.view(np.uint64)) >> np.uint64(33)).astype(np.int64) % salts
        salt = np.where(salts > 1, salt, -1)
        for lo in range(0, len(doc), 200_000):
            part = slice(lo, lo + 200_000)
            yield pa.record_batch(
                [pa.array(grams[part].view(np.int64)), pa.array(salt[part].astype(np.int32)), pa.array(doc[part]),
                 pa.array(sizes[of[part]].astype(np.int32)), pa.array(pos[part].astype(np.int32))],
                names=["gram", "salt", "doc", "n", "pos"])
    return work


def _groups(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by n-gram and salt, batched anew so that no list is split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        last = int(np.argmax((gram == gram[-1]) & (salt == salt[-1])))
        goes_on = bool(held) and held[0].column(0)[0].as_py() == int(gram[0]) and held[0].column(1)[0].as_py() == int(salt[0])
        if held and not (goes_on and last == 0):
            yield pa.concat_batches([*held, batch.slice(0, last)])
            held = []
        elif last:
            yield batch.slice(0, last)
        held.append(batch.slice(last))
    if held:
        yield pa.concat_batches(held)


_SHARED = f"{_POSTING}, lead bigint, lead_n int, lead_pos int, again boolean"


def _shared_only(batches):
    """Rows that can be paired with a row of another document and the same n-gram, with the list's first row as ``lead``.

    ``again``: whether it can be paired, at the first common n-gram, with such a row besides the lead, and is not the lead
    itself; another set of the lead's document is a row like others. Rows come sorted by n-gram, salt, document. Lists of more than ``SHORT_LIST`` rows stay whole. A
    salted n-gram keeps all its rows, as others of it may be elsewhere, and has no ``lead`` here.
    """
    for batch in _groups(batches):
        gram, salt, doc, n, pos = (batch.column(i).to_numpy().astype(np.int64) for i in range(5))
        starts = np.append(True, (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1]))
        of = np.cumsum(starts) - 1
        first = np.flatnonzero(starts)
        rows = np.diff(np.append(first, len(of)))
        keep = (salt >= 0) | (rows[of] > SHORT_LIST)
        behind = (doc != doc[first][of]) | (n != n[first][of]) | (pos != pos[first][of])
        again = (salt >= 0) | ((rows[of] > SHORT_LIST) & behind)
        for step in range(1, min(SHORT_LIST, int(rows.max()))):
            x = np.flatnonzero((of[step:] == of[:-step]) & (doc[step:] != doc[:-step]))
            y = x + step
            least, most = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
            left = np.minimum(n[x] - pos[x], n[y] - pos[y])
            for marked, before in ((keep, np.minimum(pos[x], pos[y])), (again, np.where(behind[x] & behind[y], 0, -left))):
                fits = (100 * least >= PERCENT * most) & ((100 + PERCENT) * (left + before) >= PERCENT * (least + most))
                marked[x[fits]] = True
                marked[y[fits]] = True
        if keep.any():
            lead = first[of[keep]]
            own = salt[keep] >= 0
            leads = [pa.array(v[lead].astype(kind), mask=own) for v, kind in ((doc, np.int64), (n, np.int32), (pos, np.int32))]
            kept = batch.filter(pa.array(keep))
            yield pa.record_batch([*kept.columns, *leads, pa.array(again[keep])], names=[f.split()[0] for f in _SHARED.split(", ")])


def _lists(docs: DataFrame, rows: DataFrame, frequent: DataFrame, local_ids: int) -> DataFrame:
    """gram, doc, n, pos of prefix n-grams that more than one document has, each with its list's smallest id: ``lead``.

    ``again``: whether it may have pairs besides that with ``lead``.
    """
    spark = docs.sparkSession
    known = frequent.toArrow()
    grams, times = (known.column(i).to_numpy().astype(np.int64) for i in (0, 1))
    order = np.argsort(grams.view(np.uint64))
    work = _prefixes(grams.view(np.uint64)[order], times[order])
    postings = _one_per_class(docs, rows, work, _POSTING, local_ids)
    path = f"{run_dir(spark, 'prefixes')}/shared.parquet"
    by_list = postings.repartition("gram", "salt").sortWithinPartitions("gram", "salt", "doc", "n", "pos")
    by_list.mapInArrow(_shared_only, _SHARED).write.parquet(path)
    shared = spark.read.parquet(path)
    salted = shared.where("salt >= 0").select("gram", "doc", "n", "pos")
    leads = salted.groupBy("gram").agg(
        F.min(F.struct(F.col("doc").alias("lead"), F.col("n").alias("lead_n"), F.col("pos").alias("lead_pos"))).alias("first"),
        F.max("doc").alias("last"),
    ).where("last != first.lead")
    salted = salted.join(leads.select("gram", "first.*"), "gram").withColumn("again", F.struct("doc", "n", "pos") != F.struct("lead", "lead_n", "lead_pos"))
    return shared.where("salt < 0").drop("salt").unionByName(salted)


# 3. and 4. Pairs -------------------------------------------------------------------------------------------------

def _enough(overlap: Column, n_a: Column, n_b: Column) -> Column:
    """Whether an overlap of two sets of these sizes gives the similarity."""
    return (100 + PERCENT) * overlap >= PERCENT * (n_a.cast("long") + n_b)


def _possible(n_a: str, pos_a: str, n_b: str, pos_b: str, before: bool) -> Column:
    """Length and positional filter at a common n-gram.

    At the first common n-gram of two sets nothing before it is common. With ``before`` all before it may be.
    """
    a, b, i, j = (F.col(x) for x in (n_a, n_b, pos_a, pos_b))
    left = F.least(a - i, b - j)
    most = left + F.least(i, j) if before else left
    return (100 * F.least(a, b).cast("long") >= PERCENT * F.greatest(a, b)) & _enough(most, a, b)


_SET = "doc bigint, n int, coarse array<int>, ranges array<tinyint>, grams array<bigint>"


def _set_rows(ids, of, grams, sizes):
    """One row per set: id, size, hashes per coarse and per narrow range, hashes.

    The narrow ones are null where a range holds more hashes than a byte can count.
    """
    texts, first = np.unique(of, return_index=True)
    ends = np.append(first[1:], len(of))
    place = np.repeat(np.arange(len(texts)), ends - first)

    def counts(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the sets in the counts, and the counts over 2^bits ranges of each set."""
        starts = np.concatenate([[0], np.cumsum(1 << bits)])
        at = (grams >> (64 - bits[place]).astype(np.uint64)).astype(np.int64)
        return starts, np.bincount(starts[place] + at, minlength=starts[-1])

    def lists(starts: np.ndarray, values: np.ndarray, none: np.ndarray | None = None) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values), mask=None if none is None else pa.array(none))

    coarse = counts(np.full(len(texts), COARSE.bit_length() - 1))
    starts, ranges = counts(range_bits(sizes[texts]))
    full = np.maximum.reduceat(ranges, starts[:-1]) > 127
    yield pa.record_batch([
        pa.array(ids[texts]), pa.array(sizes[texts].astype(np.int32)),
        lists(coarse[0], coarse[1].astype(np.int32)), lists(starts, np.minimum(ranges, 127).astype(np.int8), full),
        lists(np.append(first, len(of)), grams.view(np.int64)),
    ], names=["doc", "n", "coarse", "ranges", "grams"])


def range_bits(n: np.ndarray) -> np.ndarray:
    """The number of narrow ranges of sets of these sizes, as powers of 2. Sizes that differ by a third at most differ by 1."""
    return np.maximum(RANGES.bit_length() - 1, np.ceil(np.log2(np.maximum(n, 1) / FILL)).astype(np.int64))


def most_common(a: Column, b: Column) -> Column:
    """Bound of the overlap of two sets by their hashes per range; one may have twice as many ranges as the other."""
    def halved(wide: Column, narrow: Column) -> Column:
        part = lambda i: F.get(narrow, i).cast("int")
        return F.transform(wide, lambda x, i: F.least(x.cast("int"), part(2 * i) + part(2 * i + 1)))

    same = F.zip_with(a, b, lambda x, y: F.least(x, y).cast("int"))
    least = F.when(F.size(a) == F.size(b), same).when(F.size(a) < F.size(b), halved(a, b)).otherwise(halved(b, a))
    # Without counts there is no bound, and sum and result are null.
    return F.aggregate(F.when(a.isNotNull() & b.isNotNull(), least), F.lit(0), lambda s, x: s + x)


def _verified(docs: DataFrame, pairs: DataFrame, local_ids: int) -> DataFrame:
    """Pairs (a < b) with the least and greatest distance their sets can have; exact where the suffix filter lets them pass.

    ``linked``: whether the similarity is reached.
    """
    spark = docs.sparkSession
    folder = run_dir(spark, "pairs")
    pairs.write.parquet(f"{folder}/pairs.parquet")
    pairs = spark.read.parquet(f"{folder}/pairs.parquet")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    _of_ids(docs, ids, _set_rows, _SET, local_ids).write.parquet(f"{folder}/sets.parquet")
    sets = spark.read.parquet(f"{folder}/sets.parquet")

    def own(side: str, column: str) -> DataFrame:
        return sets.select(F.col("doc").alias(side), F.col("n").alias(f"n_{side}"), F.col(column).alias(f"{column}_{side}"))

    def with_sets(pairs: DataFrame, column: str) -> DataFrame:
        """An id can have several sets, so sets are joined by their sizes as well once these are known."""
        for side in ("b", "a"):
            pairs = pairs.join(own(side, column), [c for c in (side, f"n_{side}") if c in pairs.columns])
        return pairs

    def with_grams(pairs: DataFrame) -> DataFrame:
        """Hashes travel for documents of these pairs only; pairs too many to broadcast choose them by a shuffle."""
        few = pairs.count() <= BROADCAST_IDS
        a, b = ["a", "n_a"], ["b", "n_b"]
        leads = pairs.select(*a).distinct()
        if few:
            # The first hashes meet their pairs where they lie.
            pairs = own("b", "grams").join(F.broadcast(pairs), b)
        else:
            pairs = pairs.join(own("b", "grams").join(pairs.select(*b).distinct(), b, "left_semi"), b)
        return pairs.join(own("a", "grams").join(F.broadcast(leads) if few else leads, a, "left_semi"), a)

    # The suffix filter needs sizes and ranges alone, narrow ones only for pairs that the coarse ones let pass; hashes are
    # fetched for what is left.
    def bound(column: str) -> Column:
        return F.coalesce(most_common(F.col(f"{column}_a"), F.col(f"{column}_b")), F.least("n_a", "n_b")).alias("most")

    size = ["a", "b", "n_a", "n_b"]
    passed = _enough(F.col("most"), F.col("n_a"), F.col("n_b"))
    coarse = cut(with_sets(pairs, "coarse").select(*size, bound("coarse")))
    narrow = cut(with_sets(coarse.where(passed).select(*size), "ranges").select(*size, bound("ranges")))
    met = with_grams(narrow.where(passed)).withColumn("common", F.size(F.array_intersect("grams_a", "grams_b")))
    both = met.drop("grams_a", "grams_b")
    for bounded in (coarse, narrow):
        both = both.unionByName(bounded.where(~passed).withColumn("common", F.lit(None).cast("int")))
    total = F.col("n_a") + F.col("n_b")
    apart = lambda common: 1 - common / (total - common)
    found = cut(both.select(
        "a", "b", apart(F.coalesce("common", "most")).alias("least_apart"),
        F.when(F.col("common").isNull(), 1.0).otherwise(apart(F.col("common"))).alias("most_apart"),
        F.coalesce(_enough(F.col("common"), F.col("n_a"), F.col("n_b")), F.lit(False)).alias("linked"),
    ))
    delete(spark, folder)
    return found


def _first_pairs(lists: DataFrame) -> DataFrame:
    found = lists.where("doc != lead").where(_possible("lead_n", "lead_pos", "n", "pos", True))
    return found.select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct()


def _remaining_pairs(lists: DataFrame, verified: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of different components that share a prefix n-gram, pass all filters and are not ruled out or verified.

    Pairs with a list's lead that pass are verified, so neither leads nor what only they can be paired with are needed.
    """
    labelled = lists.where("again").drop("again").join(nodes, F.col("doc") == F.col("node"), "left").withColumn("root", F.coalesce("root", "doc")).drop("node")
    mixed = labelled.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    to_lead = verified.groupBy("a", "b").agg(F.min("least_apart").alias("least_apart"), F.max("most_apart").alias("most_apart"))
    placed = labelled.join(mixed.select("gram"), "gram").join(
        to_lead.toDF("lead", "doc", "least_apart", "most_apart"), ["lead", "doc"], "left")
    by_size = 1 - F.least("n", "lead_n") / F.greatest("n", "lead_n")
    placed = placed.select(
        "gram", "doc", "n", "pos", "root",
        F.coalesce("least_apart", by_size).alias("near"),
        F.coalesce("most_apart", F.lit(1.0)).alias("far"),
    )
    x, y = (placed.select(*[F.col(c).alias(f"{c}_{s}") if c != "gram" else F.col(c) for c in placed.columns]) for s in ("x", "y"))
    gap = F.greatest(F.col("near_x") - F.col("far_y"), F.col("near_y") - F.col("far_x"))
    found = x.join(y, "gram").where("doc_x < doc_y and root_x != root_y").where(_possible("n_x", "pos_x", "n_y", "pos_y", False))
    found = found.where(gap <= 1 - PERCENT / 100 + 1e-9).select(F.col("doc_x").alias("a"), F.col("doc_y").alias("b"), F.lit(False).alias("known"))
    # One grouping makes pairs distinct and drops those that are verified.
    pairs = found.unionByName(verified.select("a", "b", F.lit(True).alias("known"))).groupBy("a", "b").agg(F.max("known").alias("known"))
    return pairs.where(~F.col("known")).select("a", "b")


def classes(docs: DataFrame, local_ids: int = LOCAL_IDS) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs`` (doc_id, text)."""
    rows, frequent = _measure(docs)
    lists = _lists(docs, rows, frequent, local_ids)
    verified = _verified(docs, _first_pairs(lists), local_ids)
    # A document whose rows have several sets ties their classes together.
    sets = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b != last")
    ties = cut(rows.join(sets, "doc_id").where("rep != b").select(F.col("rep").alias("a"), "b").distinct())
    links = verified.where("linked").select("a", "b").unionByName(ties)
    nodes = roots(links)
    more = _verified(docs, _remaining_pairs(lists, verified, nodes), local_ids).where("linked").select("a", "b")
    if not more.isEmpty():
        nodes = roots(links.unionByName(more))
    whole = rows.join(nodes, F.col("rep") == F.col("node"), "left")
    return whole.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id"))


def keep_one(docs: DataFrame, local_ids: int = LOCAL_IDS) -> DataFrame:
    """The documents without those whose component has a smaller id; columns as they were, repeated rows once.

    Rows without an id stay, all of them. Of rows with the same id and text one stays, the first by their other columns
    as text. Texts are shuffled only where more ids go, or are repeated, than ``BROADCAST_IDS``.
    """
    found = cut(classes(docs, local_ids))
    few = lambda ids: F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    gone = few(found.where("component_id != doc_id").select(F.col("doc_id").alias("_gone")).distinct())
    left = docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    often = cut(found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_often")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_often"))
    if often.isEmpty():
        return left
    often = few(often)
    once = left.join(often, F.col("doc_id") == F.col("_often"), "left_anti")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    turn = W.partitionBy("doc_id", "text").orderBy(*[F.col(c).cast("string") for c in rest], "doc_id")
    repeated = left.join(often, F.col("doc_id") == F.col("_often"), "left_semi").withColumn("_turn", F.row_number().over(turn))
    return once.unionByName(repeated.where("_turn = 1").drop("_turn"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
