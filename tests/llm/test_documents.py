"""Operators over documents: edge rows, and plain versions of the same results."""

import collections
import math
import os
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from climaflow.llm import decontaminate, jaccard_join, lm_score, mixing, quality_model, quality_rules, sharding, words  # noqa: E402
from climaflow.llm.components import roots  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, kept string, n bigint, rep bigint"
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, n=120):
    rng = np.random.default_rng(seed)
    return " ".join(f"word{k}" for k in rng.integers(0, 400, n))


def edge_rows():
    texts = [None, "", " \t\n", "a", "A b", "a B", "one two three four five", LONG, "x " * 200, "### *** $$$ " * 60]
    base = prose(1).split()
    texts += [" ".join(base), " ".join(base).upper(), " ".join(base[:-1]), " ".join(base[:60] + ["new"] + base[61:])]
    texts += [prose(k) for k in range(2, 60)] + ["line with words\n" * 30, "é" * 50 + " ü", "tab\tand\x0bfeed\x0c\r\nend"]
    rows = [(i, t, None if i % 9 == 0 else "en", None if i % 11 == 0 else f"s{i % 2}") for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, "no id here", "en", "s0"), (None, prose(1), "en", "s0")]
    return [(*r, 0, 1, "k", 2, 3) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = WORD.findall(folded(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


# Words -----------------------------------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbB \t\n\x0b\x0c\ré\u2003.", max_size=60)), max_size=12))
def test_word_hashes_are_those_of_the_words(texts):
    seen = {}
    for c in words.chunks(pa.array(texts, pa.string()), words.white_space_words()):
        of, _ = words.shingle_sets(c, 5)
        for i in range(c.last - c.first):
            plain = WORD.findall(folded(texts[c.first + i]))
            got = c.words[c.starts[i]:c.starts[i + 1]].tolist()
            assert len(got) == len(plain)
            for w, h in zip(plain, got):
                assert seen.setdefault(w, h) == h
            assert (of == i).sum() == len(shingles(texts[c.first + i]))
    assert len(set(seen.values())) == len(seen)


# 3: quality rules ------------------------------------------------------------------------------------------------

def base_of(text):
    text = text or ""
    w = WORD.findall(text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_base_statistics_equal_plain_counts(docs):
    got = quality_rules.measured(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    want = collections.Counter((r[0], *base_of(r[1])) for r in edge_rows())
    assert collections.Counter(tuple(r) for r in got) == want


def test_chi_square_constants():
    assert math.isclose(quality_rules.chi_square_below(11.0705, 5), 0.95, abs_tol=1e-5)
    assert math.isclose(quality_rules.chi_square_limit(0.5, 2), 2 * math.log(2), rel_tol=1e-9)


def test_rules_reject_planted_outliers_and_keep_the_rest(spark, docs):
    clean = [(i, prose(i, 80 + i % 300), "en", f"s{i % 2}", 0) for i in range(240)]
    junk = [(1000 + i, " ".join(w + "***" for w in prose(i).split()), "en", "s0", 0) for i in range(12)]
    rows = spark.createDataFrame(clean + junk, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = quality_rules.keep(rows, steps=3)
    assert kept.columns == rows.columns
    assert {r.doc_id for r in kept.collect()} == set(range(240))


# 5: sharding -----------------------------------------------------------------------------------------------------

def test_shards_are_equal_gapless_and_match_the_mixture(docs, empty):
    rows = sharding.assign(docs, shards=4).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r[0] for r in edge_rows())
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        text = dict((x[0], x[1]) for x in edge_rows() if x[0] is not None).get(r.doc_id)
        if r.doc_id is not None:
            data = (text or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    for s in {r.source for r in rows}:
        shares = [sum(r.source == s for r in part) for part in by.values()]
        assert max(shares) - min(shares) <= 2
    assert sharding.assign(empty).count() == 0


# 6: near copies --------------------------------------------------------------------------------------------------

def plain_components(rows):
    sets = collections.defaultdict(list)
    for r in rows:
        if r[0] is not None:
            sets[r[0]].append(shingles(r[1]))
    ids, root = sorted(sets), {}
    for i in ids:
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and any(linked(x, y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("local_ids", [4_000_000, 0])
def test_components_equal_all_pairs(docs, local_ids, monkeypatch):
    if not local_ids:
        monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    got = jaccard_join.classes(docs, local_ids).collect()
    want = plain_components(edge_rows())
    assert len(got) == len(edge_rows())
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    lengths = {r[0]: len(shingles(r[1])) for r in edge_rows() if r[0] is not None}
    assert all(r.n_shingles == lengths[r.doc_id] for r in got if r.doc_id is not None)


def test_chains_of_near_copies_and_pairs_beside_the_first(spark):
    """Copies that drift step by step are linked to their neighbours only."""
    rows, now = [], prose(7, 100).split()
    for i in range(60):
        rows.append((i * 3 % 61, " ".join(now)))
        now = now[2:] + [f"step{i}", f"more{i}"]
    rows += [(100 + i, prose(200 + i)) for i in range(20)]
    got = {r.doc_id: r.component_id for r in jaccard_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == plain_components(rows)


def test_one_of_each_group_stays(docs, empty):
    left = jaccard_join.keep_one(docs)
    assert left.columns == docs.columns
    want = {i for i, c in plain_components(edge_rows()).items() if i == c}
    ids = [r.doc_id for r in left.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(want)
    assert jaccard_join.classes(empty).count() == 0


def test_an_id_with_several_texts_ties_their_classes(spark):
    a, b, c = prose(301), prose(302), prose(303)
    rows = [(3, a), (7, a), (7, b), (9, b), (11, c), (12, c), (12, None), (None, b), (None, "x y z"), (20, None)]
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == {(3, 3), (7, 3), (9, 3), (11, 11), (12, 11), (20, 20)}


def test_repeated_rows_go_and_rows_without_an_id_stay(spark):
    rows = [(None, "same", "a"), (None, "same", "b"), (5, "x", "b"), (5, "x", "a"), (5, "x", None), (5, None, "n"), (5, None, "n"), (6, "y", "q")]
    left = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(None, "same", "a"), (None, "same", "b"), (5, "x", None), (5, None, "n"), (6, "y", "q")], key=str)


def test_ranges_bound_the_overlap_of_sets_of_any_size(spark):
    """Unlike sets are ruled out however large they are, without their hashes."""
    rng = np.random.default_rng(6)
    top = 2**64 - 1
    base = rng.integers(0, top, 9_000, np.uint64, True)
    fresh = lambda n: rng.integers(0, top, n, np.uint64, True)
    sets = [base, base[:7_000], np.append(base[:1_000], fresh(7_000)), base[:8_100], base[:40], fresh(50), base[:1_024], base[:1_025], np.arange(200, dtype=np.uint64)]
    sizes = np.array([len(x) for x in sets])
    batch, = jaccard_join._set_rows(np.arange(len(sets)), np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), sizes)
    rows = spark.createDataFrame(batch.to_pylist(), jaccard_join._SET)
    x, y = (rows.select(*[F.col(c).alias(f"{c}_{s}") for c in ("doc", "n", "ranges")]) for s in "xy")
    alike = F.least("n_x", "n_y") * 4 >= F.greatest("n_x", "n_y") * 3
    got = {(r.doc_x, r.doc_y): r.most for r in x.join(y, (F.col("doc_x") != F.col("doc_y")) & alike)
           .select("doc_x", "doc_y", jaccard_join.most_common(F.col("ranges_x"), F.col("ranges_y")).alias("most")).collect()}
    assert {(0, 1), (0, 2), (1, 3), (4, 5), (6, 7)} <= set(got)
    for (i, j), most in got.items():
        assert len(np.intersect1d(sets[i], sets[j])) <= most <= min(sizes[i], sizes[j])
    assert all(175 * got[i, 2] < 75 * (sizes[i] + sizes[2]) for i in (0, 1, 3))
    # More hashes in one range than a byte can count.
    assert batch.column(3).null_count == 1 and not batch.column(3)[8].is_valid


def test_long_unlike_texts_are_ruled_out_before_their_hashes_meet(spark):
    """Long texts have hashes in every range, so a fixed number of ranges lets them all pass."""
    shared, near = prose(401, 200), prose(402, 6_000)
    rows = [(1, f"{shared} {prose(403, 6_000)}"), (2, f"{shared} {prose(404, 6_000)}"), (3, near), (4, f"{near} {prose(405, 900)}")]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (3, 4)], "a bigint, b bigint")
    got = {(r.a, r.b): r for r in jaccard_join._verified(texts, pairs, 100).collect()}
    assert {k: r.linked for k, r in got.items()} == {(1, 2): False, (1, 3): False, (3, 4): True}
    assert linked(shingles(rows[2][1]), shingles(rows[3][1])) and shingles(rows[0][1]) & shingles(rows[1][1])
    # Nothing exact is known of the pair that shares a passage, as its hashes were not fetched.
    assert got[1, 2].most_apart == 1.0 and 0.25 < got[1, 2].least_apart < 1


@pytest.mark.parametrize("rows_a_batch", [1, 3, 7, 1_000])
def test_lists_keep_every_row_with_a_possible_partner(rows_a_batch):
    rng = np.random.default_rng(rows_a_batch)
    rows = []
    for gram, size in enumerate([1, 2, 2, 2, 3, 5, 9, 16, 17, 40, 2, 2, 1]):
        salt = 0 if gram in (5, 12) else -1
        for _ in range(size):
            n = int(rng.integers(20, 60))
            rows.append((gram, salt, int(rng.integers(0, 12)), n, int(rng.integers(0, n // 4 + 1))))
    rows.sort()
    names = ["gram", "salt", "doc", "n", "pos"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
    batches = [pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[i:i + rows_a_batch]), kinds)], names=names) for i in range(0, len(rows), rows_a_batch)]
    got = [tuple(r.values()) for b in jaccard_join._shared_only(iter(batches)) for r in b.to_pylist()]

    def fits(x, y, before=True):
        (a, i), (b, j) = x[3:], y[3:]
        return x[2] != y[2] and 4 * min(a, b) >= 3 * max(a, b) and 175 * (min(a - i, b - j) + before * min(i, j)) >= 75 * (a + b)

    want = []
    for x in rows:
        same = [y for y in rows if y[:2] == x[:2]]
        if x[1] >= 0:
            want.append((*x, None, None, None, True))
        elif len(same) > jaccard_join.SHORT_LIST or any(fits(x, y) for y in same):
            others = [y for y in same if y != same[0]]
            again = x in others and (len(same) > jaccard_join.SHORT_LIST or any(fits(x, y, False) for y in others))
            want.append((*x, *same[0][2:], again))
    assert got == want and len(want) < len(rows) and not all(r[-1] for r in got)


def test_sets_of_one_id_are_not_mixed(spark):
    """The size of one text of an id does not go with the hashes of another."""
    long = [f"w{i}" for i in range(104)]
    rows = []
    for k in range(20):
        rows += [(2 * k, " ".join(f"{w}k{k}" for w in long)),
                 (2 * k + 1, " ".join([f"{w}k{k}" for w in long[:81]] + [f"new{i}k{k}" for i in range(3)])),
                 (2 * k + 1, " ".join([f"{w}k{k}" for w in long[:82]] + [f"other{i}k{k}" for i in range(22)]))]
    got = {r.doc_id: r.component_id for r in jaccard_join.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == plain_components(rows) == {i: i for i in got}


def test_roots_of_stars_chains_and_nothing(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(5, 5)]
    got = {r.node: r.root for r in roots(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{i: 100 for i in range(101, 120)}}
    assert roots(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 2: decontamination ----------------------------------------------------------------------------------------------

def test_overlaps_with_replaced_words(spark, docs, empty):
    item = [f"bench{i}" for i in range(30)]
    changed = [w if i % 5 else f"other{i}" for i, w in enumerate(item)]
    rows = [
        (1, f"{prose(90)} {' '.join(item)} {prose(91)}"), (2, f"{prose(92)}! {', '.join(changed).upper()}. {prose(93)}"),
        (3, prose(94)), (4, None), (5, ""), (6, " ".join(item[:9])), (7, " ".join(item[3:15])), (1, prose(95)),
    ]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, " ".join(item)), (8, None), (7, "too short"), (6, "")], "item_id bigint, text string")
    for block in (1_000_000, 5):
        got = decontaminate.find_overlaps(texts, bench, block).collect()
        assert sorted((r.doc_id, r.item_id, r.n_matched) for r in got) == [(1, 9, 30), (2, 9, 24), (7, 9, 12)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(texts, bench).collect()) == [1, 3, 4, 5, 6]
    assert decontaminate.find_overlaps(empty, bench).count() == 0
    assert decontaminate.find_overlaps(docs, bench.where("item_id < 0")).count() == 0
    assert decontaminate.drop_contaminated(docs, bench).count() == docs.count()


def test_any_accepted_stretch_counts():
    rng = np.random.default_rng(8)
    for size, replaced in [(15, 2), (15, 3), (15, 4), (20, 4), (20, 5), (30, 8)] * 50:
        item = [f"item{k}" for k in range(size)]
        equal = np.ones(size, bool)
        equal[rng.choice(size, replaced, False)] = False
        text = [w if e else f"other{k}" for k, (w, e) in enumerate(zip(item, equal))]
        seeds = decontaminate.Seeds.of([1], [" ".join(item)])
        chunk, = words.chunks(pa.array([" ".join(["before"] * 5 + text + ["after"] * 5)]), words.letter_words())
        got = list(decontaminate.overlaps(chunk.words, chunk.starts, seeds))
        # Where the masks find it; the whole item passes both limits.
        assert bool(got) == bool(len(seeds.hits(chunk.words)[0]))
        for _, _, doc_start, item_start, n, matched in got:
            assert doc_start == item_start + 5 and matched == equal[item_start:item_start + n].sum()
            assert matched >= 10 and 10 * matched >= 7 * n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=40))
def test_longest_accepted_stretch_is_that_of_all_stretches(equal):
    equal = np.array(equal, bool)
    fits = [(-int(equal[a:b].sum()), b - a, a) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1)
            if equal[a:b].sum() >= 10 and 10 * equal[a:b].sum() >= 7 * (b - a) and equal[a] and equal[b - 1]]
    want = min(fits, default=None)
    assert decontaminate.longest_accepted(equal, 50) == (want and (want[2], want[1], -want[0]))


# 1: mixing -------------------------------------------------------------------------------------------------------

def test_raking_equals_plain_raking_and_meets_the_targets(spark):
    rng = np.random.default_rng(3)
    mass = rng.integers(50, 400, (3, 2, 2)).astype(float)
    rows = [(f"s{i}", None if j else "en", f"t{k}", int(mass[i, j, k])) for i in range(3) for j in range(2) for k in range(2)]
    targets = {"source": mixing.Target({"s0": 2.0}), "lang": mixing.Target({"en": 3.0}), "topic": mixing.Target()}
    cells, n = mixing.probabilities(spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens bigint"), targets, 0.2)
    w, shares = mass / mass.sum(), [np.array([.5, .25, .25]), np.array([.75, .25]), np.array([.5, .5])]
    for _ in range(40):
        for axis, t in enumerate(shares):
            now = w.sum(tuple(a for a in range(3) if a != axis))
            w = w * (t / now).reshape([-1 if a == axis else 1 for a in range(3)])
    got = {(r.source, r.lang, r.topic): r for r in cells.collect()}
    assert n == 12
    for i in range(3):
        for j in range(2):
            for k in range(2):
                r = got[f"s{i}", None if j else "en", f"t{k}"]
                assert math.isclose(r.weight, w[i, j, k], rel_tol=1e-6)
                assert math.isclose(r.probability, min(1, 0.2 * mass.sum() * w[i, j, k] / mass[i, j, k]), rel_tol=1e-6)


def test_raking_goes_on_while_it_improves_and_says_what_is_missed(spark, recwarn):
    schema, dims = "source string, lang string, n_tokens bigint", ("source", "lang")
    targets = {"source": mixing.Target(), "lang": mixing.Target({"en": 4.0})}
    # One empty cell, and shares that leave little room beside it: 40 sweeps leave a deviation.
    slow = spark.createDataFrame([("s0", "en", 100), ("s1", "en", 100), ("s1", "de", 100)], schema)
    raked = mixing.rake(mixing._cells(slow, {**targets, "lang": mixing.Target({"en": 1.4})}, dims), dims)
    assert max(mixing.deviations(raked, dims).values()) < 1e-8 and not [w for w in recwarn if w.category is RuntimeWarning]
    # Each source is in one language only: the shares of both dimensions cannot be met at once.
    apart = spark.createDataFrame([("s0", "en", 100), ("s1", "de", 100)], schema)
    with pytest.warns(RuntimeWarning, match="source 0.6, lang"):
        raked = mixing.rake(mixing._cells(apart, targets, dims), dims)
    assert mixing.deviations(raked, dims)["source"] == pytest.approx(0.6)


def test_sample_keeps_columns_and_survives_edges(docs, empty):
    drawn = mixing.sample(docs, budget_share=1.0)
    assert drawn.columns == docs.columns and drawn.count() == docs.count()
    assert mixing.sample(empty).count() == 0


# 7: language model -----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("table_words", [4_000_000, 3])
def test_base_scores_equal_plain_counts(docs, table_words):
    tokens = lambda t: [*WORD.findall(folded(t)), None]
    counts = collections.Counter()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    for r in edge_rows():
        if not held(r[0]):
            counts.update(tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (-1 if r[0] is None else r[0], held(r[0]), len(tokens(r[1])), sum(counts[w] > 0 for w in tokens(r[1])), n,
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(r[1])), 6)) for r in edge_rows())
    got = lm_score.score(docs, table_words=table_words).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_filter_levels_are_never_low_and_rarely_high():
    rng = np.random.default_rng(5)
    grams = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    level = rng.integers(1, 6, len(grams))
    keys = lm_score._sized(grams, 2)
    table = np.zeros((1, (1 << lm_score.SEGMENT_BITS) // 8), np.uint8)
    bits = np.zeros(1 << lm_score.SEGMENT_BITS, bool)
    for at in range(1, 6):
        for probe in range(lm_score.PROBES):
            bits[lm_score._bits(keys[level >= at], at, probe).astype(np.int64)] = True
    table[0] = np.packbits(bits, bitorder="little")
    found = lm_score.LogFrequencyFilter(table, 2).level(grams, 2)
    assert (found >= level).all() and (found > level).mean() < 0.05


def test_filter_larger_than_a_broadcast_holds_all_and_scores_the_same(docs):
    options = dict(part_bytes=20_000, table_words=3)
    whole, joined = (sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm_score.score(docs, max_bytes=m, **options).collect())
                     for m in (64 << 20, 0))
    assert joined == whole


def test_pairs_seen_once_count(spark):
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    learnt, asked = [i for i in range(400) if not held(i)][:200], [i for i in range(1000, 1100) if held(i)][:2]
    texts = [prose(i, 12) for i in range(200)]
    seen = texts[7].split()
    apart = [w for k in range(6) for w in (seen[k], seen[11 - k])]
    rows = [*zip(learnt, texts), (asked[0], " ".join(seen)), (asked[1], " ".join(apart))]
    got = {r.doc_id: r for r in lm_score.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    pairs = collections.Counter(p for t in texts for p in zip(t.split(), t.split()[1:]))
    assert sum(pairs[p] == 1 for p in zip(seen, seen[1:])) >= 8 and not any(pairs[p] for p in zip(apart, apart[1:]) if p not in zip(seen, seen[1:]))
    # Same words, so the word probabilities are alike; only the pairs, each seen once, tell the two apart.
    assert got[asked[0]].base_score == pytest.approx(got[asked[1]].base_score)
    assert got[asked[0]].score > got[asked[1]].score + 1


# 4: classifier ---------------------------------------------------------------------------------------------------

def test_filter_keys_travel_short_and_not_through_the_driver(spark, monkeypatch):
    keys = lm_score._sized(np.arange(100_000, dtype=np.uint64), 2)
    assert not (keys & np.uint64(0xFFFF)).any() and len(np.unique(keys)) == len(keys)
    assert len(pa.compress(lm_score._packed_sorted(np.sort(keys)), codec="lz4", asbytes=True)) < 5.2 * len(keys)

    def collected(*_):
        raise AssertionError("the filter was collected")

    monkeypatch.setattr(lm_score, "whole_filter", collected)
    rows = [(k, f"words of text {k % 3} and more of them") for k in range(20)]
    assert lm_score.score(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == 20


def test_trees_learn_and_flat_traversal_equals_single_steps():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > 0)).astype(float)
    trees = quality_model.grow(x[:2000], y[:2000], trees=30)
    assert ((trees.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    one = x[2500]
    total = trees.base
    for feature, limit, value in zip(trees.feature, trees.limit, trees.value):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if one[feature[node]] > limit[node] else 1)
        total += value[node - len(feature)]
    assert math.isclose(total, trees.margins(x[2500:2501])[0], rel_tol=1e-9)


def test_scores_cover_every_row_and_tell_junk(spark, docs, empty):
    good = [(i, prose(i), 1) for i in range(300)]
    bad = [(500 + i, " ".join(w + "***" for w in prose(i).split()), 0) for i in range(150)]
    rows = spark.createDataFrame(good + bad, "doc_id bigint, text string, quality int")
    labels = rows.select("doc_id", "quality")
    got = quality_model.score(rows.select("doc_id", "text"), labels).join(labels, "doc_id").collect()
    assert len(got) == 450
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.predicted == r.quality for r in got if r.held_out]) > 0.95
    whole = quality_model.score(docs, labels).collect()
    assert len(whole) == len(edge_rows()) and all(0 <= r.score <= 1 for r in whole)
    none = quality_model.score(docs, spark.createDataFrame([], "doc_id bigint, quality int")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_model.score(empty, labels).count() == 0
