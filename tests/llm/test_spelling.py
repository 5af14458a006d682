"""Spelling variants against all pairs of words."""

import random
import re
import string
import zlib
from collections import Counter

import pytest

from climaflow.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n bigint, form string, tag int"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_counts(rows, slips, least_length, least_count):
    n = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slips == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(n):
    found = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(found[w]), n[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def texts(seed, letters, size, longest):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, longest))) for _ in range(size)]
    return [(k, " ".join(rng.choice(words[:1 + int(size * rng.random() ** 2)]) for _ in range(60))) for k in range(60)]


@pytest.mark.parametrize("seed,letters,size,longest", [(1, "ab", 200, 9), (2, "aéÿZ", 300, 7), (3, "abcdefgh", 400, 5), (4, "a", 40, 40)])
def test_words_forms_and_roots_equal_all_pairs(spark, seed, letters, size, longest):
    rows = texts(seed, letters, size, longest)
    df = spark.createDataFrame([(d, t, "w", 1, "f", 2) for d, t in rows], SCHEMA).repartition(4)
    for slips, length, count in ((3, 1, 1), (97, 5, 3)):
        want = plain(plain_counts(rows, slips, length, count))
        got = spelling.group_variants(df, slips, length, count).collect()
        assert len(got) == len(want)
        assert {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want


def test_chains_lead_to_the_last_form(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "lonely": 5, "ab": 50}
    df = spark.createDataFrame([(None, " ".join(w for w, n in words.items() for _ in range(n)))], "doc_id bigint, text string")
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.group_variants(df, slips=1 << 33).collect()}
    assert got["aaaaa"] == ("aaaab", "bbbbb") and got["abbbb"] == ("bbbbb", "bbbbb")
    assert got["bbbbb"] == (None, "bbbbb") and got["lonely"] == (None, "lonely") and "ab" not in got


def test_ties_go_to_the_smaller_word(spark):
    text = " ".join(["zzzzz"] * 3 + ["zzzzy"] * 6 + ["zzzza"] * 6 + ["zzzzé"] * 6)
    got = {r["word"]: r["form"] for r in spelling.group_variants(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), 1 << 33).collect()}
    assert got["zzzzz"] == "zzzza" and got["zzzzé"] is None


def test_rows_of_all_kinds(spark):
    long = "x" * 20_000
    rows = [(1, None), (2, ""), (None, "Hello hello HELLO"), (None, "Hello hello HELLO"), (3, "123 --- 日本"), (4, f"{long} {long} {long} {long}y {long}y {long}y"), (4, "hella " * 3)]
    df = spark.createDataFrame([(d, t, "w", 1, "f", 2) for d, t in rows], SCHEMA)
    assert rows_of(spelling.group_variants(df)) == plain(plain_counts(rows, 97, 5, 3))


def test_empty_tables(spark):
    for rows in ([], [(1, None, "w", 1, "f", 2)], [(1, "rare words only once", "w", 1, "f", 2)]):
        assert spelling.group_variants(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_trie_numbers_over_many_ranges(spark):
    """Equal prefixes have equal numbers, and different ones different numbers, wherever the words were cut into ranges."""
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 12))) for _ in range(600)})
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "37")
    spark.conf.set(keys[1], "false")
    try:
        got = spelling.number_trie(spark.createDataFrame([(w, k) for k, w in enumerate(words)], "word string, tag bigint")).collect()
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert [r["word"] for r in sorted(got, key=lambda r: r["place"])] == words
    number = {}
    for r in got:
        assert words[r["tag"]] == r["word"]
        for k, node in enumerate(r["nodes"]):
            assert number.setdefault(r["word"][:k + 1], node) == node
    assert len(set(number.values())) == len(number) and 0 not in number.values()
