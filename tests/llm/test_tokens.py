"""Encoding by the merge automaton against plain merging and the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from climaflow.llm import bpe_automaton as bpe

PATH = public_tokenizers.path(bpe.TOKENIZER)
SCHEMA = "doc_id bigint, text string, ids string, edges int, symbol string"


@pytest.fixture(scope="module")
def automaton():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), np.int32).tolist()


def merged(word, merges):
    """Plain merging: the first rule that applies, leftmost place first."""
    parts = [bytes([b]) for b in word]
    while True:
        ranks = [merges.get((a, b), len(merges)) for a, b in zip(parts, parts[1:])]
        if not ranks or min(ranks) == len(merges):
            return parts
        k = ranks.index(min(ranks))
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9))
def test_accepted_sequence_is_that_of_plain_merging(seed):
    """Random merge tables over three bytes, with self merges, and merges that can never be used."""
    rng = random.Random(seed)
    known, merges = [b"a", b"b", b"c"], []
    for _ in range(rng.randrange(1, 14)):
        a, b = rng.choice(known), rng.choice(known)
        if a + b not in known:
            known.append(a + b)
            merges.append((a, b))
    automaton = bpe.Automaton(merges, {x: k for k, x in enumerate([bytes([i]) for i in range(256)] + [a + b for a, b in merges])}, {})
    encoder, rank = bpe.Encoder(automaton), {m: k for k, m in enumerate(merges)}
    for _ in range(30):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 16)))
        assert [automaton.labels[s] for s in encoder.symbols(word)] == merged(word, rank)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text_equals_the_library(automaton, library, text):
    encoder = bpe.Encoder(automaton)
    want = library.encode(text, add_special_tokens=False).ids
    assert ids(encoder, text) == want
    edges = np.array([0, len(want)])
    assert encoder.decode(np.array(want, np.int32), edges) == [library.decode(want, skip_special_tokens=False)]


def test_spaces_contractions_runs_and_special_strings(automaton, library):
    encoder = bpe.Encoder(automaton)
    rng = random.Random(2)
    pieces = ["it's", "'S", "''re", " 'll", "\n", "  ", "\t ", " ", " ", "\x1c", "\x85", "é", "ñandú", "日本", "🙂", "12", "٣", "²", "--", "...",
              "<|endoftext|>", "<|endof", "text|>", "a" * 300, " " * 50, "=" * 99]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_long_words_are_encoded_whole(automaton, library):
    encoder, rng = bpe.Encoder(automaton), random.Random(1)
    for text in ("a" * 50_000, "ab" * 30_000, "".join(rng.choice("etaoinshr") for _ in range(60_000))):
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_words_and_arcs_that_no_longer_fit_are_found_anew(automaton, monkeypatch):
    text = " ".join(f"word{k} the thing{k % 5}" for k in range(300))
    want = ids(bpe.Encoder(automaton), text)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    monkeypatch.setattr(bpe, "KNOWN_ARCS", 3)
    assert ids(bpe.Encoder(automaton), text) == want


def test_rows_of_all_kinds(spark, automaton, library):
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
    texts = [None, "", " ", "one two", "one two", long, "x<|endoftext|>y", "\n\n\n"]
    rows = [(k if k != 3 else None, t, "i", 1, "s") for k, t in enumerate(texts)] + [(4, "again", "i", 1, "s")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["ids"])
    got = sorted(bpe.encode(df, automaton).collect(), key=key)
    want = sorted(((d, library.encode(t or "", add_special_tokens=False).ids) for d, t, *_ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(r["doc_id"], r["ids"]) for r in got] == want
    back = sorted(bpe.decode(bpe.encode(df, automaton), automaton).collect(), key=key)
    both = sorted(bpe.encode_and_decode(df, automaton).collect(), key=key)
    assert back == both and [r["text"] for r in back] == [library.decode(i, skip_special_tokens=False) for _, i in want]


def test_empty_table_and_bad_ids(spark, automaton):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.encode_and_decode(empty, automaton).collect() == []
    for bad in ([50257], [-1], None):
        with pytest.raises(Exception, match="vocabulary|null"):
            bpe.decode(spark.createDataFrame([(1, bad)], "doc_id bigint, ids array<int>"), automaton).collect()
    # Half a character.
    half = spark.createDataFrame([(1, [bpe.Encoder(automaton).automaton.ids[0xC3]])], "doc_id bigint, ids array<int>")
    assert bpe.decode(half, automaton).first()["text"] == "�"


def test_other_tokenizers_are_refused(tmp_path):
    said = json.load(open(PATH, encoding="utf-8"))
    said["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "a.json").write_text(json.dumps(said))
    with pytest.raises(ValueError):
        bpe.load(str(tmp_path / "a.json"))
    with pytest.raises(ValueError):
        bpe.Automaton([(b"a", b"b"), (b"ab", b"c"), (b"b", b"c"), (b"a", b"bc")], {}, {})


def test_query_equals_the_library(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for d, t in docs:
        i = library.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(i), sha(",".join(map(str, i))), sha(library.decode(i, skip_special_tokens=False)))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op11_bpe_automaton(spark, small).collect()}
    assert got == want
