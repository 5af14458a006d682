r"""Byte-pair encoding by an automaton over tokens, and decoding by emitting the labels of its arcs.

The automaton reads tokens and accepts a sequence exactly if it is the one that the merges produce for its bytes. It
starts as one state with an arc for every byte. Each merge ``a b -> c`` is put in by a gadget, in the order of the
merges: the state behind ``a`` is copied without its arc ``b``, all arcs ``a`` are turned to the copy, and from wherever
an arc ``a`` leaves, a new arc ``c`` leads to the state behind ``b``. All arcs with one label lead to one state, so a
state goes by the last token read.

Written out, the arcs would be the square of the vocabulary. A gadget is kept as its changes instead: the arc it closed
and when, and the halves of its token. A state's arcs are those of the state that it was copied from, as they stood
then; an arc ``c`` leaves where the arc ``a`` left when ``c`` was made; later gadgets close arcs one by one. Whether an
arc is open follows from these tables by walking down the halves of both tokens, and is then kept in a table of its own.
A merge whose two halves no state allows to meet has no gadget, and its token no arc.

A text is split into words by the tokenizer's rule. A word is read by taking at each position the longest token whose arc
is open, and the next shorter one where that leads nowhere; a position is left for good at most once, as only one
accepted sequence ends there, so the work is linear in the word's length. Words met before are looked up.

Texts stay where they are; tasks share the tables, whose size is that of the vocabulary. Merges, vocabulary and special
tokens are read from the tokenizer's file, whose path is a parameter; it must be a byte-level encoding without a
normalizer, a dropout or two merges with the same product, and anything else is refused. Strings of special tokens in a
text become these tokens.

Defined results: a null or empty text has no tokens; ids may be null or repeated, every row is encoded by itself; a long
text is encoded whole; ids that decode to broken UTF-8 give replacement characters, a null list or unknown ids are
refused by ``decode`` with an error; an empty table gives no rows. Other columns are left out of the result, whatever
their names.
"""

from __future__ import annotations

import itertools
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

TOKENIZER = "byte_bpe_50k.json"
# Words whose tokens a task keeps for later texts; beyond that it begins anew, and still looks into what it kept before.
KNOWN_WORDS = 300_000
# Arcs whose state a task keeps, likewise.
KNOWN_ARCS = 300_000
# Characters of text that are encoded before a batch is passed on; a longer text is passed on alone.
STEP_CHARS = 4 << 20

# White space and the split into words of byte-level encodings.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
        rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def byte_characters() -> dict[str, int]:
    """The byte that each character of a vocabulary stands for: printable bytes stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """Gadgets of all merges, and the tokens' labels.

    Symbols number bytes (0 to 255) and then merges in their order; ``ids`` gives the vocabulary's number of a symbol.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]], vocabulary: dict[bytes, int], special: dict[str, int]):
        self.labels: list[bytes] = [bytes([b]) for b in range(256)]
        self.left, self.right, self.born = [-1] * 256, [-1] * 256, [-1] * 256
        self.closed: dict[int, int] = {}
        self.width = 256 + len(merges)
        symbol = {x: k for k, x in enumerate(self.labels)}
        for rank, (a, b) in enumerate(merges):
            if a + b in symbol:
                raise ValueError(f"two merges make {a + b!r}")
            self._gadget(rank, symbol.get(a, -1), symbol.get(b, -1))
            symbol[a + b] = len(self.labels)
            self.labels.append(a + b)
        self.ids = [vocabulary.get(x, -1) for x in self.labels]
        self.special = dict(special)
        self.trie = self._trie()

    def _gadget(self, rank: int, a: int, b: int) -> None:
        met = a >= 0 and b >= 0 and self.born[a] > -2 and self.born[b] > -2 and self.is_open(a, b)
        self.left.append(a)
        self.right.append(b)
        self.born.append(rank if met else -2)
        if met:
            self.closed[a * self.width + b] = rank

    def is_open(self, state: int, token: int) -> bool:
        """Whether the arc ``token`` leaves the state behind the symbol ``state``."""
        born, closed, width = self.born, self.closed, self.width
        if state * width + token in closed:
            return False
        while True:
            row, column = born[state], born[token]
            if row < 0 and column < 0:
                return True
            if column >= row:
                # Made for all states that had an arc with its first half just then.
                token = self.left[token]
                if closed.get(state * width + token, column + 1) <= column:
                    return False
            else:
                # Copied from the state behind the second half, before the gadget closed anything.
                state = self.right[state]
                if closed.get(state * width + token, row) < row:
                    return False

    def _trie(self) -> dict[int, tuple[int, int]]:
        """By node and byte: the next node, and the symbol that ends there or -1. Symbols without arcs are left out."""
        nodes, at = {0: -1}, {}
        for s, label in enumerate(self.labels):
            if self.born[s] == -2:
                continue
            node = 0
            for x in label:
                node = at.setdefault(node << 8 | x, len(nodes))
                nodes.setdefault(node, -1)
            nodes[node] = s
        return {key: (node, nodes[node]) for key, node in at.items()}


class Encoder:
    """An automaton with the words and arcs that a task has met."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.words: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.before: dict[str, bytes] = {}
        self.arcs: dict[int, bool] = {}
        self.split = regex.compile(WORD).findall
        names = sorted(automaton.special, key=len, reverse=True)
        self.apart = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        size = max([*automaton.ids, *automaton.special.values()]) + 1
        labels = [b""] * size
        for s, k in enumerate(automaton.ids):
            if k >= 0:
                labels[k] = automaton.labels[s]
        for name, k in automaton.special.items():
            labels[k] = name.encode()
        self.label_at = np.concatenate([[0], np.cumsum([len(x) for x in labels])]).astype(np.int64)
        self.label_bytes = np.frombuffer(b"".join(labels), np.uint8)

    def symbols(self, word: bytes) -> list[int]:
        """The accepted sequence of symbols for ``word``."""
        automaton, trie, arcs = self.automaton, self.automaton.trie, self.arcs
        is_open, width, n = automaton.is_open, automaton.width, len(word)
        if len(arcs) > KNOWN_ARCS:
            arcs.clear()
        path: list[int] = []  # symbols so far
        waiting: list[list[tuple[int, int]]] = []  # for each position on the path: shorter tokens not tried yet
        left_for_good = set()
        at, last = 0, -1
        while at < n:
            found, node, k = [], 0, at
            while k < n and (step := trie.get(node << 8 | word[k])):
                node, k = step[0], k + 1
                if step[1] >= 0:
                    found.append((step[1], k))
            while True:
                while found:
                    symbol, end = found.pop()
                    if end in left_for_good:
                        continue
                    if last >= 0:
                        key = last * width + symbol
                        if (known := arcs.get(key)) is None:
                            known = arcs[key] = is_open(last, symbol)
                        if not known:
                            continue
                    break
                else:
                    # No way on from here: back to where the last token began.
                    left_for_good.add(at)
                    found = waiting.pop()
                    at -= len(automaton.labels[path.pop()])
                    last = path[-1] if path else -1
                    continue
                break
            waiting.append(found)
            path.append(symbol)
            at, last = end, symbol
        return path

    def word(self, word: str) -> bytes:
        if (out := self.before.get(word)) is None:
            ids = self.automaton.ids
            out = array("i", [ids[s] for s in self.symbols(word.encode())]).tobytes()
        if len(self.words) >= KNOWN_WORDS:
            self.words, self.before = {}, self.words
        self.words[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as 32-bit numbers."""
        word = self.word
        out = []
        for k, piece in enumerate(self.apart(text) if self.apart else [text]):
            if k % 2:
                out.append(array("i", [self.automaton.special[piece]]).tobytes())
            elif piece:
                known = self.words
                out.extend([known.get(w) or word(w) for w in self.split(piece)])
        return b"".join(out)

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        """Texts of the lists that ``edges`` cut ``ids`` into: labels one after another."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.label_at) - 1):
            raise ValueError("an id is not in the vocabulary")
        length = np.diff(self.label_at)[ids]
        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        source = np.repeat(self.label_at[ids] - ends[:-1], length) + np.arange(ends[-1])
        raw, cut = self.label_bytes[source].tobytes(), ends[edges]
        return [raw[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise(cut.tolist())]


def load(path: str) -> Automaton:
    """The automaton of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    model, before = said["model"], said["pre_tokenizer"]
    if model["type"] != "BPE" or before["type"] != "ByteLevel" or not before.get("use_regex", True) or before["add_prefix_space"]:
        raise ValueError(f"{path} is not a byte-level encoding with the usual split into words")
    if said["normalizer"] or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        raise ValueError(f"{path} changes texts or merges in ways that are not supported")
    added = said["added_tokens"]
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path} has special tokens that take in their surroundings")
    of = byte_characters()
    as_bytes = lambda x: bytes(map(of.__getitem__, x))
    special = {t["content"]: t["id"] for t in added}
    pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    vocabulary = {as_bytes(t): k for t, k in model["vocab"].items() if t not in special}
    return Automaton([(as_bytes(a), as_bytes(b)) for a, b in pairs], vocabulary, special)


# Of this process, by the broadcast's number: words and arcs outlive a task.
_encoders: dict[int, Encoder] = {}


def _encoder(key: int, automaton: Automaton) -> Encoder:
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(automaton)
    return _encoders[key]


def _steps(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows whose sizes sum up to about ``most``."""
    first, total = 0, 0
    for k, n in enumerate(sizes):
        if total and total + n > most:
            yield first, k
            first, total = k, 0
        total += n
    if sizes:
        yield first, len(sizes)


def _lists(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    lists = [encoder.encode(t) if t else b"" for t in texts.to_pylist()]
    edges = np.concatenate([[0], np.cumsum([len(x) // 4 for x in lists])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.frombuffer(b"".join(lists), np.int32)))


def _texts(encoder: Encoder, lists: pa.ListArray) -> pa.Array:
    edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return pa.array(encoder.decode(lists.flatten().to_numpy(), edges), pa.string())


def _in_tasks(rows: DataFrame, automaton: Automaton, sizes, result, schema: str) -> DataFrame:
    """``result(encoder, part)`` of stretches of the rows, whose sizes come from their second column."""
    shared = rows.sparkSession.sparkContext.broadcast(automaton)
    key = id(shared)
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches):
        encoder = _encoder(key, shared.value)
        for batch in batches:
            for first, end in _steps(pc.fill_null(sizes(batch.column(1)), 0).to_pylist(), STEP_CHARS):
                part = batch.slice(first, end - first)
                yield pa.record_batch([part.column(0), *result(encoder, part.column(1))], names=names)

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row of ``docs`` (doc_id, text)."""
    return _in_tasks(docs.select("doc_id", "text"), automaton, pc.utf8_length, lambda e, texts: [_lists(e, texts)],
                     "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, automaton: Automaton) -> DataFrame:
    """``encoded`` (doc_id, ids) with the ``text`` of the ids."""
    def result(encoder, lists):
        if lists.null_count:
            raise ValueError("a list of ids is null")
        return [lists, _texts(encoder, lists)]

    return _in_tasks(encoded.select("doc_id", "ids"), automaton, pc.list_value_length, result, "doc_id bigint, ids array<int>, text string")


def encode_and_decode(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """``decode`` of ``encode`` in one pass: a task needs one Python worker with its tables, not two."""
    def result(encoder, texts):
        lists = _lists(encoder, texts)
        return [lists, _texts(encoder, lists)]

    return _in_tasks(docs.select("doc_id", "text"), automaton, pc.utf8_length, result, "doc_id bigint, ids array<int>, text string")


def op11_bpe_automaton(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    automaton = load(tokenizer)
    rows = encode_and_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), automaton)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
