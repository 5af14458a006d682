"""Benchmark decontamination by spaced-seed hashing.

Fixed masks choose word positions and skip others. Every window of a benchmark item and of a document is hashed over
the chosen positions only, so a window still matches when the skipped words were replaced. Equal hashes join a place of
a document to a place of an item. Around each hit the two texts are laid side by side and compared word by word: the hit
counts when any stretch holds enough equal words at a high enough share. Reported is the stretch of highest score, with
replaced words as a cost, or where that one is too short or too poor, the one with the most equal words that counts.

Texts are compared as words of ASCII letters, digits and characters beyond ASCII, lower-cased; all else separates.

The item hashes are the small side of the join. They are handled in blocks of at most ``BLOCK_WORDS`` item words, whose
size is counted first; each block is broadcast and documents are read once per block. Documents are never shuffled, a
passage shared by a third of them is found where they lie, and a lost task is simply run again.

Defined results: null and empty texts match nothing; items of fewer than ``MIN_ITEM_WORDS`` words are too short to be
told from chance and are skipped; an item shorter than ``MIN_MATCHED`` words must be found whole; a benchmark item that
occurs twice is two items; repeated documents each give their rows; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .words import chunks, letter_words, mix

# 1: compared, 0: ignored. Each compares six words; together they meet one replaced word in three, four, five or six,
# and most random patterns of one in four.
MASKS = ("111111", "1111011", "1110111", "11011011", "1011011001", "1101100101")
MIN_ITEM_WORDS = 6
MIN_MATCHED = 10
MIN_IDENTITY = 0.7
# A replaced word costs as much as this many equal ones.
REPLACED_COST = 2
# Words of benchmark items that are broadcast at once: six hashes of 8 bytes each and their places.
BLOCK_WORDS = 1_000_000

_TABLE_BITS = 20

HIT_SCHEMA = "doc_id bigint, item_id bigint, doc_start bigint, item_start bigint, n_words bigint, n_matched bigint, identity double"


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def _windows(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """Hash of the chosen words of every window."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, (number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for k in (i for i, c in enumerate(mask) if c == "1"):
        out += words[k:k + n] * np.uint64(pow(0x2545F4914F6CDD1D, k + 1, 1 << 64))
    return mix(out)


@dataclass
class Seeds:
    """Hashed windows of a block of items, sorted, with the item and place of each."""

    ids: list
    items: list[np.ndarray]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list, masks=MASKS) -> Seeds:
        items = [np.zeros(0, np.uint64)] * len(ids)
        for c in chunks(_lower(pa.array(texts, pa.large_string())), letter_words()):
            for i in range(c.first, c.last):
                items[i] = c.words[c.starts[i - c.first]:c.starts[i - c.first + 1]]
        parts = []
        for i, words in enumerate(items):
            if len(words) < MIN_ITEM_WORDS:
                continue
            for number, mask in enumerate(masks):
                found = _windows(words, mask, number)
                parts.append((found, np.full(len(found), i), np.arange(len(found))))
        hashes, item, place = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.uint64 if not k else np.int64) for k in range(3))
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[hashes >> np.uint64(64 - _TABLE_BITS)] = True
        return cls(ids, items, hashes, item[order], place[order], table)

    def hits(self, words: np.ndarray, masks=MASKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``words``, item, place in the item) of every equal hash."""
        at, item, place = [], [], []
        for number, mask in enumerate(masks):
            found = _windows(words, mask, number)
            likely = np.flatnonzero(self.table[found >> np.uint64(64 - _TABLE_BITS)])
            lo = np.searchsorted(self.hashes, found[likely], "left")
            hi = np.searchsorted(self.hashes, found[likely], "right")
            n = hi - lo
            real = n > 0
            likely, lo, n = likely[real], lo[real], n[real]
            seed = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else lo, n) + np.arange(n.sum())
            at.append(np.repeat(likely, n))
            item.append(self.item[seed])
            place.append(self.place[seed])
        return np.concatenate(at), np.concatenate(item), np.concatenate(place)


def best_stretch(equal: np.ndarray, cost: int = REPLACED_COST) -> tuple[int, int, int]:
    """Start, length and equal words of the stretch with the highest score; it begins and ends with an equal word."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -cost))])
    lowest = np.minimum.accumulate(total[:-1])
    end = int(np.argmax(total[1:] - lowest)) + 1
    start = int(np.flatnonzero(total[:end] == lowest[end - 1])[-1])
    return start, end - start, int(equal[start:end].sum())


def accepted(n_matched: int, n_words: int, item_words: int) -> bool:
    return n_matched >= min(MIN_MATCHED, item_words) and n_matched >= MIN_IDENTITY * n_words


def longest_accepted(equal: np.ndarray, item_words: int) -> tuple[int, int, int] | None:
    """Start, length and equal words of the accepted stretch with the most equal words, of these the shortest and first;
    it begins and ends with an equal word. None if there is none."""
    at = np.flatnonzero(equal)
    if len(at) < min(MIN_MATCHED, item_words):
        return None
    # A stretch from equal word a to b has b - a + 1 of them in at[b] - at[a] + 1 words. In tenths, without rounding, it
    # is accepted where gain[a] is at most gain[b] and 10 - tenths; the first such a makes it longest for its b.
    tenths = round(10 * MIN_IDENTITY)
    gain = 10 * np.arange(len(at)) - tenths * at
    a = np.searchsorted(-np.minimum.accumulate(gain), -(gain + 10 - tenths))
    n = np.arange(len(at)) - a + 1
    lengths = at - at[a] + 1
    b = int(np.lexsort((lengths, -n))[0])
    return (int(at[a[b]]), int(lengths[b]), int(n[b])) if n[b] >= min(MIN_MATCHED, item_words) else None


def overlaps(words: np.ndarray, starts: np.ndarray, seeds: Seeds) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text, item, start in the text, start in the item, words, equal words): the best stretch of every text and item."""
    at, item, place = seeds.hits(words)
    if not len(at):
        return
    text = np.searchsorted(starts, at, "right") - 1
    # Windows must not run over the end of a text; the words of one chunk lie one text after another.
    lines = np.unique(np.stack([text, item, at - place]), axis=1)
    best: dict[tuple[int, int], tuple] = {}
    for t, i, shift in lines.T.tolist():
        doc_first, doc_end, other = int(starts[t]), int(starts[t + 1]), seeds.items[i]
        low, high = max(doc_first, shift), min(doc_end, shift + len(other))
        if high - low < min(MIN_MATCHED, len(other)):
            continue
        equal = words[low:high] == other[low - shift:high - shift]
        found = best_stretch(equal)
        if not accepted(found[2], found[1], len(other)):
            found = longest_accepted(equal, len(other))
        if found:
            start, n, matched = found
            row = (matched, -n, -(low + start), low + start - doc_first, low + start - shift, n)
            if row > best.get((t, i), (-1,)):
                best[t, i] = row
    for (t, i), (matched, _, _, doc_start, item_start, n) in sorted(best.items()):
        yield t, i, doc_start, item_start, n, matched


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of the items, some at a time, by a counted size."""
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    # A word and its separator take two characters at least.
    parts = max(1, -(-size // (2 * block_words)))
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield [r["item_id"] for r in rows], [r["text"] for r in rows]


def find_overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Verified overlaps, one row per document row and item: places in words, length, equal words, identity."""
    spark, result = docs.sparkSession, None
    for ids, texts in _blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(Seeds.of(ids, texts))

        def scan(batches, shared=shared):
            seeds = shared.value
            for batch in batches:
                doc_ids = batch.column("doc_id")
                rows = []
                for c in chunks(_lower(batch.column("text")), letter_words()):
                    for t, i, doc_start, item_start, n, matched in overlaps(c.words, c.starts, seeds):
                        rows.append((doc_ids[c.first + t].as_py(), seeds.ids[i], doc_start, item_start, n, matched, matched / n))
                if rows:
                    columns = list(zip(*rows))
                    kinds = [pa.int64()] * 6 + [pa.float64()]
                    names = [f.split()[0] for f in HIT_SCHEMA.split(", ")]
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        found = docs.select("doc_id", "text").mapInArrow(scan, HIT_SCHEMA)
        result = found if result is None else result.unionByName(found)
    return result if result is not None else spark.createDataFrame([], HIT_SCHEMA)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any verified overlap, with their columns as they were; no row is shuffled."""
    place = docs.columns.index("text")
    for ids, texts in _blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(Seeds.of(ids, texts))

        def scan(batches, shared=shared):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for c in chunks(_lower(batch.column(place)), letter_words()):
                    for t, *_ in overlaps(c.words, c.starts, shared.value):
                        clean[c.first + t] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs


def op2_spaced_seed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
