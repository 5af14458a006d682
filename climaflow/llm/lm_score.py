"""Language-model scores from a log-frequency Bloom filter.

Words and pairs of neighbouring words of the training texts are counted. A count is quantised to its power of two: an
n-gram of level q is put into a Bloom filter q times, together with 1, 2, ... q. Asking for the n-gram with 1, 2, ...
until the answer is no gives the level back, never too low and rarely too high. The workers
turn the levels of a word, of the word before it and of the pair into a smoothed probability:

    p(w) = (c(w) + 1) / (N + V + 1),   p(w | h) = (c(h w) + MASS p(w)) / (max(c(h), c(h w)) + MASS)

with c the middle of a level. A text is its words and one end; the end also stands before the first word.

Size of the filter. It has room for all entries of all words and pairs, so it grows with the texts, and nothing is left
out at any size. It is made in parts by hash range, whose number follows from the bytes of the texts; each part counts
its n-grams and takes as many segments as they need. It stays a table: the distinct words and pairs of a chunk of texts
are sent to the parts that hold them, and the levels come back to the chunk. A filter of at most ``max_bytes``, none unless
given, is broadcast instead. Both ways ask the same bits and give the same scores.

Exact word counts (for the base score) are broadcast for the ``TABLE_WORDS`` most frequent words at most. Rarer words, if
there are any beyond that, are joined by a shuffle of their occurrences.

Counting combines map-side and shuffles (n-gram hash, count) once; hashes of words have 64 bits, and keys of the filter
48: of 2^31 pairs one in 2^17 is taken for another, far fewer than the filter's own errors. Sorted hashes travel as
their differences, byte by byte, so that what is alike in neighbours, and bits that are not used, are compressed.

Defined results: null and empty texts consist of the end alone; ids that are null fall into the remainder of the empty
text; repeated rows weigh as often as they occur and all get a score; without training texts counts are zero; very long
texts are scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import run_dir
from .common import remainder_of_id
from .words import Chunk, chunks, mix, runs, white_space_words

# Rows whose id leaves this remainder are not learnt from.
PARTS, HELD_OUT = 7, 2
TABLE_WORDS = 4_000_000
BITS_PER_ENTRY, PROBES = 12, 6
MASS = 400.0

SEGMENT_BITS = 19
# The bits of a hash that make a key of the filter; parts and segments follow from the upper half alone.
KEY_BITS = np.uint64(0xFFFFFFFFFFFF0000)
# Bytes of text per part of the filter, which one task counts and builds.
PART_BYTES = 4 << 20
# n-grams that a task collects before it hands on their counts.
BUFFER = 4_000_000

END = np.uint64(0x5851F42D4C957F2D)
COUNT_SCHEMA = "part int, size tinyint, grams binary, counts binary"
PART_SCHEMA = "part int, segments int, bits binary, words binary, counts binary"


# Tokens ----------------------------------------------------------------------------------------------------------

def token_stream(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of the texts of a chunk, the pairs that end at each, and the first token of every text."""
    counts = chunk.counts
    starts = np.concatenate([[0], np.cumsum(counts + 1)])
    tokens = np.full(starts[-1], END, np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[starts[1:] - 1] = False
    tokens[inner] = chunk.words
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts[:-1]] = END
    return tokens, pair_hash(before, tokens), starts


def pair_hash(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    both = np.empty(2 * len(tokens), np.uint64)
    both[0::2], both[1::2] = before, tokens
    return runs(both, 2)[0::2]


# Counts ----------------------------------------------------------------------------------------------------------

def _packed_bytes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, and so on."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _unpacked_bytes(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed_sorted(grams: np.ndarray) -> bytes:
    return _packed_bytes(np.concatenate([grams[:1], grams[1:] - grams[:-1]]))


def _unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked_bytes(data, np.uint64), dtype=np.uint64)


def _starts_of(part: np.ndarray) -> np.ndarray:
    """Where each part begins in a sorted list of them, and its end."""
    return np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])


def _counted(batches, parts: int):
    """Counts of the words (size 1) and pairs (size 2, as keys) of a partition, combined as far as the buffer reaches;
    one row per part of the filter."""
    held: dict[int, list[np.ndarray]] = {1: [], 2: []}
    size = 0

    def flush():
        for k, found in held.items():
            if found:
                grams = np.concatenate(found)
                found.clear()
                grams, n = np.unique(grams if k == 1 else _sized(grams, 2), return_counts=True)
                part = part_of(grams if k == 2 else _sized(grams, 1), parts)[0]
                if k == 1:
                    order = np.argsort(part, kind="stable")
                    grams, n, part = grams[order], n[order], part[order]
                n, at = n.astype(np.int32), _starts_of(part)
                for some in range(0, len(at) - 1, 256):
                    cuts = list(zip(at[some:some + 256], at[some + 1:some + 257]))
                    yield pa.record_batch(
                        [pa.array([part[a] for a, _ in cuts], pa.int32()), pa.array([k] * len(cuts), pa.int8()),
                         pa.array([_packed_sorted(grams[a:b]) for a, b in cuts], pa.binary()),
                         pa.array([_packed_bytes(n[a:b]) for a, b in cuts], pa.binary())],
                        names=["part", "size", "grams", "counts"])

    for batch in batches:
        for c in chunks(batch.column(0), white_space_words()):
            tokens, pairs, _ = token_stream(c)
            held[1].append(tokens)
            held[2].append(pairs)
            size += 2 * len(tokens)
            if size >= BUFFER:
                yield from flush()
                size = 0
    yield from flush()


def _summed(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams and the sums of their counts."""
    if not len(grams):
        return grams, n
    order = np.argsort(grams)
    grams, n = grams[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.add.reduceat(n, first)


# The filter ------------------------------------------------------------------------------------------------------

def levels(counts: np.ndarray, least: np.ndarray | int) -> np.ndarray:
    """1 for counts from ``least`` up to twice that, 2 up to four times, and so on."""
    return 1 + np.floor(np.log2(np.maximum(counts / least, 1.0)) + 1e-12).astype(np.int64)


def middle(level: np.ndarray, least: int) -> np.ndarray:
    """The middle of a level; 0 for level 0."""
    low = least * np.exp2(level - 1.0)
    return np.where(level > 0, (low + np.maximum(2 * low - 1, low)) / 2, 0.0)


def _bits(grams: np.ndarray, level: np.ndarray | int, probe: int) -> np.ndarray:
    """Bit within its segment that a gram sets for one level and probe."""
    salt = (np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(probe * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)
    return mix(grams ^ salt) & np.uint64((1 << SEGMENT_BITS) - 1)


def _sized(grams: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Words and pairs in one space, as keys of the filter."""
    return mix(grams + np.asarray(size, np.uint64)) & KEY_BITS


def _probed(segments: np.ndarray, segment: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The level of each key (0: absent), by probing one level after another until one is missing."""
    found = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    at = 0
    while len(alive):
        at += 1
        for probe in range(PROBES):
            bit = _bits(keys[alive], at, probe)
            there = segments[segment[alive], (bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1
            alive = alive[there.astype(bool)]
        found[alive] = at
        if at == 64:
            break
    return found


@dataclass
class LogFrequencyFilter:
    """Segments of bits; a gram's segment is given by its hash, its bits by hash, level and probe."""

    segments: np.ndarray  # uint8, segments x bytes
    least_pair: int
    # Segments of each part; one part if not given.
    sizes: np.ndarray | None = None

    def level(self, grams: np.ndarray, size: int) -> np.ndarray:
        """The level of each gram, 0 for one that is absent."""
        keys = _sized(grams, size)
        sizes = np.array([len(self.segments)]) if self.sizes is None else self.sizes
        part, rest = part_of(keys, len(sizes))
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return _probed(self.segments, first[part] + segment_of(rest, sizes[part]), keys)


def part_of(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The high half of a hash, scaled to the number of parts, and the fraction that this leaves, in 32 bits."""
    scaled = (keys >> np.uint64(32)) * np.uint64(parts)
    return (scaled >> np.uint64(32)).astype(np.int64), scaled & np.uint64(0xFFFFFFFF)


def segment_of(rest: np.ndarray, segments: np.ndarray | int) -> np.ndarray:
    """The segment within a part."""
    return (rest * np.asarray(segments).astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def part_filter(words: np.ndarray, of_words: np.ndarray, pairs: np.ndarray, of_pairs: np.ndarray, parts: int, least_pair: int = 1) -> np.ndarray:
    """The segments of one part of the filter out of the counts of its words and of its pairs, these given as keys."""
    pairs, of_pairs = pairs[of_pairs >= least_pair], of_pairs[of_pairs >= least_pair]
    keys = np.concatenate([_sized(words, 1), pairs])
    level = np.concatenate([levels(of_words, 1), levels(of_pairs, least_pair)])
    segments = max(1, -(-int(level.sum()) * BITS_PER_ENTRY // (1 << SEGMENT_BITS)))
    bits = np.zeros((segments, 1 << SEGMENT_BITS), bool)
    segment = segment_of(part_of(keys, parts)[1], segments)
    for at in range(1, int(level.max(initial=0)) + 1):
        high = level >= at
        for probe in range(PROBES):
            bits[segment[high], _bits(keys[high], at, probe).astype(np.int64)] = True
    return np.packbits(bits, axis=1, bitorder="little")


def filter_parts(train: DataFrame, part_bytes: int = PART_BYTES) -> tuple[DataFrame, int]:
    """All parts of the filter, written, and their number: segments, bits, words and exact counts of words."""
    size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))

    def counted(batches):
        yield from _counted(batches, parts)

    def built(table: pa.Table) -> pa.Table:
        found: dict[int, list] = {1: [], 2: []}
        for k, grams, n in zip(table.column("size").to_pylist(), table.column("grams"), table.column("counts")):
            found[k].append((_unpacked_sorted(grams.as_py()), _unpacked_bytes(n.as_py(), np.int32).astype(np.int64)))
        whole = {k: [np.concatenate([np.zeros(0, kind), *(x[i] for x in v)]) for i, kind in enumerate((np.uint64, np.int64))] for k, v in found.items()}
        (words, counts), (pairs, of_pairs) = _summed(*whole[1]), _summed(*whole[2])
        bits = part_filter(words, counts, pairs, of_pairs, parts)
        return pa.table({
            "part": table.column("part")[:1], "segments": pa.array([len(bits)], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary()),
            "words": pa.array([words.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

    path = f"{run_dir(train.sparkSession, 'grams')}/parts.parquet"
    train.select("text").mapInArrow(counted, COUNT_SCHEMA).groupBy("part").applyInArrow(built, PART_SCHEMA).write.parquet(path)
    return train.sparkSession.read.parquet(path), parts


def _listed(batches):
    """Words and counts of the parts, one row each."""
    for batch in batches:
        for words, counts in zip(batch.column(0), batch.column(1)):
            grams, n = np.frombuffer(words.as_py(), np.int64), np.frombuffer(counts.as_py(), np.int64)
            yield pa.record_batch([pa.array(grams), pa.array(n)], names=["gram", "n"])


def whole_filter(table: DataFrame, parts: int) -> LogFrequencyFilter:
    """The filter of all parts."""
    rows = sorted(table.select("part", "segments", "bits").collect(), key=lambda r: r["part"])
    width = (1 << SEGMENT_BITS) // 8
    sizes = np.ones(parts, np.int64)
    for r in rows:
        sizes[r["part"]] = r["segments"]
    first = np.concatenate([[0], np.cumsum(sizes)])
    segments = np.zeros((first[-1], width), np.uint8)
    for r in rows:
        segments[first[r["part"]]:first[r["part"] + 1]] = np.frombuffer(r["bits"], np.uint8).reshape(-1, width)
    return LogFrequencyFilter(segments, 1, sizes)


# The model -------------------------------------------------------------------------------------------------------

@dataclass
class Model:
    """What workers need: the filter (None if it is joined), exact counts of frequent words, and the totals."""

    grams: LogFrequencyFilter | None
    words: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int

    def exact(self, tokens: np.ndarray) -> np.ndarray:
        """Counts of words in the table, 0 for others."""
        if not len(self.words):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        return np.where(self.words[at] == tokens, self.counts[at], 0)

    def log_probability(self, kind: np.ndarray, starts: np.ndarray, of_kinds: np.ndarray, of_pairs: np.ndarray, end: int) -> np.ndarray:
        """log10 probability of each token after the one before it, out of the levels of the kinds of words and of the
        pair at each token; ``end`` is the kind of the end."""
        once = middle(of_kinds, 1)
        single = (once + 1.0) / (self.tokens + self.distinct + 1.0)
        before = np.empty(len(kind))
        before[1:] = once[kind[:-1]]
        before[starts[:-1]] = once[end]
        both = middle(of_pairs, 1)
        return np.log10((both + MASS * single[kind]) / (np.maximum(before, both) + MASS))


def fit(docs: DataFrame, max_bytes: int = 0, table_words: int = TABLE_WORDS, part_bytes: int = PART_BYTES) -> tuple[Model, DataFrame, int, DataFrame, int]:
    """The model of the rows that are learnt from, the counts of words beyond the broadcast table and how many these are,
    the parts of the filter and their number."""
    train = docs.where(remainder_of_id("doc_id", PARTS) != HELD_OUT)
    table, parts = filter_parts(train, part_bytes)
    words = table.select("words", "counts").mapInArrow(_listed, "gram bigint, n bigint")
    power = F.floor(F.log2(F.col("n").cast("double")) + 1e-12).cast("int")
    sizes = words.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()
    distinct, tokens = sum(r["words"] for r in sizes), sum(r["tokens"] for r in sizes)
    least, room = 1 << 62, table_words
    for r in sorted(sizes, key=lambda r: -r["power"]):
        room -= r["words"]
        if room < 0:
            break
        least = 1 << r["power"]
    listed = words.where(F.col("n") >= least).toArrow()
    keys = listed.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    counts = listed.column("n").to_numpy()[order]
    segments = table.agg(F.sum("segments")).first()[0] or 1
    grams = whole_filter(table, parts) if max_bytes and segments << SEGMENT_BITS <= 8 * max_bytes else None
    model = Model(grams, keys[order], counts, tokens, distinct)
    return model, words.where(F.col("n") < least), distinct - len(keys), table, parts


SCORE_SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _scored(m: Model, ids, held_out, starts, kinds, kind, of_kinds, of_pairs, others: bool) -> pa.RecordBatch:
    """Scores of some texts by the levels of their words and pairs; with ``others`` the words beyond the table too."""
    counts = m.exact(kinds)[kind]
    n = np.diff(starts)
    base = np.add.reduceat(np.log10(counts + 1.0), starts[:-1]) - n * np.log10(m.tokens + m.distinct + 1.0)
    known = np.add.reduceat((counts > 0).astype(np.int64), starts[:-1])
    end = int(np.searchsorted(kinds, END))
    model_score = np.add.reduceat(m.log_probability(kind, starts, of_kinds, of_pairs, end), starts[:-1])
    columns = [ids, held_out, n, known, np.full(len(n), m.tokens), base, model_score]
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if others:
        other = counts == 0
        lists = np.concatenate([[0], np.cumsum(np.add.reduceat(other.astype(np.int64), starts[:-1]))])
        columns.append(pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), pa.array(kinds[kind[other]].view(np.int64))))
        names.append("others")
    return pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=names)


def _by_broadcast(rows: DataFrame, shared, others: bool, schema: str) -> DataFrame:
    def scored(batches):
        m = shared.value
        for batch in batches:
            for c in chunks(batch.column(2), white_space_words()):
                tokens, pairs, starts = token_stream(c)
                kinds, kind = np.unique(tokens, return_inverse=True)
                at = slice(c.first, c.last)
                yield _scored(m, batch.column(0)[at], batch.column(1)[at], starts, kinds, kind, m.grams.level(kinds, 1), m.grams.level(pairs, 2), others)

    return rows.mapInArrow(scored, schema)


# Tokens of the texts that ask for levels together: the more, the fewer n-grams are asked for twice.
CHUNK_TOKENS = 1_000_000
_CODEC = "zstd"
CHUNK_SCHEMA = "ids array<bigint>, held_out array<boolean>, starts binary, kinds binary, kind binary"


def _packed(batches):
    """One row per some texts: ids, the kinds of words and the kind of every token."""
    for batch in batches:
        held, size = [], 0
        for c in chunks(batch.column(2), white_space_words()):
            held.append((c.first, c.last, *token_stream(c)[::2]))
            size += len(held[-1][2])
            if size >= CHUNK_TOKENS:
                yield _packed_row(batch, held)
                held, size = [], 0
        if held:
            yield _packed_row(batch, held)


def _packed_row(batch: pa.RecordBatch, held: list) -> pa.RecordBatch:
    at = slice(held[0][0], held[-1][1])
    kinds, kind = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(h[3]) for h in held]))]).astype(np.int64)
    ends = pa.array([0, at.stop - at.start], pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.concat_arrays([batch.column(k)[at]])) for k in (0, 1)]
    kind = pa.compress(_packed_bytes(kind.astype(np.uint32)), codec=_CODEC, asbytes=True)
    data = [pa.array([x], pa.binary()) for x in (starts.tobytes(), _packed_sorted(kinds), kind)]
    return pa.record_batch([*lists, *data], names=["ids", "held_out", "starts", "kinds", "kind"])


def _unpacked(starts: bytes, kinds: bytes, kind: bytes) -> tuple[np.ndarray, ...]:
    """Starts, kinds, the kind of every token, and the keys in the filter of the kinds and of the pairs."""
    starts, kinds = np.frombuffer(starts, np.int64), _unpacked_sorted(kinds)
    kind = _unpacked_bytes(pa.decompress(kind, int(starts[-1]) * 4, codec=_CODEC, asbytes=True), np.uint32).astype(np.int64)
    tokens = kinds[kind]
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts[:-1]] = END
    return starts, kinds, kind, _sized(kinds, 1), _sized(pair_hash(before, tokens), 2)


def _by_join(rows: DataFrame, shared, others: bool, schema: str, table: DataFrame, parts: int) -> DataFrame:
    """The same scores where the filter is a table: chunks ask its parts for the levels of their distinct keys."""
    path = f"{run_dir(rows.sparkSession, 'chunks')}/rows.parquet"
    rows.mapInArrow(_packed, CHUNK_SCHEMA).withColumn("chunk", F.monotonically_increasing_id()).write.parquet(path)
    packed = rows.sparkSession.read.parquet(path)

    def asked(batches):
        for batch in batches:
            for chunk, *data in zip(*(c.to_pylist() for c in batch.columns)):
                *_, of_kinds, of_pairs = _unpacked(*data)
                keys = np.unique(np.concatenate([of_kinds, of_pairs]))
                part = part_of(keys, parts)[0]
                at = _starts_of(part)
                first, lists = at[:-1], [_packed_sorted(keys[a:b]) for a, b in zip(at[:-1], at[1:])]
                yield pa.record_batch(
                    [pa.array(np.full(len(first), chunk)), pa.array(part[first].astype(np.int32)), pa.array(lists, pa.binary())],
                    names=["chunk", "part", "keys"])

    def answered(asks: pa.Table, of_part: pa.Table) -> pa.Table:
        width = (1 << SEGMENT_BITS) // 8
        bits = b"".join(x.as_py() for x in of_part.column("bits")) or bytes(width)
        segments = np.frombuffer(bits, np.uint8).reshape(-1, width)
        found = []
        for data in asks.column("keys"):
            keys = _unpacked_sorted(data.as_py())
            found.append(_probed(segments, segment_of(part_of(keys, parts)[1], len(segments)), keys).astype(np.uint8).tobytes())
        return pa.table({"chunk": asks.column("chunk"), "part": asks.column("part"), "levels": pa.array(found, pa.binary())})

    def scored(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        starts, kinds, kind, of_kinds, of_pairs = _unpacked(*(chunk.column(c)[0].as_py() for c in ("starts", "kinds", "kind")))
        keys = np.unique(np.concatenate([of_kinds, of_pairs]))
        found = np.frombuffer(b"".join(x.as_py() for x in answers.sort_by("part").column("levels")), np.uint8).astype(np.int64)
        ids, held_out = (chunk.column(c).combine_chunks().flatten() for c in ("ids", "held_out"))
        batch = _scored(shared.value, ids, held_out, starts, kinds, kind, found[np.searchsorted(keys, of_kinds)], found[np.searchsorted(keys, of_pairs)], others)
        return pa.Table.from_batches([batch])

    asks = packed.select("chunk", "starts", "kinds", "kind").mapInArrow(asked, "chunk bigint, part int, keys binary")
    answers = asks.groupBy("part").cogroup(table.select("part", "bits").groupBy("part")).applyInArrow(
        answered, "chunk bigint, part int, levels binary")
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored, schema)


def score(docs: DataFrame, max_bytes: int = 0, table_words: int = TABLE_WORDS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) under the model of the rows that are learnt from."""
    spark = docs.sparkSession
    model, rest, n_rest, table, parts = fit(docs, max_bytes, table_words, part_bytes)
    shared = spark.sparkContext.broadcast(model)
    total = model.tokens
    rows = docs.select("doc_id", (remainder_of_id("doc_id", PARTS) == HELD_OUT).alias("held_out"), "text")
    schema = SCORE_SCHEMA + (", others array<bigint>" if n_rest else "")
    if model.grams is None:
        first = _by_join(rows, shared, bool(n_rest), schema, table, parts)
    else:
        first = _by_broadcast(rows, shared, bool(n_rest), schema)
    if not n_rest:
        return first

    # Words beyond the table: their occurrences meet their counts by a join. Each is rarer than any word in the table.
    path = f"{run_dir(spark, 'scores')}/rows.parquet"
    first.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    first = spark.read.parquet(path)
    occurrences = first.select("row", F.explode("others").alias("gram")).groupBy("row", "gram").agg(F.count(F.lit(1)).alias("times"))
    more = occurrences.join(rest.select("gram", "n"), "gram").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_base"), F.sum("times").alias("more_known"))
    whole = first.join(more, "row", "left")
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).alias("train_tokens"), (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score",
    )


def op7_log_frequency_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
