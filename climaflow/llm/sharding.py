"""Shards that each match the mixture of sources: proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source. Rank over source size is a row's place in [0, 1);
sorted by place, every stretch of rows holds the sources in their shares, and equal stretches are the shards.

Neither ranking puts a source or the table into one task. Ranks come from parts of the hash range: the rows of a
(source, part) are ranked by a window, the counts of the parts before are added. The parts grow with the root of the
rows, so a part of the largest source holds at most about that many rows. The sorted order over all sources is built
the same way from parts of [0, 1).

Defined results: a null text has size 16 and the checksum of no bytes; rows of a null source are a source of their
own; ties of the hash are ordered by id, checksum and size, and equal rows are interchangeable; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import cut, root_parts

SHARDS = 40
SEED = 20260214
ROW_OVERHEAD = 16

_TIES = ("u", "doc_id", "text_crc32", "size")


def narrow(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """What the order depends on, without texts: id, source, size, checksum and the seeded hash ``u``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "source", (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32")).withColumn(
        "u", F.xxhash64(F.lit(seed), "doc_id", "text_crc32")
    )


def _before(counts: DataFrame, within: list[str], part: str) -> DataFrame:
    """``first``: rows of the earlier parts of the same group; ``total``: rows of the group."""
    group = W.partitionBy(*within) if within else W.partitionBy(F.lit(0))
    running = group.orderBy(part).rowsBetween(W.unboundedPreceding, 0)
    return counts.withColumn("first", F.sum("n").over(running) - F.col("n")).withColumn("total", F.sum("n").over(group))


def _part_of(x: Column, parts: int) -> Column:
    return F.least(F.floor(x * parts), F.lit(parts - 1)).cast("int")


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Id, source, size, checksum, ``place`` in the interleaving, ``shard`` and ``slot`` of every row.

    Row counts of shards differ by one at most.
    """
    rows = cut(narrow(docs, seed))
    total = rows.count()
    parts = root_parts(total)
    rows = rows.withColumns({
        "source_key": F.struct("source"),
        "part": _part_of(F.shiftrightunsigned("u", 11) / F.lit(float(1 << 53)), parts),
    })
    keys = ["source_key", "part"]
    offsets = _before(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), ["source_key"], "part")
    local = F.row_number().over(W.partitionBy(*keys).orderBy(*_TIES))
    ranked = rows.withColumn("local", local).join(offsets.drop("n"), keys)
    place = (F.col("first") + F.col("local") - F.lit(0.5)) / F.col("total")
    placed = cut(ranked.select("doc_id", "source", "size", "text_crc32", "u", place.alias("place")))

    placed = placed.withColumn("part", _part_of(F.col("place"), parts))
    starts = _before(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")), [], "part")
    order = W.partitionBy("part").orderBy("place", "source", *_TIES)
    at = F.col("first") + F.row_number().over(order) - 1
    seated = placed.join(starts.select("part", "first"), "part").withColumn("at", at)
    shard = F.expr(f"cast(at * {shards} div {max(total, 1)} as int)")
    # The first position of shard s is the least p with p * shards div total = s.
    start = F.expr(f"(cast(shard as bigint) * {max(total, 1)} + {shards - 1}) div {shards}")
    return seated.withColumn("shard", shard).withColumn("slot", F.col("at") - start).select(
        "doc_id", "source", "size", "text_crc32", "place", "shard", "slot"
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, files: int = 8) -> None:
    """The documents as Parquet folders ``shard=N``, in slot order within each of a shard's ``files`` stretches.

    Rows meet their place through id, source, size and checksum; equal rows take their places in turn.
    """
    same = ["doc_id", "source", "size", "text_crc32"]
    turn = lambda order: F.row_number().over(W.partitionBy(*[F.struct(c) for c in same]).orderBy(order))
    given = assign(docs, shards, seed).withColumn("_turn", turn("place"))
    given = given.select(*[F.col(c).alias(f"_{c}") for c in same], "_turn", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    own = F.struct("*").alias("_row")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(own, "doc_id", "source", (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32")).withColumn("_doc_turn", turn("doc_id"))
    on = F.col("_turn") == F.col("_doc_turn")
    for c in same:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = keyed.join(given, on)
    stretch = F.expr(f"cast(_slot * {files} div greatest(1, {-(-max(docs.count(), 1) // shards)}) as int)")
    laid = joined.withColumn("_stretch", stretch).repartition(shards * files, "_shard", "_stretch")
    laid.sortWithinPartitions("_shard", "_slot").select(
        *[F.col(f"_row.{c}").alias(c) for c in docs.columns if c not in ("shard", "slot")], F.col("_slot").alias("slot"), F.col("_shard").alias("shard"),
    ).write.partitionBy("shard").parquet(path)


def op5_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )
