"""Order-dependent work on long sequences, cut into bounded chunks.

A window over a whole station, or over the whole table, would put one key into one task.
These helpers cut the sequence into chunks of bounded size and carry what a chunk needs
from its neighbours: a total, a last row, or a few trailing rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

DAY = 86400


def _in_chunks(df: DataFrame, keys: tuple[str, ...], chunk: Column) -> DataFrame:
    """Rows with their chunk. The null test is spelled out so that both branches of the join that
    follows read the same subplan and Spark runs its shuffle once."""
    chunked = df.withColumn("_chunk", chunk)
    for c in (*keys, "_chunk"):
        chunked = chunked.where(F.col(c).isNotNull())
    return chunked


def running_totals(df: DataFrame, seq: str, totals: dict[str, str], keys: tuple[str, ...] = (),
                   width: int = 65536) -> DataFrame:
    """Running sums in ``seq`` order; ``totals`` maps output name to input column.

    ``seq`` is a whole number, unique per key, so a chunk of ``width`` numbers holds at most
    ``width`` rows. Chunk totals are summed first and their running sums added to each chunk.
    """
    chunked = _in_chunks(df, keys, F.floor(F.col(seq) / width))
    parts = chunked.groupBy(*keys, "_chunk").agg(*[F.sum(src).alias(f"_t_{out}") for out, src in totals.items()])
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        *keys, "_chunk",
        *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_o_{out}") for out in totals],
    )
    inside = W.partitionBy(*keys, "_chunk").orderBy(seq).rowsBetween(W.unboundedPreceding, 0)
    local = chunked.withColumns({f"_l_{out}": F.sum(src).over(inside) for out, src in totals.items()})
    joined = local.join(offsets, [*keys, "_chunk"])
    summed = joined.withColumns({out: F.col(f"_o_{out}") + F.col(f"_l_{out}") for out in totals})
    return summed.drop("_chunk", *[f"_l_{o}" for o in totals], *[f"_o_{o}" for o in totals])


def sequence_number(df: DataFrame, seq: str, out: str, keys: tuple[str, ...] = (), width: int = 65536) -> DataFrame:
    """Gap-free 1, 2, 3 ... in ``seq`` order without a single-task sort."""
    return running_totals(df.withColumn("_one", F.lit(1)), seq, {out: "_one"}, keys, width).drop("_one")


def trailing_rows(df: DataFrame, number: str, k: int, outputs: dict, keys: tuple[str, ...] = (),
                  width: int = 65536) -> DataFrame:
    """Aggregates over the last ``k`` rows of a gap-free ``number``.

    ``outputs`` maps a name to a function of a window. The last k-1 rows of each chunk are
    copied into the next one, so every frame is complete inside its chunk.
    """
    last_in_chunk = F.pmod(F.col(number), F.lit(width)) > width - k
    home = F.floor(F.col(number) / width)
    homes = F.when(last_in_chunk, F.array(home, home + 1)).otherwise(F.array(home))
    copies = df.withColumn("_chunk", F.explode(homes))
    w = W.partitionBy(*keys, "_chunk").orderBy(number).rowsBetween(-(k - 1), 0)
    done = copies.withColumns({name: fn(w) for name, fn in outputs.items()})
    return done.where(F.col("_chunk") == home).drop("_chunk")


def previous_row(df: DataFrame, keys: tuple[str, ...], second: str, columns: list[str], chunk: int = DAY) -> DataFrame:
    """``prev_<c>`` of the row before, for rows that are unique per key and whole second.

    Chunks are days, so they hold at most 86,400 rows per key. The first row of a day takes
    the last row of the newest earlier day that has any.
    """
    chunked = _in_chunks(df, keys, F.floor(F.col(second) / chunk))
    edges = chunked.groupBy(*keys, "_chunk").agg(*[F.max_by(c, second).alias(f"_last_{c}") for c in columns])
    by_chunk = W.partitionBy(*keys).orderBy("_chunk")
    carried = edges.select(
        *keys, "_chunk", *[F.lag(f"_last_{c}").over(by_chunk).alias(f"_edge_{c}") for c in columns]
    )
    w = W.partitionBy(*keys, "_chunk").orderBy(second)
    joined = chunked.join(carried, [*keys, "_chunk"])
    ranked = joined.withColumn("_first", F.row_number().over(w) == 1)
    previous = {
        f"prev_{c}": F.when(F.col("_first"), F.col(f"_edge_{c}")).otherwise(F.lag(c).over(w)) for c in columns
    }
    return ranked.withColumns(previous).drop("_first", "_chunk", *[f"_edge_{c}" for c in columns])


def trailing_seconds(df: DataFrame, keys: tuple[str, ...], second: str, span: int, outputs: dict) -> DataFrame:
    """Aggregates over rows of the last ``span`` seconds, ``second`` unique per key.

    ``outputs`` maps a name to a function of a window. Rows near a chunk's end are copied into
    the next chunk; a chunk is at least a day and at least ``span`` long.
    """
    chunk = max(DAY, span)
    home = F.floor(F.col(second) / chunk)
    near_end = F.pmod(F.col(second), F.lit(chunk)) > chunk - span
    copies = df.withColumn("_chunk", F.explode(F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))))
    w = W.partitionBy(*keys, "_chunk").orderBy(second).rangeBetween(-(span - 1), 0)
    done = copies.withColumns({name: fn(w) for name, fn in outputs.items()})
    return done.where(F.col("_chunk") == home).drop("_chunk")
