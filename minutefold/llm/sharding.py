"""Contiguous shards of near-equal bytes, from prefix sums over per-partition totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutefold.llm.work import Scratch, without

#: Low bits of ``monotonically_increasing_id`` that count rows inside a partition.
ROW_BITS = 33


def doc_bytes(text: Column, overhead: int = 8) -> Column:
    """UTF-8 bytes of the text, none for null, plus a fixed overhead."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead)


def shard(
    df: DataFrame,
    scratch: Scratch,
    size: Column,
    order_by: list[str],
    shards: int = 24,
) -> DataFrame:
    """The frame with ``size``, ``shard`` and ``slot``: shards are runs of the given order.

    Rows are dealt out by range of ``order_by``, sorted inside their partition and landed, so
    that a row's partition and place are fixed. Only one total per partition is summed
    globally; the row at which a cut falls is then looked for in the partitions that hold a
    cut. A row belongs to the shard in whose equal share of all bytes it begins, so a shard
    differs from its target by less than one row at either end.

    Nulls come first in the order. Rows equal in all of ``order_by`` are told apart by their
    place in the input, so a key that many rows share is dealt over many partitions. Fewer
    rows than shards leave shards empty; an empty table has no rows. Input columns called
    ``size``, ``shard`` or ``slot`` are replaced.
    """
    base = without(df.withColumn("__size", size), "size", "shard", "slot")
    base = base.withColumnRenamed("__size", "size")
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in order_by]
    placed = scratch.land(
        base.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "__tie")
        .sortWithinPartitions(*keys, "__tie")
        .drop("__tie")
        .withColumn("__at", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__at", ROW_BITS)),
        "shard-rows",
    )

    # One row per partition: the bytes and rows before it.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before_last = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -2)
    parts = placed.groupBy("__part").agg(
        F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows")
    )
    offsets = scratch.land(
        parts.select(
            "__part",
            "part_bytes",
            F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("part_bytes").over(before_last), F.lit(0)).alias("bytes_before_last"),
        ),
        "shard-offsets",
    )
    total = offsets.agg(F.sum("part_bytes")).first()[0] or 0

    def share(at: str) -> Column:
        return F.expr(f"least({shards - 1}L, ({at} * {shards}L) div {max(total, 1)}L)")

    # Rows in front of which a cut falls: only partitions that begin in another shard than
    # they end in have any, and those that begin in another than the one before them: the cut
    # may lie inside the last row of that one.
    cut_parts = offsets.filter(
        (share("bytes_before") != share("(bytes_before + part_bytes)"))
        | (share("bytes_before") != share("bytes_before_last"))
    ).select("__part", "bytes_before", "rows_before")
    running = Window.partitionBy("__part").orderBy("__at")
    firsts = (
        placed.select("__part", "__at", "size")
        .join(F.broadcast(cut_parts), "__part")  # at most two rows per shard
        .select(
            "__at",
            (F.col("rows_before") + F.row_number().over(running) - 1).alias("row"),
            (F.col("bytes_before") + F.sum("size").over(running) - F.col("size")).alias("start"),
        )
        .withColumn("shard", share("start"))
        .groupBy("shard")
        .agg(F.min("__at").alias("at"), F.min("row").alias("row"))
        .orderBy("at")
        .collect()  # one row per shard
    )
    # Partitions without a cut lie wholly in the shard that began last before them. The first
    # shard begins with the first row, whose partition need not be among those looked at.
    cuts = [(0, 0, 0)] + [(f["shard"], f["at"], f["row"]) for f in firsts if f["shard"] > 0]
    shard_no = first_row = F.lit(0).cast("long")
    for number, at, row in cuts:
        here = F.col("__at") >= F.lit(at)
        shard_no = F.when(here, F.lit(number).cast("long")).otherwise(shard_no)
        first_row = F.when(here, F.lit(row).cast("long")).otherwise(first_row)
    row = F.col("rows_before") + F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets.select("__part", "rows_before")), "__part")
        .withColumn("shard", shard_no.cast("int"))
        .withColumn("slot", (row - first_row).cast("long"))
        .drop("__at", "__part", "rows_before")
    )
