"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minutefold.llm.work import Scratch, word_count

#: Hex digits of the hash that one histogram looks at: 4,096 buckets per source.
DIGITS = 3
HASH_DIGITS = 32


def row_hash(*columns: Column) -> Column:
    """A row's place between 0 and 1, as 32 hex digits; equal rows share it."""
    return F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], cap: float, shares: tuple[float, ...]
) -> DataFrame:
    """Per source and share of all sizes: ``target``, at most ``cap`` times the source's size.

    ``sizes`` has one row per source: ``source``, ``source_size``. What a capped source leaves
    over goes to the others by weight, until none is above its cap; that fixed point is
    min(cap, level * weight) for one common level, found on the sources ordered by cap over
    weight. Works on one row per source only.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy("share")
    weighed = (
        sizes.withColumn(
            "weight",
            F.element_at(
                F.array(*[F.lit(float(w)) for w in weights]),
                ((F.row_number().over(by_code_point) - 1) % len(weights) + 1).cast("int"),
            ),
        )
        .withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("budget", F.sum("source_size").over(everything) * F.col("share"))
    )
    order = Window.partitionBy("share").orderBy(
        F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum(
        "weight"
    ).over(later)
    found = weighed.withColumn("place", F.row_number().over(order)).withColumn("level", level)
    free = F.when(F.col("most") >= F.col("level") * F.col("weight"), F.col("place"))
    found = found.withColumn("first_free", F.min(free).over(everything)).withColumn(
        "common",
        F.max(F.when(F.col("place") == F.col("first_free"), F.col("level"))).over(everything),
    )
    filled = F.coalesce(F.col("common") * F.col("weight"), F.col("most"))
    return found.select("source", "source_size", "share", F.least("most", filled).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame, scratch: Scratch) -> DataFrame:
    """Per source and share, the hash below which sizes add up nearest to ``rest``.

    ``sized``: ``source``, ``size``, ``hash``. A histogram over the first hex digits gives the
    bucket in which the budget ends; only the rows of that bucket are summed again, by the
    next digits, until the boundary bucket is one hash. Nothing is sorted but histograms.
    """
    key = ["source", "share"]
    null_safe = lambda a, b: F.col(f"a.{a}").eqNullSafe(F.col(f"b.{b}"))
    state = budgets.select(*key, "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("below"))
    running = Window.partitionBy(*key).orderBy("bucket")
    upto = 0
    while True:
        upto += DIGITS
        histogram = (
            sized.alias("a")
            .join(
                state.filter("rest > 0").alias("b"),
                null_safe("source", "source") & F.col("a.hash").startswith(F.col("b.prefix")),
            )
            .groupBy("b.source", "b.share", F.substring("a.hash", 1, min(upto, HASH_DIGITS)).alias("bucket"))
            .agg(
                F.sum("a.size").alias("bytes"),
                F.min("a.hash").alias("low"),
                F.max("a.hash").alias("high"),
            )
        )
        walked = (
            histogram.alias("a")
            .join(state.alias("b"), null_safe("source", "source") & (F.col("a.share") == F.col("b.share")))
            .select("a.*", "b.rest", "b.below")
            .withColumn("upper", F.col("below") + F.sum("bytes").over(running))
            .filter(F.col("upper") > F.col("rest"))
            .groupBy(*key)
            .agg(F.min_by(F.struct("bucket", "bytes", "upper", "low", "high"), "bucket").alias("at"))
        )
        state = scratch.land(
            state.alias("b")
            .join(
                walked.alias("a"),
                null_safe("source", "source") & (F.col("a.share") == F.col("b.share")),
                "left",
            )
            .select(
                "b.source",
                "b.share",
                "b.rest",
                F.coalesce("at.bucket", "b.prefix").alias("prefix"),
                F.coalesce(F.col("at.upper") - F.col("at.bytes"), "b.below").alias("below"),
                F.col("at.bytes").alias("bytes"),
                (F.col("at.low") != F.col("at.high")).alias("open"),
            ),
            "mix-bounds",
        )
        scratch.release("mix-bounds", keep=1)
        if upto >= HASH_DIGITS or state.filter("open").isEmpty():
            break
        state = state.drop("bytes", "open")
    # The last bucket is one hash: it is taken if that comes nearer to the budget.
    nearer = F.col("below") + F.col("bytes") - F.col("rest") < F.col("rest") - F.col("below")
    return state.select(
        *key,
        F.when(F.col("rest") <= 0, F.lit(""))
        .when(nearer, F.concat("prefix", F.lit("g")))
        .otherwise(F.col("prefix"))
        .alias("threshold"),
    )


def mix(
    df: DataFrame,
    scratch: Scratch,
    key: list[str],
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    cap: float = 3.0,
    shares: tuple[float, ...] = (1.0,),
) -> DataFrame:
    """Per row and share: ``key``, ``hash``, ``source``, ``size``, ``source_size``, ``target``, ``times``.

    ``times`` is how often the mix takes the row: as many whole rounds of the source as its
    target holds, and one more for rows whose hash is below the source's threshold. Larger
    shares take at least what smaller ones take. Words are the unit of ``size``.

    Sources are weighed in order of code points, a null source last and as one source. Null
    and blank texts have size 0 and are taken as their hash says. Rows equal in key and text
    share a hash and so a decision: a source's total misses its target by at most the half of
    one such group. An empty table gives no rows. Only the named columns are read, so others may have any name.
    """
    rows = scratch.land(
        df.select(
            *[F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(key)],
            F.col(f"`{source}`").alias("source"),
            word_count(F.col(f"`{text}`")).alias("size"),
            row_hash(*[F.col(f"`{c}`") for c in key], F.col(f"`{text}`")).alias("hash"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = scratch.land(
        source_targets(sizes, weights, cap, shares)
        .withColumn("rounds", rounds.cast("long"))
        .withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size")),
        "mix-targets",
    )
    bounds = thresholds(rows, targets, scratch)
    decided = (
        targets.alias("t")
        .join(
            bounds.alias("b"),
            F.col("t.source").eqNullSafe(F.col("b.source")) & (F.col("t.share") == F.col("b.share")),
        )
        .select("t.source", "t.share", "source_size", "target", "rounds", "threshold")
    )
    return (
        rows.alias("r")
        .join(decided.alias("d"), F.col("r.source").eqNullSafe(F.col("d.source")))
        .select(
            *[F.col(f"key{i}").alias(c) for i, c in enumerate(key)],
            "r.hash",
            "r.source",
            "d.share",
            "r.size",
            "d.source_size",
            "d.target",
            (F.col("rounds") + (F.col("r.hash") < F.col("threshold")).cast("long")).alias("times"),
        )
    )
