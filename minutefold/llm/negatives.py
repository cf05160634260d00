"""Hard negatives: rows of another label that score little below an anchor's positives."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutefold.llm.work import Scratch

#: Components of a block of rows and of one of anchors, rows of the smallest block, and scores
#: held at a time.
ROWS_BLOCK, ANCHORS_BLOCK, LEAST_BLOCK, SCORES = 1 << 20, 1 << 17, 1_024, 1 << 21
#: Sorted records that one task streams, at about.
TASK_RECORDS = 1_000_000

#: Whole numbers below these are exact in single and double precision.
_EXACT32, _EXACT64 = 2.0**24, 2.0**53
_LEAST, _MOST = -(2**63), 2**63 - 1
_SIGNED = 2**63
_KEY = ">QQQBQQ"


def quantised(vector: np.ndarray, scale: float) -> np.ndarray:
    """The whole numbers not above the scaled components, as doubles, finite ones."""
    with np.errstate(over="ignore"):
        most = np.finfo(np.float64).max
        return np.clip(np.floor(scale * vector), -most, most)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered vectors, as 64-bit numbers (the nearest, beyond).

    No partial sum exceeds the product of two lengths, so the fastest kind of number that is
    exact for the longest ones is used.
    """

    def longest(m: np.ndarray) -> float:
        with np.errstate(over="ignore"):
            return float(np.sqrt((m * m).sum(axis=1).max())) * (1 + 1e-9)

    bound = longest(anchors) * longest(rows)
    if bound < _EXACT32:
        return (anchors.astype(np.float32) @ rows.astype(np.float32).T).astype(np.int64)
    if bound < _EXACT64:
        return (anchors @ rows.T).astype(np.int64)
    whole = [[int(x) for x in r] for r in rows.tolist()]
    each = [[int(x) for x in a] for a in anchors.tolist()]
    exact = [[min(max(sum(x * y for x, y in zip(a, r, strict=True)), _LEAST), _MOST) for r in whole] for a in each]
    return np.array(exact, np.int64).reshape(len(each), len(whole))


def best(score: np.ndarray, allowed: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``top`` greatest allowed scores of each row, ties to the left."""
    at = np.flatnonzero(allowed.any(axis=1))
    score, allowed = score[at], allowed[at]
    if not len(at):
        return at, at
    down = np.where(allowed, ~score, _MOST)  # the complement turns the order round
    if down.shape[1] > top:
        # Whatever reaches the least of the best scores, ties included, is put in order below.
        last = np.partition(down, top - 1, axis=1)[:, top - 1]
        allowed = allowed & (down <= last[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, down[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, np.arange(len(at)))
    keep = np.arange(len(row)) - first[row] < top
    return at[row[keep]], column[keep]


def within(negative: np.ndarray, positive: np.ndarray, low: int, high: int) -> np.ndarray:
    """low * positive <= 100 * negative <= high * positive, exact."""
    if any(max(-int(x.min(initial=0)), int(x.max(initial=0))) >= 2**55 for x in (negative, positive)):
        negative, positive = negative.astype(object), positive.astype(object)
    hundred = 100 * negative
    return np.asarray((low * positive <= hundred) & (hundred <= high * positive), bool)


def packed(anchor: tuple[int, int], score: int, kind: int, row: tuple[int, int]) -> bytes:
    """A key whose bytes sort by anchor, score downwards, positives (0) before negatives (1), row.

    Anchor and row are each an id and a row number.
    """
    (a, a_row), (r, r_row) = anchor, row
    return struct.pack(_KEY, a + _SIGNED, a_row + _SIGNED, _MOST - score, kind, r + _SIGNED, r_row + _SIGNED)


def unpacked(key: bytes) -> tuple[tuple[int, int], int, int, int]:
    """Anchor, score, kind and the id of the row."""
    a, a_row, down, kind, row, _ = struct.unpack(_KEY, key)
    return (a - _SIGNED, a_row - _SIGNED), _MOST - down, kind, row - _SIGNED


def opened(records: Iterator[tuple[bytes, None]], positives: int, top: int, low: int, high: int) -> Iterator[tuple]:
    """Stream sorted keys: each of an anchor's first positives opens a window, negatives fall into
    the open ones, and a window closes when it is full or scores are below it."""
    anchor, seen, windows = None, 0, []
    for key, _ in records:
        of, score, kind, row = unpacked(key)
        if of != anchor:
            anchor, seen, windows = of, 0, []
        if kind == 0:
            if seen < positives:
                seen += 1
                windows.append([row, score, 0])
            continue
        hundred = 100 * score
        windows = [w for w in windows if w[2] < top and low * w[1] <= hundred]
        for window in windows:
            if hundred <= high * window[1]:
                window[2] += 1
                yield of[0], window[0], window[2], row, window[1], score


def mine(
    df: DataFrame,
    scratch: Scratch,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 100,
    positives: int = 5,
    top: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256.0,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose key is divisible by ``every``. A row's score is the inner product
    of its components, scaled and rounded down, with the anchor's; higher ones come first, ties
    go to the smaller key. An anchor's positives are its first ``positives`` other rows of its
    label; for each, its negatives are the first ``top`` rows of another label whose score is
    between ``low`` and ``high`` percent of the positive's. A positive without any has no row.

    Blocks of anchors meet blocks of rows twice: for the positives, and, as these tell which
    scores can matter, for the negatives. A block sends on no more than the first of each
    window among its own rows, which loses none. Their keys - anchor, descending score, id -
    are shuffled by anchor and sorted on the way, and a stream over them opens and closes
    windows, so no anchor's rows are ever held together.

    Rows with a null key, label or vector, or a null or non-finite component, take no part,
    nor do vectors of another size than the most frequent one, the smallest of several. Rows
    equal in key are rows of their own: each can be an anchor and each other's positive. Scores
    beyond 64 bits are the nearest such number. An empty table gives no rows. Only the named
    columns are read, so others may have any name.
    """
    spark = df.sparkSession
    item = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = scratch.land(
        df.select(
            F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), item.alias("v")
        )
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
        .filter(finite)
        .withColumn("row", F.monotonically_increasing_id()),
        "negatives-rows",
    )
    usual = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.col("count").desc(), "dims").first()
    dims = usual[0] if usual else 0
    rows = rows.filter(F.size("v") == dims)
    count, n_anchors = rows.agg(F.count("*"), F.count_if(F.col("id") % every == 0)).first()
    # Blocks of both sides have bounded sizes; each pair of blocks is one group. Small tables
    # are cut into as many blocks as there are cores.
    cores, wide = spark.sparkContext.defaultParallelism, max(1, dims)
    row_blocks = max(1, -(-count * wide // ROWS_BLOCK), min(cores, -(-count // LEAST_BLOCK)))
    anchor_blocks = max(1, -(-n_anchors * wide // ANCHORS_BLOCK))
    pairs = min(row_blocks * anchor_blocks, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def block(of: DataFrame, blocks: int, name: str, other: int, others: str) -> DataFrame:
        """Every row in its own block, once for each block of the other side."""
        own = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias(name)
        # Aliased, as both sides come from one table.
        return of.select(*[F.col(c).alias(c) for c in of.columns], own).withColumn(
            others, F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        )

    anchors = rows.filter(F.col("id") % every == 0)

    def arrays(of: pd.DataFrame) -> tuple:
        of = of.sort_values(["id", "row"], kind="stable")
        matrix = quantised(np.stack(of["v"].to_numpy()).astype(np.float64), scale)
        return of, of["id"].to_numpy(np.int64), of["row"].to_numpy(np.int64), of["label"].to_numpy(object), matrix

    def parts(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[tuple]:
        """Some anchors at a time with all rows of the block: their scores, and which share a label."""
        if not len(left) or not len(right):
            return
        of, ids, numbers, labels, matrix = arrays(left)
        _, r_ids, r_numbers, r_labels, r_matrix = arrays(right)
        step = max(1, SCORES // len(r_ids))
        for at in range(0, len(ids), step):
            s = slice(at, at + step)
            score = scores(matrix[s], r_matrix)
            same = labels[s, None] == r_labels[None, :]
            yield of.iloc[s], ids[s], numbers[s], score, same, r_ids, r_numbers

    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate([o[i] for o in out]) if out else [] for i, c in enumerate(columns)})

    columns = ("anchor", "anchor_row", "score", "kind", "id", "row")
    schema = "anchor long, anchor_row long, score long, kind int, id long, row long"

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, ids, numbers, score, same, r_ids, r_numbers in parts(left, right):
            a, r = best(score, same & (numbers[:, None] != r_numbers[None, :]), positives)
            out.append((ids[a], numbers[a], score[a, r], np.zeros(len(a), np.int32), r_ids[r], r_numbers[r]))
        return frame(out)

    def falling(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for of, ids, numbers, score, same, r_ids, r_numbers in parts(left, right):
            bounds = of["bounds"].to_numpy()
            keep = np.zeros(score.shape, bool)
            for k in range(positives):
                has = np.array([len(b) > k for b in bounds])
                limit = np.array([b[k] if len(b) > k else 0 for b in bounds], np.int64)
                a, r = best(score, has[:, None] & ~same & within(score, limit[:, None], low, high), top)
                keep[a, r] = True
            a, r = np.nonzero(keep)
            out.append((ids[a], numbers[a], score[a, r], np.ones(len(a), np.int32), r_ids[r], r_numbers[r]))
        return frame(out)

    def met(left: DataFrame, how) -> DataFrame:
        """Both sides by pairs of blocks; ``left`` has anchors."""
        # Dealt out in a fixed number of tasks: by bytes, Spark would put the work in a few.
        sides = block(left, anchor_blocks, "ab", row_blocks, "rb"), block(rows, row_blocks, "rb", anchor_blocks, "ab")
        asked, all_rows = (side.repartition(pairs, "ab", "rb").groupBy("ab", "rb") for side in sides)
        return asked.cogroup(all_rows).applyInPandas(how, schema)

    # No more positives of a block than an anchor has in all; the first of all blocks are its own.
    order = F.struct((-F.col("score").cast("decimal(20,0)")).alias("down"), "id", "row", "score")
    firsts = F.slice(F.array_sort(F.collect_list(order)), 1, positives).alias("firsts")
    near = scratch.land(met(anchors, nearest), "negatives-near")
    positive = scratch.land(
        near.groupBy(F.col("anchor").alias("of"), F.col("anchor_row").alias("of_row")).agg(firsts), "negatives-positives"
    )
    bounded = anchors.join(positive, (F.col("id") == F.col("of")) & (F.col("row") == F.col("of_row"))).select(
        "id", "row", "label", "v", F.col("firsts.score").alias("bounds")
    )
    negative = met(bounded, falling)
    opening = positive.select(F.col("of").alias("anchor"), F.col("of_row").alias("anchor_row"), F.explode("firsts").alias("p"))
    records = scratch.land(
        negative.unionByName(opening.select("anchor", "anchor_row", "p.score", F.lit(0).alias("kind"), "p.id", "p.row")),
        "negatives-records",
    )
    tasks = max(cores, -(-records.count() // TASK_RECORDS))

    def keyed(row) -> tuple[bytes, None]:
        return packed((row.anchor, row.anchor_row), row.score, row.kind, (row.id, row.row)), None

    def anchor_number(k: bytes) -> int:
        # Not hash(): Python salts that of bytes differently in every process.
        return int.from_bytes(k[:16], "big") * 0x9E3779B97F4A7C15 >> 64

    streamed = records.rdd.map(keyed).repartitionAndSortWithinPartitions(tasks, anchor_number)
    return spark.createDataFrame(
        streamed.mapPartitions(lambda part: opened(part, positives, top, low, high)),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
