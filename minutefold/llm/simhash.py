"""Near duplicates by SimHash fingerprints, linked by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutefold.llm import components
from minutefold.llm.work import Scratch

BITS = 64
#: Shingles hashed at a time; bounds the memory that a long text takes.
BLOCK = 1 << 16
#: Fingerprints whose variants are made at a time, and variants that one bucket holds.
SLICE, BUCKET = 512, 1_000_000


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """The 64 majority bits over the XXH64 of all word shingles, as a signed number.

    Words are runs of anything but ASCII white space, A-Z in lower case. A bit is set if it is
    in more than half of the hashes, repeats included. Fewer words than a shingle are one
    shingle; no words, as in a null text, give 0.
    """
    words = (text or "").encode().lower().split()  # bytes: ASCII white space and letters only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    wide = min(shingle, len(words))
    starts, ends = starts[: len(words) - wide + 1].tolist(), ends[wide - 1 :].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK], ends[at : at + BLOCK], strict=True)
        hashes = np.array([digest(joined[s:e], seed) for s, e in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view("<i8")[0])


def ball_masks(radius: int) -> tuple[np.ndarray, int]:
    """Masks to flip, and how many of them, from the first on, are within half the radius.

    Let r be half the radius, rounded down. Up to distance 2r, two fingerprints meet at a
    variant within r of both. An odd radius 2r + 1 is met by r flips on one side and r + 1 on
    the other; such a pair differs in parity, so only fingerprints of odd parity need the
    larger ball, and as r + 1 of 2r + 1 places lie in one half of the word, only flips inside
    a half.
    """
    half = radius // 2
    inner = [c for n in range(half + 1) for c in combinations(range(BITS), n)]
    outer = []
    if radius % 2:
        for low in (0, BITS // 2):
            outer += combinations(range(low, low + BITS // 2), half + 1)
    masks = np.array([sum(1 << b for b in c) for c in inner + outer], np.uint64)
    return masks, len(inner)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = keys * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def links(fingerprints: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """Edges ``a``, ``b`` that connect what differs in at most ``radius`` bits.

    ``fingerprints`` has distinct values ``fp``. All variants of each are dealt out by their
    value; in a bucket, those that collide are joined to one that is there within half the
    radius, which is no further than the radius from any of them, and every such pair is
    verified. Two fingerprints within the radius collide somewhere with such a one, so the
    edges connect exactly what the links connect, without listing the pairs of a group. As
    fingerprints are distinct, a variant has no more of them than its ball has places.
    """
    masks, inner = ball_masks(radius)
    per = (len(masks) + inner) / 2
    buckets = int(fingerprints.count() * per // BUCKET) + 1

    def variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            every = batch["fp"].to_numpy().view(np.uint64)
            odd = np.bitwise_count(every) % 2 == 1
            for of, flips in ((every[~odd], masks[:inner]), (every[odd], masks)):
                for at in range(0, len(of), SLICE):
                    part = of[at : at + SLICE]
                    bucket = _bucket_of((part[:, None] ^ flips[None, :]).ravel(), buckets)
                    order = np.argsort(bucket, kind="stable")
                    numbers, cuts = np.unique(bucket[order], return_index=True)
                    source = part[order // len(flips)]
                    mask = (order % len(flips)).astype(np.uint32)
                    bounds = [*cuts, len(order)]
                    yield pd.DataFrame(
                        {
                            "bucket": numbers,
                            "fps": [source[i:j].tobytes() for i, j in zip(bounds, bounds[1:], strict=False)],
                            "masks": [mask[i:j].tobytes() for i, j in zip(bounds, bounds[1:], strict=False)],
                        }
                    )

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        fps = np.frombuffer(b"".join(group["fps"]), np.uint64)
        mask = np.frombuffer(b"".join(group["masks"]), np.uint32)
        keys = fps ^ masks[mask]
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        order = order[np.lexsort((mask[order], keys[order]))]  # the least mask first: the centre
        keys, fps, mask = keys[order], fps[order], mask[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        centre = np.repeat(first, np.diff([*first, len(keys)]))
        a, b = fps[centre], fps
        linked = (mask[centre] < inner) & (a != b) & (np.bitwise_count(a ^ b) <= radius)
        pairs = np.stack([a[linked], b[linked]], axis=1)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0) if len(pairs) else pairs
        return pd.DataFrame({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})

    dealt = fingerprints.mapInPandas(variants, "bucket int, fps binary, masks binary")
    return scratch.land(dealt.groupBy("bucket").applyInPandas(meet, "a long, b long"), "simhash-links")


def near_duplicates(
    df: DataFrame,
    key: list[str],
    scratch: Scratch,
    text: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """``key``, ``fp`` and ``component`` of every row: the classes of linked fingerprints.

    Fingerprints (signed 64-bit numbers) link at ``radius`` or fewer differing bits; a class is
    what links reach, and ``component`` its smallest first key (null if all are null). Null,
    empty and blank texts have fingerprint 0 and link like any other; repeated rows are in one
    class. Links are sought between distinct fingerprints only, so any number of copies costs
    one. An empty table gives no rows. Only the named columns are read.
    """

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    rows = scratch.land(
        df.select(
            *[F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(key)],
            of(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("fp"),
        ),
        "simhash-rows",
    )
    smallest = scratch.land(rows.groupBy("fp").agg(F.min("key0").alias("least")), "simhash-fps")
    star = components.stars(links(smallest.select("fp"), radius, scratch), scratch)
    scratch.release("simhash-links")
    rooted = smallest.join(star, smallest["fp"] == star["a"], "left").select(
        "fp", "least", F.coalesce("b", "fp").alias("root")
    )
    classes = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(classes, "root").select(F.col("fp").alias("of"), "component")
    return rows.join(named, F.col("fp") == F.col("of"), "left").select(
        *[F.col(f"key{i}").alias(c) for i, c in enumerate(key)], "fp", "component"
    )
