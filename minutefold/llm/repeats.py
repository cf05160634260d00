"""Exact repeated strings, by interval expansion on Burrows-Wheeler transforms.

A string of the least length is the same wherever it occurs, and so is the place of the least
of its ``ANCHOR``-byte hashes, its anchor. Runs of neighbouring windows with one anchor are a
piece; windows that are equal lie in pieces of equal anchors. Pieces whose anchor is unique
hold no repeats. Equal pieces collapse to their earliest; what is left of an anchor that has
several pieces is gathered by anchor, and there a transform tells which windows are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutefold.llm.work import Scratch

#: Bytes of an anchor.
ANCHOR = 32
#: Bytes looked at in one go; places have PLACE_BITS bits. A longer text is done in blocks.
PLACE_BITS = 19
BLOCK = 1 << PLACE_BITS
#: Texts cut up at a time.
FEW = 1_000
#: Signs taken at a time by the expansion.
STEP = 4
#: Pieces that one bucket of anchors gathers, and bytes that one transform is made of: what
#: a task holds at a time is some two hundred times a piece, and fifty times a byte.
BUCKET_PIECES, BUCKET_BYTES = 250_000, 750_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_WORDS = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, made once per process."""
    if not _POWERS:
        _POWERS["up"], _POWERS["down"] = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))
    return _POWERS["up"], _POWERS["down"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def pieces(raw: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Pieces of several texts laid end to end: start, windows, anchor's place from the start, anchor, hash.

    ``first`` has where each text begins. No window crosses from one text to the next.
    """
    up, down = _tables()
    size = len(raw)
    none = *[np.zeros(0, np.int64)] * 3, *[np.zeros(0, np.uint64)] * 2
    if size < least:
        return none
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_WORDS[raw] * down[:size], out=sums[1:])
    anchor = _mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * up[: size - ANCHOR + 1])
    low = _U(BLOCK - 1)
    lowest = (anchor & ~low) | np.arange(len(anchor), dtype=np.uint64)
    wide, reach = least - ANCHOR + 1, 1
    while reach * 2 <= wide:
        lowest = np.minimum(lowest[:-reach], lowest[reach:])
        reach *= 2
    if wide > reach:
        lowest = np.minimum(lowest[: -(wide - reach)], lowest[wide - reach :])
    place = (lowest & low).astype(np.int64)  # of each window's anchor
    text = np.zeros(size, np.int32)
    text[first[1:]] = 1
    text = np.cumsum(text)
    inside = text[: size - least + 1] == text[least - 1 :]
    edge = np.flatnonzero((place[1:] != place[:-1]) | (inside[1:] != inside[:-1])) + 1
    start = np.concatenate([[0], edge])
    count = np.diff([*start, len(place)])
    start, count = start[inside[start]], count[inside[start]]
    whole = (sums[start + count + least - 1] - sums[start]) * up[start]
    return start, count, place[start] - start, anchor[place[start]], _mixed(whole + count.astype(np.uint64))


def _laid_out(texts: list[bytes], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts end to end, in runs of at most BLOCK bytes: bytes, firsts, text numbers, offsets."""
    run, first, number, offset, size = [], [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - least + 1), BLOCK - least):
            part = text[at : at + BLOCK - 1]
            if size + len(part) > BLOCK:
                yield np.frombuffer(b"".join(run), np.uint8), *map(np.array, (first, number, offset))
                run, first, number, offset, size = [], [], [], [], 0
            if len(part) >= least:
                first.append(size)
                run.append(part)
                number.append(i)
                offset.append(at)
                size += len(part)
    if run:
        yield np.frombuffer(b"".join(run), np.uint8), *map(np.array, (first, number, offset))


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their keys, ties in order of place, and each place's rank by key."""
    size = len(key)
    bits = max(1, size - 1).bit_length()
    if int(key.max()) < 1 << (63 - bits):  # one sort of numbers is several times an argsort
        both = np.sort((key << bits) | np.arange(size))
        order, ranked = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
    rank = np.empty(size, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
    return order, rank


def expand(raw: np.ndarray, least: int) -> np.ndarray:
    """For each sign of pieces laid end to end, each closed by a 0, the number of its class.

    Two places get the same number if equal strings of ``least`` signs, without a 0, begin
    there; places whose string occurs once get -1. ``raw`` holds bytes plus one, and zeros.

    The suffixes are sorted by more than ``least`` signs. From the intervals of the shortest
    strings on, the rows of every interval are dealt out by the ``STEP`` signs before them,
    which gives the intervals of the strings that much longer; what the rows of an interval
    have in common so grows round by round. Intervals of one row are left behind, and after
    the round that reaches ``least`` what is left is repeated.
    """
    size = len(raw)
    padded = np.concatenate([raw, np.zeros(8, raw.dtype)]).astype(np.int64)
    key = np.zeros(size, np.int64)
    for i in range(5):
        key = (key << 8) | padded[i : size + i]
    order, rank = _ranked(key)
    reach = 5
    while reach <= least and int(rank.max()) < size - 1:
        behind = np.zeros(size, np.int64)
        behind[: max(0, size - reach)] = rank[reach:] + 1
        order, rank = _ranked((rank << max(1, size).bit_length()) | behind)
        reach *= 2
    row_of = np.empty(size, np.int64)
    row_of[order] = np.arange(size)

    def begins(length: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row: whether ``length`` signs follow without a 0, and which, as a number."""
        word = np.zeros(size, np.int64)
        full = np.ones(size, bool)
        for i in range(length):
            sign = padded[i : size + i][order]
            word = (word << 8) | sign
            full &= sign > 0
        return full, word

    before = row_of[order - STEP]  # the row of the suffix that begins STEP signs earlier
    follows, first = begins(STEP)
    may = follows[before] & (order >= STEP)
    full, word = begins(least % STEP)
    rows = np.flatnonzero(full)
    interval = np.cumsum(np.concatenate([[True], word[rows][1:] != word[rows][:-1]])[: len(rows)])
    for _ in range(least // STEP):
        keep = may[rows]
        both = np.sort((before[rows[keep]] << 32) | interval[keep])
        rows, interval = both >> 32, both & 0xFFFFFFFF
        lead = first[rows]
        new = np.ones(len(rows), bool)
        new[1:] = (lead[1:] != lead[:-1]) | (interval[1:] != interval[:-1])
        last = np.ones(len(rows), bool)
        last[:-1] = new[1:]
        shared = ~(new & last)
        rows, interval = rows[shared], np.cumsum(new)[shared]
    found = np.full(size, -1, np.int64)
    found[order[rows]] = interval
    return found


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true marks."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]])))
    return edge[::2], edge[1::2] - edge[::2]


# The steps on tables ---------------------------------------------------------------------

#: Kinds of what an anchor's gathering settles: an equal earlier piece, a piece to be compared
#: with others of its anchor, and one of an anchor with too many to be compared in one place.
EQUAL, COMPARE, CROWD = 0, 1, 2
#: Different pieces of one anchor beyond which its windows are dealt out one by one.
CROWDED = 4_000

_SETTLED = "kind int, d long, t long, s int, n int, p int, a long"
_RANGES = "d long, t long, s int, n int"


def _numbers(parts: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _split(bucket: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """One row per bucket with the columns' values as bytes."""
    order = np.argsort(bucket, kind="stable")
    numbers, cuts = np.unique(bucket[order], return_index=True)
    bounds = [*cuts.tolist(), len(order)]
    out = {"bucket": numbers.astype(np.int32)}
    for name, column in columns.items():
        column = column[order]
        out[name] = [column[i:j].tobytes() for i, j in zip(bounds, bounds[1:], strict=False)]
    return pd.DataFrame(out)


def _cut_pieces(least: int, buckets: int):
    """Rows ``d``, ``t``, ``raw`` to their pieces by bucket of anchors; a text once per batch."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b.iloc[i : i + FEW] for b in batches for i in range(0, len(b), FEW)):
            batch = batch.sort_values("d", kind="stable").drop_duplicates("t")
            texts = [bytes(r) for r in batch["raw"]]
            d, t = batch["d"].to_numpy(np.int64), batch["t"].to_numpy(np.int64)
            for raw, first, number, offset in _laid_out(texts, least):
                start, count, place, anchor, whole = pieces(raw, first, least)
                if not len(start):
                    continue
                part = np.searchsorted(first, start, side="right") - 1
                yield _split(
                    (anchor >> _U(33)) % _U(buckets),
                    a=anchor,
                    h=whole,
                    d=d[number[part]],
                    t=t[number[part]],
                    s=(start - first[part] + offset[part]).astype(np.int32),
                    np=(place << 8 | count).astype(np.uint16),
                )

    return cut


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _settle(group: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket's pieces: later equal ones, and first ones of anchors with several pieces."""
    a, h = _numbers(group["a"], np.uint64), _numbers(group["h"], np.uint64)
    order = np.argsort(a)
    same = a[order[1:]] == a[order[:-1]]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    d, t = _numbers(group["d"], np.int64)[order], _numbers(group["t"], np.int64)[order]
    s, both = _numbers(group["s"], np.int32)[order], _numbers(group["np"], np.uint16)[order]
    a, h = a[order], h[order]
    # Copies of one text: the earliest stands for all.
    order = np.lexsort((d, s, t, h, a))
    once = order[_changes(a[order], h[order], t[order], s[order])]
    order = once[np.lexsort((s[once], t[once], d[once], h[once], a[once]))]
    a, h, d, t, s, both = (c[order] for c in (a, h, d, t, s, both))
    anchor, piece = _changes(a), _changes(a, h)
    number = np.cumsum(anchor) - 1
    different = np.bincount(number, piece)[number] if len(a) else np.zeros(0)
    kind = np.where(piece, np.where(different > CROWDED, CROWD, COMPARE), EQUAL)
    keep = ~piece | (different > 1)
    return pd.DataFrame(
        {"kind": kind, "d": d, "t": t, "s": s, "n": (both & 255).astype(np.int32), "p": (both >> 8).astype(np.int32), "a": a.view(np.int64)}
    )[keep]


def _parts(raw: np.ndarray, start: np.ndarray, n: np.ndarray, p: np.ndarray, a: np.ndarray, least: int):
    """Halves of pieces that may be repeated: piece, first window, number of windows.

    Windows that begin far before the anchor share the bytes before it, others those behind
    it; a half whose bytes there occur once in the bucket has no repeats.
    """
    up, down = _tables()
    reach = (least - ANCHOR) // 2
    out = []
    for left in (True, False):
        cut = np.clip(p - reach + 1, 0, n)  # windows from here on begin less than reach before
        first, count = (np.zeros_like(cut), cut) if left else (cut, n - cut)
        which = np.flatnonzero(count)
        low = (start + p - (reach if left else 0))[which]
        size = ANCHOR + (reach if left else least - ANCHOR - reach + 1)
        key = np.zeros(len(which), np.uint64)
        for i in range(size):
            key = key * _U(_BASE) + _WORDS[raw[low + i]]
        key = _mixed(key ^ a[which])
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        out.append((which[order], first[which[order]], count[which[order]]))
    return (np.concatenate(c) for c in zip(*out, strict=True))


def _later(number: np.ndarray, d: np.ndarray, t: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Places that have an earlier one of the same number."""
    order = np.lexsort((s, t, d, number))
    first = np.flatnonzero(_changes(number[order]))
    head = order[np.repeat(first, np.diff([*first, len(order)]))]
    later = (d[order] != d[head]) | (t[order] != t[head]) | (s[order] != s[head])
    return order[later]


def _as_ranges(d: np.ndarray, t: np.ndarray, s: np.ndarray) -> pd.DataFrame:
    """Single windows as runs of neighbours."""
    order = np.lexsort((s, t, d))
    d, t, s = d[order], t[order], s[order]
    new = _changes(d, t) | np.concatenate([[True], s[1:] - s[:-1] > 1])[: len(s)]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(s)]]) - 1
    return pd.DataFrame({"d": d[first], "t": t[first], "s": s[first], "n": s[last] - s[first] + 1})


def _compare(least: int):
    """Windows of a bucket of pieces that begin earlier elsewhere, as runs of neighbours."""

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        d, t = _numbers(group["d"], np.int64), _numbers(group["t"], np.int64)
        s, both = _numbers(group["s"], np.int32).astype(np.int64), _numbers(group["np"], np.uint16).astype(np.int64)
        a = _numbers(group["a"], np.uint64)
        if int(group["kind"].iloc[0]) == CROWD:
            later = _later(a, d, t, s)  # a: the hash of the single window
            return _as_ranges(d[later], t[later], s[later])
        raw = _numbers(group["body"], np.uint8)
        n, p = both & 255, both >> 8
        start = np.concatenate([[0], np.cumsum(n + least - 1)])[:-1]
        which, first, count = _parts(raw, start, n, p, a, least)
        if not len(which):
            return _as_ranges(d[:0], t[:0], s[:0])
        size = count + least  # with the closing 0
        ends = np.cumsum(size)
        within = np.arange(ends[-1]) - np.repeat(ends - size, size)
        source = np.repeat(start[which] + first, size) + within
        closing = within == np.repeat(size - 1, size)
        signs = np.where(closing, 0, raw[np.minimum(source, len(raw) - 1)] + 1).astype(np.uint8)
        number = expand(signs, least)
        at = np.flatnonzero(number >= 0)
        piece = np.repeat(which, size)[at]
        place = s[piece] + np.repeat(first, size)[at] + within[at]
        later = _later(number[at], d[piece], t[piece], place)
        return _as_ranges(d[piece][later], t[piece][later], place[later])

    return compare


def _take_bytes(least: int, buckets: dict[int, int]):
    """Rows ``d``, ``t``, ``z`` and their pieces to the pieces' bytes by bucket of anchors."""

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = zstandard.ZstdDecompressor()
        up, down = _tables()
        for batch in (b.iloc[i : i + FEW] for b in batches for i in range(0, len(b), FEW)):
            out = {kind: {k: [] for k in ("a", "d", "t", "s", "np", "body")} for kind in (COMPARE, CROWD)}
            for d, t, z, todo in zip(batch["d"], batch["t"], batch["z"], batch["todo"], strict=True):
                raw = plain.decompress(bytes(z))
                for x in todo:
                    body = raw[x["s"] : x["s"] + x["n"] + least - 1]
                    into = out[x["kind"]]
                    if x["kind"] == COMPARE:
                        a, s = [x["a"] % 2**64], [x["s"]]
                    else:
                        sums = np.zeros(len(body) + 1, np.uint64)
                        np.cumsum(_WORDS[np.frombuffer(body, np.uint8)] * down[: len(body)], out=sums[1:])
                        whole = _mixed((sums[least:] - sums[:-least]) * up[: x["n"]])
                        a, s = whole.tolist(), range(x["s"], x["s"] + x["n"])
                    into["a"] += a
                    into["s"] += s
                    into["d"] += [d] * len(a)
                    into["t"] += [t] * len(a)
                    into["np"] += [x["p"] << 8 | x["n"]] * len(a)
                    into["body"] += [body] * (x["kind"] == COMPARE)
            for kind, into in out.items():
                if not into["a"]:
                    continue
                a = np.array(into["a"], np.uint64)
                bucket = ((a >> _U(31)) % _U(buckets[kind])).astype(np.int64)
                made = _split(
                    bucket,
                    a=a,
                    d=np.array(into["d"], np.int64),
                    t=np.array(into["t"], np.int64),
                    s=np.array(into["s"], np.int32),
                    np=np.array(into["np"], np.uint16),
                )
                order = np.argsort(bucket, kind="stable")
                bounds = np.flatnonzero(_changes(bucket[order])).tolist() + [len(order)]
                bodies = into["body"]
                made["body"] = [
                    b"".join([bodies[k] for k in order[i:j]]) if bodies else b""
                    for i, j in zip(bounds, bounds[1:], strict=False)
                ]
                yield made.assign(kind=kind)

    return take


def _without_repeats(least: int, with_text: bool):
    """Rows ``d``, ``t``, ``z`` and ranges of repeated windows to what stays of the text."""

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for d, t, z, todo in zip(batch["d"], batch["t"], batch["z"], batch["todo"], strict=True):
                raw = np.frombuffer(plain.decompress(bytes(z)), np.uint8)
                steps = np.zeros(len(raw) + 1, np.int32)
                for x in todo:
                    steps[x["s"]] += 1
                    steps[x["s"] + x["n"] + least - 1] -= 1
                gone = np.cumsum(steps[:-1]) > 0
                kept = raw[~gone].tobytes()
                starts, sizes = _runs(gone)
                spans = ",".join(f"{s}:{s + n}" for s, n in zip(starts.tolist(), sizes.tolist(), strict=True))
                out.append((d, t, int(gone.sum()), len(starts), hashlib.sha256(kept).hexdigest(), spans, kept if with_text else None))
            yield pd.DataFrame(out, columns=["d", "t", "n_removed", "n_spans", "kept_sha256", "removed", "kept"])

    return remove


def _zipped(raw: pd.Series) -> pd.Series:
    pack = zstandard.ZstdCompressor(level=1)
    return raw.map(lambda r: pack.compress(bytes(r)))


def remove_repeats(
    df: DataFrame,
    key: str,
    scratch: Scratch,
    text: str = "text",
    least: int = 100,
    with_text: bool = False,
) -> DataFrame:
    """Per row, what is left of the text's UTF-8 bytes without earlier repeated strings.

    A byte goes if a string of ``least`` bytes that covers it also begins earlier: in a row of
    smaller key, or earlier in the same text; overlaps count, and strings are judged on the
    input. Returns ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256``, ``removed`` (the runs as start:end, comma-joined) and, if asked, ``kept``, the
    bytes that stay of a text that loses any (null: the whole text stays).

    A null text is empty. Null keys come last. Of rows equal in key the order is that of a hash
    of their texts, and of rows equal in key and text one is the first. Texts shorter than
    ``least`` stay whole. An empty table gives no rows. Only the named columns are read.
    """
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    whole = F.sha2(raw, 256)
    base = df.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(2**63 - 1)).alias("d"),
        whole.alias("h"),
        F.conv(F.substring(whole, 1, 15), 16, 10).cast("long").alias("t"),
        raw.alias("raw"),
    )
    rows = scratch.land(
        base.groupBy("id", "d", "h", "t", F.octet_length("raw").cast("long").alias("n_bytes")).agg(F.count("*").alias("times")),
        "repeats-rows",
    )
    total = rows.agg(F.sum(F.col("n_bytes") * F.col("times"))).first()[0] or 0
    long_enough = base.filter(F.octet_length("raw") >= least)

    buckets = 2 * int(total) // ((least - ANCHOR + 2) * BUCKET_PIECES) + 1
    settled = scratch.land(
        long_enough.select("d", "t", "raw")
        .mapInPandas(_cut_pieces(least, buckets), "bucket int, a binary, h binary, d binary, t binary, s binary, np binary")
        .groupBy("bucket")
        .applyInPandas(_settle, _SETTLED),
        "repeats-settled",
    )
    windows = {r["kind"]: (r["pieces"], r["windows"]) for r in settled.groupBy("kind").agg(F.count("*").alias("pieces"), F.sum("n").alias("windows")).collect()}
    many, wide = windows.get(COMPARE, (0, 0))
    spread = {
        COMPARE: (many * (least - 1) + wide) // BUCKET_BYTES + 1,
        CROWD: windows.get(CROWD, (0, 0))[1] // BUCKET_PIECES + 1,
    }
    zipped = F.pandas_udf(_zipped, "binary")
    texts = long_enough.select("d", "t", zipped("raw").alias("z"))

    def per_text(ranges: DataFrame, *columns: str) -> DataFrame:
        gathered = ranges.groupBy(F.col("d").alias("d1"), F.col("t").alias("t1")).agg(F.collect_list(F.struct(*columns)).alias("todo"))
        return texts.join(gathered, (F.col("d") == F.col("d1")) & (F.col("t") == F.col("t1"))).select("d", "t", "z", "todo")

    compared = (
        per_text(settled.filter(F.col("kind") != EQUAL), "kind", "s", "n", "p", "a")
        .mapInPandas(_take_bytes(least, spread), "kind int, bucket int, a binary, d binary, t binary, s binary, np binary, body binary")
        .groupBy("kind", "bucket")
        .applyInPandas(_compare(least), _RANGES)
    )
    equal = settled.filter(F.col("kind") == EQUAL).select("d", "t", "s", "n")
    ranges = scratch.land(equal.union(compared), "repeats-ranges")
    result = scratch.land(
        per_text(ranges, "s", "n")
        .mapInPandas(
            _without_repeats(least, with_text),
            "d long, t long, n_removed long, n_spans long, kept_sha256 string, removed string, kept binary",
        )
        .dropDuplicates(["d", "t"]),
        "repeats-result",
    )

    scratch.release("repeats-settled")
    scratch.release("repeats-ranges")

    # Of rows with one text, the earliest has the result and the others lose every byte.
    # Landed, so that the join shuffles it and Spark can split a text that many rows have.
    least_key = scratch.land(
        rows.groupBy(F.col("h").alias("h1")).agg(F.min("d").alias("d1")), "repeats-firsts"
    )
    each = (
        rows.join(least_key, F.col("h") == F.col("h1"))
        .withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .withColumn("copy", ((F.col("d") != F.col("d1")) | (F.col("time") > 1)) & (F.col("n_bytes") >= least))
    )
    left = each.alias("e").join(result.alias("r"), (F.col("e.d") == F.col("r.d")) & (F.col("e.t") == F.col("r.t")), "left")
    nothing = hashlib.sha256(b"").hexdigest()

    def of(copied: Column, found: str, else_: Column) -> Column:
        return F.when(F.col("copy"), copied).otherwise(F.coalesce(found, else_))

    return left.select(
        F.col("id").alias(key),
        "n_bytes",
        of(F.col("n_bytes"), "n_removed", F.lit(0)).cast("long").alias("n_removed"),
        of(F.lit(1), "n_spans", F.lit(0)).cast("long").alias("n_spans"),
        of(F.lit(nothing), "kept_sha256", F.col("h")).alias("kept_sha256"),
        of(F.concat(F.lit("0:"), F.col("n_bytes").cast("string")), "removed", F.lit("")).alias("removed"),
        *([F.when(F.col("copy"), F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if with_text else []),
    )
