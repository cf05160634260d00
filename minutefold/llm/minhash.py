"""Near duplicates by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutefold.llm import components
from minutefold.llm.work import Scratch

#: Coordinates of a sketch (a power of two) and of one band. A pair of Jaccard similarity s shares
#: no band with probability (1 - s ** ROWS) ** (BINS / ROWS): 5e-8 at 0.8.
BINS, ROWS = 128, 4
#: Share of equal coordinates below which a pair is not looked at. At a similarity of 0.8 fewer
#: agree with probability exp(-2 * 0.3 ** 2 * BINS) = 1e-10, by the sketch's concentration bound.
AGREE = 0.5
#: Shingles sketched side by side, and words whose hashes a task remembers.
BLOCK, WORDS = 1 << 20, 1 << 20
#: Texts of a bucket whose pairs are listed; fuller buckets are compared in blocks, of at most so
#: many texts and shingles on average.
FEW, CROWD, CROWD_SHINGLES = 4, 1_024, 1 << 21
#: Texts that one text of a block is compared with at a time, the likeliest first.
STEP = 64

_BIN_BITS = BINS.bit_length() - 1
_EMPTY = np.uint64(2**64 - 1)
_GOLDEN, _M1, _M2 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number as another one that looks random (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """XXH64 of words, remembered: few words make up most of a text."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < WORDS:
            self[word] = found
        return found


def shingle_set(text: str | None, shingle: int, hashes: dict[bytes, int]) -> np.ndarray:
    """The distinct word shingles of a text as 64-bit hashes, in order.

    Words are runs of anything but ASCII white space, A-Z in lower case. Fewer words than a
    shingle are one shingle; a null, empty or blank text has none.
    """
    words = (text or "").encode().lower().split()  # bytes: ASCII white space and letters only
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    wide = min(shingle, len(words))
    code = np.full(len(each) - wide + 1 if wide else 0, wide, np.uint64)
    for i in range(wide):
        code = _mixed(code * _GOLDEN + each[i : i + len(code)])
    return np.unique(code)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BINS coordinates for each set, none of them empty.

    In round r every element lands in a bin that its hash of the round names, with the rest of
    the hash as its value; a bin keeps the least value of the first round that reached it.
    After BINS such rounds, round BINS + j puts every element into bin j, so every bin of a
    set with any element fills. Two sets agree in a coordinate with the probability of their
    Jaccard similarity, concentrated as that of independent draws. Large sets take one or
    two rounds, and a set leaves when its bins are full.
    """
    out = np.full((len(sets), BINS), _EMPTY)
    flat_out, sizes = out.reshape(-1), np.array([len(s) for s in sets])
    live = np.flatnonzero(sizes)
    items = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    for r in range(2 * BINS):
        if not len(live):
            break
        x = _mixed(items + np.uint64((r + 1) * int(_GOLDEN) % 2**64))
        if r < BINS:
            place, value = owner * BINS + (x >> np.uint64(64 - _BIN_BITS)).astype(np.int64), x << np.uint64(_BIN_BITS)
        else:
            place, value = owner * BINS + (r - BINS), x
        value = np.minimum(value, _EMPTY - np.uint64(1))
        fresh = flat_out[place] == _EMPTY
        np.minimum.at(flat_out, place[fresh], value[fresh])
        full = ~(out[live] == _EMPTY).any(axis=1)
        if full.any():
            done = np.zeros(len(sets), bool)
            done[live[full]] = True
            live = live[~full]
            left = ~done[owner]
            items, owner = items[left], owner[left]
    return out


def _sketched(sets: list[np.ndarray]) -> np.ndarray:
    """The same, so many sets at a time that their elements stay within a block."""
    parts, held, size = [np.zeros((0, BINS), np.uint64)], [], 0
    for s in sets:
        if held and size + len(s) > BLOCK:
            parts.append(sketch(held))
            held, size = [], 0
        held.append(s)
        size += len(s)
    return np.concatenate([*parts, sketch(held)]) if held else parts[0]


def bands(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit number per band, its own number mixed in."""
    by_band = sketches.reshape(len(sketches), BINS // ROWS, ROWS)
    code = np.broadcast_to(np.arange(BINS // ROWS, dtype=np.uint64), by_band.shape[:2])
    for i in range(ROWS):
        code = _mixed(code * _GOLDEN + by_band[:, :, i])
    return code.view(np.int64)


def similar(a: bytes, b: bytes, percent: int) -> bool:
    """Whether two sets, each distinct hashes in order, have a Jaccard similarity of the percentage."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def connecting(
    roots: np.ndarray, bands: np.ndarray, coords: np.ndarray, items: list[np.ndarray], sides: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Pairs of places in the arrays that link and connect components no pair before did.

    Candidates share a band, agree in enough coordinates, and are of different components.
    Only texts outside the largest one look for partners. ``sides`` numbers the block of each
    text: of two blocks, only pairs across are looked at.
    """
    sizes, across = np.array([len(i) for i in items]), len(np.unique(sides)) > 1
    _, label = np.unique(roots, return_inverse=True)
    open_to = np.ones(len(label), bool)
    found = []
    for at in np.flatnonzero(label != np.bincount(label).argmax()).tolist():
        open_to[at] = False  # its pairs are looked at now, not once more from the other side
        mates = open_to & (label != label[at])
        if across:
            mates &= sides != sides[at]
        mates &= 100 * np.minimum(sizes, sizes[at]) >= percent * np.maximum(sizes, sizes[at])
        mates = np.flatnonzero(mates)
        mates = mates[(bands[mates] == bands[at]).any(axis=1)]
        equal = (coords[mates] == coords[at]).sum(axis=1)
        mates = mates[np.argsort(-equal, kind="stable")][: (equal >= AGREE * BINS).sum()]
        while len(mates):
            now, mates = mates[:STEP], mates[STEP:]
            others = np.concatenate([items[m] for m in now.tolist()])
            place = np.minimum(np.searchsorted(items[at], others), sizes[at] - 1)
            starts = np.cumsum(sizes[now]) - sizes[now]
            both = np.add.reduceat((items[at][place] == others).astype(np.int64), starts)
            for m in now[100 * both >= percent * (sizes[at] + sizes[now] - both)].tolist():
                if label[m] != label[at]:
                    found.append((at, m))
                    label[label == label[m]] = label[at]
            mates = mates[label[mates] != label[at]]
    return found


def _drawn(rep: str) -> Column:
    """The order in which texts become centres: at random, but the same in every bucket."""
    return F.struct(F.xxhash64(rep).alias("drawn"), F.col(rep).alias("rep"))


class _Links:
    """The search for links among texts that share a bucket.

    ``slim`` has ``rep``, ``n``, ``coords``, ``bands`` of each text, ``sets`` its ``items``.
    """

    def __init__(self, slim: DataFrame, sets: DataFrame, percent: int, scratch: Scratch):
        self.slim, self.sets, self.percent, self.scratch = slim, sets, percent, scratch

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Edges ``a``, ``b`` of the pairs ``member``, ``centre`` that link, by their full sets.

        The centre is joined first, while rows are narrow: it may be that of many pairs, and
        Spark splits such a partition of a sort-merge join.
        """
        percent = self.percent

        @F.pandas_udf("boolean")
        def agree(a: pd.Series, b: pd.Series) -> pd.Series:
            x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, BINS) for s in (a, b))
            return pd.Series((x == y).sum(axis=1) >= AGREE * BINS)

        @F.pandas_udf("boolean")
        def confirmed(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series([similar(x, y, percent) for x, y in zip(a, b, strict=True)], dtype=bool)

        def with_both(frame: DataFrame, table: DataFrame) -> DataFrame:
            for side in ("centre", "member"):
                named = table.withColumnsRenamed({c: f"{side}_{c}" for c in table.columns})
                frame = frame.join(named, F.col(side) == F.col(f"{side}_rep"))
            return frame

        sized = with_both(pairs, self.slim.select("rep", "n", "coords")).filter(
            100 * F.least("centre_n", "member_n") >= percent * F.greatest("centre_n", "member_n")
        )
        near = self.scratch.land(
            sized.filter(agree("centre_coords", "member_coords")).select("member", "centre"), "minhash-near"
        )
        links = with_both(near, self.sets).filter(confirmed("centre_items", "member_items"))
        return self.scratch.land(links.select(F.col("member").alias("a"), F.col("centre").alias("b")), "minhash-links")

    def crowded(self, crowd: DataFrame) -> DataFrame:
        """Edges that connect what the links of crowded buckets connect.

        ``crowd`` has ``bucket``, ``rep`` and ``root``. Texts that buckets connect are a
        cluster; each is in one cluster, however many buckets it is in, and so is every pair of
        a bucket. Clusters are dealt into blocks of bounded size, and every pair of blocks is
        one group, so that no cluster is held by one task and no pair is a row.
        """
        percent, scratch = self.percent, self.scratch
        least = crowd.groupBy(F.col("bucket").alias("of")).agg(F.min("rep").alias("b"))
        edges = crowd.join(least, F.col("bucket") == F.col("of")).filter("rep != b")
        of_cluster = components.stars(edges.select(F.col("rep").alias("a"), "b").distinct(), Scratch())
        texts = crowd.select("rep", "root").distinct().join(of_cluster, F.col("rep") == F.col("a"), "left")
        texts = texts.select("rep", "root", F.coalesce("b", "rep").alias("cluster"))
        texts = scratch.land(texts.join(self.slim.select("rep", "n", "coords", "bands"), "rep"), "minhash-crowd")
        blocks = F.ceil(F.greatest(F.count("*") / CROWD, F.sum("n") / CROWD_SHINGLES)).cast("int")
        sized = texts.groupBy(F.col("cluster").alias("of")).agg(blocks.alias("blocks"))
        dealt = (
            texts.join(sized, F.col("cluster") == F.col("of"))
            .withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .join(self.sets.withColumnRenamed("rep", "of_rep"), F.col("rep") == F.col("of_rep"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "cluster", F.least("side", "with").alias("low"), F.greatest("side", "with").alias("high"),
                "side", "rep", "root", "coords", "bands", "items",
            )
        )

        def link(group: pd.DataFrame) -> pd.DataFrame:
            rep = group["rep"].to_numpy(np.int64)
            pairs = connecting(
                group["root"].to_numpy(np.int64),
                np.stack(group["bands"].to_numpy()),
                np.frombuffer(b"".join(group["coords"]), np.uint8).reshape(-1, BINS),
                [np.frombuffer(i, np.uint64) for i in group["items"]],
                group["side"].to_numpy(np.int64),
                percent,
            )
            return pd.DataFrame({"a": [rep[i] for i, _ in pairs], "b": [rep[j] for _, j in pairs]}, dtype="int64")

        groups = dealt.groupBy("cluster", "low", "high")
        return scratch.land(groups.applyInPandas(link, "a long, b long"), "minhash-crowd-links")

    def roots(self, members: DataFrame) -> DataFrame:
        """``a``, ``b``: the root of every text linked to another; roots have no row.

        ``members`` has a row per bucket and text, of buckets with two texts or more. First
        every text is compared with that one of its bucket mates which is drawn first, so a
        group of near copies becomes a star, not all of its pairs. What then is left are
        buckets that hold several components: their pairs across components are listed where
        a bucket has FEW texts, and compared in blocks where it has more. In the end every
        pair of a bucket is either in one component or was compared.
        """
        scratch = self.scratch
        centres = members.groupBy(F.col("bucket").alias("of")).agg(F.min(_drawn("rep")).alias("first"))
        mates = (
            members.join(centres, F.col("bucket") == F.col("of"))
            .filter(F.col("first.rep") != F.col("rep"))
            .groupBy(F.col("rep").alias("member"))
            .agg(F.min("first").alias("first"))
        )
        tried = scratch.land(mates.select("member", F.col("first.rep").alias("centre")), "minhash-tried")
        star = components.stars(self.verified(tried), Scratch())  # a scratch each: stars clears its own
        placed = members.join(star, F.col("rep") == F.col("a"), "left").select(
            "bucket", "rep", F.coalesce("b", "rep").alias("root")
        )
        several = (
            placed.groupBy(F.col("bucket").alias("of"))
            .agg(F.count("*").alias("texts"), F.min("root").alias("x"), F.max("root").alias("y"))
            .filter("x < y")
            .select("of", "texts")
        )
        mixed = scratch.land(placed.join(several, F.col("bucket") == F.col("of")).drop("of"), "minhash-mixed")
        some = mixed.filter(F.col("texts") <= FEW)
        other = some.select(F.col("bucket").alias("of"), F.col("rep").alias("y"), F.col("root").alias("y_root"))
        met = some.join(other, (F.col("bucket") == F.col("of")) & (F.col("root") < F.col("y_root")))
        # A pair points to the one drawn first, as those that were tried do.
        first = _drawn("rep") < _drawn("y")
        listed = met.select(
            F.when(first, F.col("y")).otherwise(F.col("rep")).alias("member"),
            F.when(first, F.col("rep")).otherwise(F.col("y")).alias("centre"),
        ).distinct()
        fresh = scratch.land(listed.join(tried, ["member", "centre"], "left_anti"), "minhash-listed")
        crowd = mixed.filter(F.col("texts") > FEW).select("bucket", "rep", "root")
        edges = star.unionByName(self.verified(fresh)).unionByName(self.crowded(crowd))
        return components.stars(edges, Scratch())


def near_duplicates(
    df: DataFrame,
    key: list[str],
    scratch: Scratch,
    text: str = "text",
    shingle: int = 4,
    percent: int = 80,
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component`` of every row: the classes of similar texts.

    Texts link if their sets of distinct word shingles have a Jaccard similarity of at least
    ``percent`` / 100, compared exactly, as counts of common and of all 64-bit shingle hashes.
    A class is what links reach and ``component`` its smallest first key (null if all are
    null). Candidates share a band of their sketches; the chance that a pair at the threshold
    shares none is 5e-8, and it falls above. Equal sets are one node, so copies cost one
    comparison in all. A null, empty or blank text has no shingle, links with nothing and has
    its own key as component; repeated rows with words are in one class. An empty table gives
    no rows. Only the named columns are read, so others may have any name.
    """

    @F.pandas_udf("n long, ident binary, coords binary, bands array<bigint>")
    def sketched(texts: pd.Series) -> pd.DataFrame:
        hashes = _WordHashes()
        sets = [shingle_set(t, shingle, hashes) for t in texts]
        made = _sketched(sets)
        filled = [len(s) > 0 for s in sets]
        return pd.DataFrame(
            {
                "n": [len(s) for s in sets],
                "ident": [xxhash.xxh3_128_digest(s.tobytes()) if f else None for s, f in zip(sets, filled, strict=True)],
                "coords": [c.tobytes() if f else None for c, f in zip(made.astype(np.uint8), filled, strict=True)],
                "bands": [b if f else None for b, f in zip(bands(made), filled, strict=True)],
            }
        )

    @F.pandas_udf("binary")
    def shingles(texts: pd.Series) -> pd.Series:
        hashes = _WordHashes()
        return pd.Series([shingle_set(t, shingle, hashes).tobytes() for t in texts], dtype=object)

    # A text's own name: two hashes, 96 bits.
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    names = [F.xxhash64(whole).alias("name"), F.hash(whole).alias("name2")]
    keys = [F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(key)]
    rows = scratch.land(
        df.select(*keys, *names, sketched(whole).alias("s"))
        .select(*[f"key{i}" for i in range(len(key))], "name", "name2", "s.*")
        .withColumn("rid", F.monotonically_increasing_id()),
        "minhash-rows",
    )
    # Of each different set one row, its representative, goes on.
    classes = scratch.land(
        rows.filter("n > 0").groupBy("ident").agg(F.min("rid").alias("rep"), F.min("key0").alias("least")),
        "minhash-classes",
    )
    chosen = rows.join(classes.select("rep"), F.col("rid") == F.col("rep"), "left_semi")
    dealt = chosen.select(F.explode("bands").alias("bucket"), F.col("rid").alias("rep"))
    shared = dealt.groupBy(F.col("bucket").alias("of")).agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x < y")
    members = scratch.land(dealt.join(shared, F.col("bucket") == F.col("of"), "left_semi"), "minhash-members")
    # Full sets of the texts that share a bucket, from a second scan of the texts.
    wanted = chosen.join(members.select(F.col("rep").alias("of")).distinct(), F.col("rid") == F.col("of"))
    slim = scratch.land(wanted.select(F.col("rid").alias("rep"), "n", "coords", "bands", "name", "name2"), "minhash-slim")
    named = slim.select("name", "name2", "rep").distinct()
    texts = df.select(whole.alias("t"), *names).join(named, ["name", "name2"])
    sets = scratch.land(
        texts.select("rep", shingles("t").alias("items")).groupBy("rep").agg(F.first("items").alias("items")),
        "minhash-sets",
    )
    star = _Links(slim, sets, percent, scratch).roots(members)
    rooted = classes.join(star, F.col("rep") == F.col("a"), "left").select(
        "ident", "least", F.coalesce("b", "rep").alias("root")
    )
    smallest = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component"))
    found = rooted.join(smallest, F.col("root") == F.col("of")).select(F.col("ident").alias("of_ident"), "component")
    return rows.join(found, F.col("ident") == F.col("of_ident"), "left").select(
        *[F.col(f"key{i}").alias(c) for i, c in enumerate(key)],
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key0")).alias("component"),
    )
