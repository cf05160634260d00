"""Benchmark decontamination by latent semantic retrieval and checks of what it finds."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutefold.llm.work import Scratch

#: Hashed words: 16 bits as they are looked up, TERMS of them as columns of the matrix. What is
#: found is verified on the words themselves.
TERMS = 1 << 14
#: Words of a passage, a row of the matrix; latent dimensions, and directions drawn beyond them.
PASSAGE, RANK, MORE = 32, 40, 8
#: Lengths of the windows that are looked up, in words; a window begins every quarter of one.
WINDOWS = (4, 8, 16, 32, 64)
#: Words of the shortest stretch that a long item ends in, and of the shortest item that its
#: cosine alone finds: shorter ones are looked up as they stand, too.
SHORT = 16
#: Words handled at a time, candidates, and cosines.
CHUNK, MANY, COSINES = 1 << 15, 1 << 12, 1 << 21
#: Pieces that a partial matrix is sent in.
SLICES = 16

#: No word, and the column of each word.
NONE = 1 << 16
COLUMN = np.append(np.arange(NONE) & (TERMS - 1), TERMS)
#: Directions that a passage is added to.
SIGNS = 4

_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: Signs of scripts that put no spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, Tai,
#: Balinese, Javanese, Yi, kana, Bopomofo, Chinese. And the stops written with them.
_UNSPACED = re.compile(
    "[\u0e01-\u0e3a\u0e40-\u0e4e\u0e50-\u0e59\u0e80-\u0eff\u0f00\u0f18-\u0fff\u1000-\u1049\u1050-\u109f"
    "\u1780-\u17d3\u17d7-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u3035"
    "\u3041-\u309f\u30a1-\u30fa\u30fc-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf\ua980-\ua9df"
    "\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U000323af]"
)
_STOPS = re.compile("[\u0e2f\u0e5a\u0e5b\u0f01-\u0f17\u104a-\u104f\u17d4-\u17d6\u3000-\u3004\u3008-\u3020\u30a0\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_SENTENCE_ENDS = re.compile("[.!?\u3002\uff01\uff0e\uff1f\uff61\u0f0d\u104b\u17d4]")
#: First bytes of the signs above in UTF-8; few texts in other scripts hold any.
_MAY_BE_UNSPACED = re.compile(b"[\xe0\xe1\xe3-\xea\xef\xf0]|\xe2[\xba-\xbf]")


def split_words(text: str | None) -> list[bytes]:
    """The text's words: runs of ASCII letters and digits, A-Z in lower case, and of other signs
    beyond ASCII; each sign of a script without spaces is a word."""
    raw = (text or "").encode()
    if not raw.isascii() and _MAY_BE_UNSPACED.search(raw):
        raw = _UNSPACED.sub(r" \g<0> ", _STOPS.sub(" ", text)).encode()
    return raw.translate(_LOWER).split()


def word_ids(text: str | None) -> np.ndarray:
    """The words hashed to 16 bits."""
    words = split_words(text)
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)).astype(np.uint16)


def lcs(item: list, words: list) -> int:
    """Length of the longest common subsequence, a whole row of the table per word."""
    places: dict = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full = row = (1 << len(item)) - 1
    for w in words:
        hit = places.get(w)
        if hit:
            both = row & hit
            row = ((row + both) | (row - both)) & full
    return len(item) - row.bit_count()


def shares(item: list, answer: list, words: list) -> tuple[float, float]:
    """Of item and answer, how much is in the words in order."""
    return lcs(item, words) / len(item), lcs(answer, words) / len(answer)


def _laid(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end, each filled up with NONE to whole passages; where they begin and end."""
    lengths = np.array([len(t) for t in texts])
    whole = -(-lengths // PASSAGE) * PASSAGE
    first = np.cumsum(whole) - whole
    ids = np.full(whole.sum(), NONE, np.int32)
    for t, at in zip(texts, first.tolist(), strict=True):
        ids[at : at + len(t)] = t
    return ids, first, first + lengths


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Many texts laid out CHUNK words or so at a time, a longer one cut between passages."""
    held, size = [], 0
    for batch in batches:
        for raw in batch["words"]:
            words = np.frombuffer(raw, np.uint16)
            for at in range(0, len(words), CHUNK):
                part = words[at : at + CHUNK]
                if size + len(part) > CHUNK and held:
                    yield _laid(held)
                    held, size = [], 0
                held.append(part)
                size += len(part)
    if held:
        yield _laid(held)


def _sums(table: np.ndarray, column: np.ndarray, wide: int) -> np.ndarray:
    """Rows of the table for each column, added up over runs of ``wide`` (a power of two)."""
    step = min(wide, 4)
    total = np.take(table, column[0::step], axis=0, mode="clip")
    for i in range(1, step):
        total += np.take(table, column[i::step], axis=0, mode="clip")
    while wide > 4:
        total, wide = total[0::2] + total[1::2], wide // 2
    return total


def _rolled(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on."""
    count = max(0, len(ids) - size + 1)
    code = np.zeros(count, np.uint64)
    for i in range(size):
        code = code * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + count].astype(np.uint64)
    return code


def _scale(idf: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Of each passage, one over the root of its words' squared weights."""
    squares = (idf[column] ** 2).reshape(-1, PASSAGE).sum(axis=1)
    return 1 / np.sqrt(np.maximum(squares, 1e-9))


def _summed(parts: DataFrame) -> np.ndarray:
    """Partial arrays of one fixed size, sent in SLICES, added up and put together."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.float64) for p in group["part"])
        return pd.DataFrame({"slice": [group["slice"].iloc[0]], "part": [total.tobytes()]})

    rows = parts.groupBy("slice").applyInPandas(add, "slice int, part binary").collect()
    return np.concatenate([np.frombuffer(r["part"], np.float64) for r in sorted(rows, key=lambda r: r["slice"])] or [np.zeros(0)])


def _sliced(total: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"slice": np.arange(SLICES, dtype=np.int32), "part": [p.tobytes() for p in np.array_split(total.ravel(), SLICES)]})


@dataclass(frozen=True)
class Model:
    """``idf`` by column, and ``fold``: columns to latent dimensions, weighed and scaled."""

    idf: np.ndarray
    fold: np.ndarray


def fit(words: DataFrame) -> Model:
    """Randomised singular value decomposition of the TF-IDF matrix of all passages.

    ``words`` (binary) holds the hashed words of each text. The first pass counts in how many
    passages a term stands. The second draws a random sign per passage and direction and adds
    up the rows under each: an orthonormal basis of the sums nearly spans the leading row
    space. The third projects every passage onto it and sums the squares, whose decomposition
    gives directions and singular values. A passage has signs in SIGNS random directions and
    zeros in the others. Tasks send matrices of a fixed size.
    """
    drawn = RANK + MORE

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(TERMS + 1)
        for ids, _, _ in _chunks(batches):
            passage = np.arange(len(ids)) // PASSAGE
            pairs = np.sort((passage * TERMS + (ids & (TERMS - 1)))[ids != NONE])
            pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])[: len(pairs)]]
            total[:TERMS] += np.bincount(pairs % TERMS, minlength=TERMS)
            total[TERMS] += len(ids) // PASSAGE
        yield _sliced(total)

    counted = _summed(words.mapInPandas(count, "slice int, part binary"))
    if not len(counted) or not counted[TERMS]:
        return Model(np.zeros(TERMS + 1, np.float32), np.zeros((TERMS + 1, RANK), np.float32))
    idf = np.log((counted[TERMS] + 1) / (counted[:TERMS] + 1)).astype(np.float32) + np.float32(0.05)
    idf = np.append(idf, np.float32(0))  # of no word

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((TERMS + 1, drawn))
        for ids, _, _ in _chunks(batches):
            column = COLUMN[ids]
            weight = idf[column] * np.repeat(_scale(idf, column), PASSAGE)
            # Seeded by the words, so that a repeated task draws the same signs.
            rng = np.random.default_rng(zlib.crc32(ids.tobytes()))
            for _ in range(SIGNS):
                direction = np.repeat(rng.integers(0, drawn, len(ids) // PASSAGE), PASSAGE)
                sign = np.repeat(rng.integers(0, 2, len(ids) // PASSAGE) * 2 - 1, PASSAGE)
                np.add.at(total.reshape(-1), column * drawn + direction, weight * sign)
        total = total[:TERMS]
        yield _sliced(total)

    sums = _summed(words.mapInPandas(sketch, "slice int, part binary")).reshape(TERMS, drawn)
    basis, _ = np.linalg.qr(sums)
    weighed = (np.append(basis, np.zeros((1, drawn)), axis=0) * idf[:, None]).astype(np.float32)

    def squares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((drawn, drawn))
        for ids, _, _ in _chunks(batches):
            column = COLUMN[ids]
            rows = _sums(weighed, column, PASSAGE) * _scale(idf, column)[:, None]
            total += rows.T @ rows
        yield _sliced(total)

    gram = _summed(words.mapInPandas(squares, "slice int, part binary")).reshape(drawn, drawn)
    values, vectors = np.linalg.eigh(gram)
    leading = np.argsort(-values)[:RANK]
    scale = 1 / np.sqrt(np.maximum(values[leading], values.max() * 1e-9))
    return Model(idf, (weighed @ (vectors[:, leading] * scale)).astype(np.float32))


@dataclass(frozen=True)
class Probe:
    """A stretch of an item that windows are compared with."""

    item: int
    offset: int
    words: np.ndarray


def _probes(items: list[np.ndarray]) -> dict[int, list[Probe]]:
    """Probes by the length of the windows that are nearest to theirs.

    An item of more than one and a half of the longest window is probed in stretches.
    """
    found: dict[int, list[Probe]] = {w: [] for w in WINDOWS}
    longest = WINDOWS[-1]
    for number, words in enumerate(items):
        stretch = len(words) if len(words) <= longest * 3 // 2 else longest
        for at in range(0, len(words), max(1, stretch)):
            part = words[at : at + stretch]
            if at and len(part) < SHORT:
                continue  # the end of a long item is covered by the check of the whole
            wide = min(WINDOWS, key=lambda w: abs(np.log(w / len(part))))
            found[wide].append(Probe(number, at, part))
    return found


def contaminated(
    df: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    key: list[str],
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    cosine: float = 0.5,
    least: float = 0.7,
    answer: float = 0.6,
    sure: float = 0.9,
) -> DataFrame:
    """``key``, ``item``, ``overlap``, ``answer_overlap`` and ``cosine``, a row per text and item in it.

    Every window of every text is compared in the latent space with every item's probe of
    its length; windows with a cosine of at least ``cosine`` are candidates. A candidate is
    contaminated if the longest common subsequence of the item's words and the text around
    the window has at least ``least`` of the item, and that of the item's answer - its last
    sentences, as many as have five words, or its last five words if it has one sentence - at
    least ``answer`` of the answer. At least ``sure`` of the item needs no answer. An item of
    fewer than SHORT words that stands in a text word by word is found whatever its cosine,
    which is then given as that of the words themselves, 1. All of this is looked up with
    hashed words; then every place that was found is checked on the words of text and item.

    ``items`` is the benchmark, of a size that fits a task. A null or wordless text or item
    matches nothing. Repeated rows give repeated results, as do items of equal texts; an
    empty table gives no rows. Only the named columns are read, so others may have any name.
    """
    listed = items.select(F.col(f"`{item_key}`").alias("k"), F.col(f"`{item_text}`").alias("t")).filter("t is not null")
    found = sorted(listed.collect(), key=lambda r: (str(r["k"]), r["t"]))
    item_words = [word_ids(r["t"]) for r in found]
    found, item_words = [f for f, w in zip(found, item_words, strict=True) if len(w)], [w for w in item_words if len(w)]
    true_words, true_answers = [split_words(r["t"]) for r in found], [_answer(r["t"]) for r in found]
    answers = [np.fromiter(map(zlib.crc32, a), np.uint32, len(a)).astype(np.uint16) for a in true_answers]
    names_of = [None if r["k"] is None else str(r["k"]) for r in found]

    @F.pandas_udf("binary")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([word_ids(t).tobytes() for t in texts], dtype=object)

    # A text's own name: two hashes, 96 bits.
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own_name = [F.xxhash64(whole).alias("name"), F.hash(whole).alias("name2")]
    rows = scratch.land(
        df.select(
            *[F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(key)], *own_name, hashed(whole).alias("words")
        ),
        "decontam-words",
    )
    model = fit(rows.select("words"))
    probes = _probes(item_words)
    embedded = {}
    for wide, some in probes.items():
        made = np.array([model.fold[p.words & np.uint16(TERMS - 1)].sum(axis=0) for p in some]).reshape(-1, RANK)
        embedded[wide] = (made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    # Words of any item by number, 0 for all others. Per probe: the place of each among its
    # different words (the last: not in it), and how often it has it.
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint16), *item_words]))
    numbered = np.zeros(NONE + 1, np.int16 if len(vocabulary) < 1 << 15 else np.int32)
    numbered[vocabulary] = np.arange(1, len(vocabulary) + 1)
    most = max([len(w) for w in item_words], default=0) + 1
    places, times = {}, {}
    for wide, some in probes.items():
        places[wide] = np.full((len(some), len(vocabulary) + 1), most - 1, np.int16)
        times[wide] = np.zeros((len(some), most), np.int16)
        for i, p in enumerate(some):
            own, count = np.unique(p.words, return_counts=True)
            places[wide][i, numbered[own]] = np.arange(len(own))
            times[wide][i, : len(own)] = count
    sizes = {wide: np.array([len(p.words) for p in some]) for wide, some in probes.items()}

    def candidates(ids: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        """Per length of windows: start, text, probe and cosine of those that may match.

        Windows begin every quarter of their length and may reach over into the next text;
        only words of the text they begin in count later on.
        """
        column = COLUMN[np.append(ids, np.full(WINDOWS[-1], NONE))]
        for wide, some in probes.items():
            if not some:
                continue
            quarters = _sums(model.fold, column, wide // 4)
            window = quarters[:-3] + quarters[1:-2] + quarters[2:-1] + quarters[3:]
            length = np.sqrt(np.einsum("ij,ij->i", window, window))
            # The words from half a window before each place on, twice as many as a window has.
            filled = np.concatenate([np.zeros(wide // 2, numbered.dtype), numbered[ids], np.zeros(2 * wide, numbered.dtype)])
            around = np.lib.stride_tricks.sliding_window_view(filled, 2 * wide)
            step = max(1, COSINES // len(some))
            for first_window in range(0, len(window), step):
                near = window[first_window : first_window + step] @ embedded[wide].T
                norm = length[first_window : first_window + step]
                found = np.flatnonzero(near >= np.where(norm > 0, cosine * norm, np.inf)[:, None].astype(np.float32))
                for low in range(0, len(found), MANY):
                    w, p = np.divmod(found[low : low + MANY], len(some))
                    start = (first_window + w) * (wide // 4)
                    value = near.ravel()[found[low : low + MANY]]
                    # No more can be in common than words that both have, as often as both do.
                    place = places[wide][p[:, None], around[start]] + (np.arange(len(p), dtype=np.int32) * most)[:, None]
                    has = np.bincount(place.ravel(), minlength=len(p) * most).reshape(-1, most)
                    may = np.minimum(has, times[wide][p]).sum(axis=1) >= least * sizes[wide][p]
                    start = start[may]
                    text = np.searchsorted(first, start, side="right") - 1
                    yield wide, start, text, p[may], value[may] / norm[w[may]]

    # Items of few words as they stand: per length, their distinct rows of words in the order of
    # a hash, and which items have them.
    standing: dict[int, tuple[np.ndarray, np.ndarray, list[list[int]]]] = {}
    for size in sorted({len(w) for w in item_words if len(w) < SHORT}):
        having: dict[tuple, list[int]] = {}
        for number, words in enumerate(item_words):
            if len(words) == size:
                having.setdefault(tuple(words.tolist()), []).append(number)
        table = np.array(list(having), np.int32)
        codes = _rolled(table.ravel(), size)[::size]
        order = np.argsort(codes, kind="stable")
        standing[size] = codes[order], table[order], [list(having.values())[i] for i in order.tolist()]

    def verbatim(ids: np.ndarray, first: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """(text, item) of items of few words that stand in a text word by word."""
        for size, (codes, table, having) in standing.items():
            code = _rolled(ids, size)
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            start = np.flatnonzero(codes[at] == code)
            text = np.searchsorted(first, start, side="right") - 1
            same = (ids[start[:, None] + np.arange(size)] == table[at[start]]).all(axis=1) & (start + size <= ends[text])
            for pair in np.unique(text[same] * len(table) + at[start[same]]).tolist():
                for number in having[pair % len(table)]:
                    yield pair // len(table), number

    def look_up(ids: np.ndarray, first: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], list[tuple]]:
        """(text, item) to the places where the item may be: first word, end, cosine; and whether
        it stands there word by word, wherever that is."""
        out: dict[tuple[int, int], list[tuple]] = {pair: [(-1, -1, 1.0)] for pair in verbatim(ids, first, ends)}
        whole_ones = set()
        for wide, starts, texts, found_probes, near in candidates(ids, first):
            some = probes[wide]
            for s, t, probe, c in zip(starts.tolist(), texts.tolist(), found_probes.tolist(), near.tolist(), strict=True):
                number, offset = some[probe].item, some[probe].offset
                if (t, number) in whole_ones:
                    continue
                low = max(first[t], s - offset - wide // 2)
                high = min(ends[t], s - offset + max(wide, len(item_words[number])) + wide // 2)
                share, kept = shares(item_words[number].tolist(), answers[number].tolist(), ids[low:high].tolist())
                if share >= least and (kept >= answer or share >= sure):
                    out.setdefault((t, number), []).append((int(low - first[t]), int(high - first[t]), float(c)))
                    if share == 1.0 and len(item_words[number]) >= 4:
                        whole_ones.add((t, number))  # 64 bits and more are equal: no other place is better
        return out

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        overlap = 4 * WINDOWS[-1] + max([len(w) for w in item_words], default=0)
        for batch in batches:
            places: dict[tuple[int, int], list[tuple]] = {}
            held, parts, size = [], [], 0

            def flush(held: list, parts: list, places: dict) -> None:
                if held:
                    for (t, number), found in look_up(*_laid(held)).items():
                        row, at = parts[t]
                        moved = [(low, high, c) if low < 0 else (low + at, high + at, c) for low, high, c in found]
                        places.setdefault((row, number), []).extend(moved)

            for i, raw in enumerate(batch["words"]):
                words = np.frombuffer(raw, np.uint16)
                # Parts of a long text overlap, so that no item is cut.
                for at in range(0, len(words), CHUNK):
                    part = words[at : at + CHUNK + overlap]
                    if size + len(part) > CHUNK:
                        flush(held, parts, places)
                        held, parts, size = [], [], 0
                    held.append(part)
                    parts.append((i, at))
                    size += len(part)
            flush(held, parts, places)
            hits = sorted(places)
            out = batch[carried].iloc[[i for i, _ in hits]].reset_index(drop=True)
            out["item"] = pd.Series([names_of[n] for _, n in hits], dtype=object)
            out["number"] = pd.Series([n for _, n in hits], dtype="int32")
            out["places"] = pd.Series([[[float(x) for x in p] for p in sorted(set(places[h]))] for h in hits], dtype=object)
            yield out

    def verified(text: str, number: int, places: list) -> tuple[float, float, float] | None:
        """The best of the places by the words themselves."""
        words, item, own = split_words(text), true_words[number], true_answers[number]
        best = None
        for low, high, c in places:
            if low < 0:
                joined = b" ".join([b"", *words, b""])
                found = (1.0, 1.0, 1.0) if b" ".join([b"", *item, b""]) in joined else (0.0, 0.0, 0.0)
            else:
                found = (*shares(item, own, words[int(low) : int(high)]), c)
            if found[0] >= least and (found[1] >= answer or found[0] >= sure):
                best = max(best or found, found)
        return best

    @F.pandas_udf("array<double>")
    def check(texts: pd.Series, numbers: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([verified(t, n, p) for t, n, p in zip(texts, numbers, places, strict=True)], dtype=object)

    types = dict(rows.dtypes)
    carried = [*[f"key{i}" for i in range(len(key))], "name", "name2"]
    fields = [f"{c} {types[c]}" for c in carried]
    hits = scratch.land(
        rows.mapInPandas(search, ", ".join([*fields, "item string, number int, places array<array<double>>"])), "decontam-hits"
    )
    # Each different text that was hit comes once, from a second scan.
    names = hits.select("name", "name2").distinct()
    texts = df.select(whole.alias("t"), *own_name).join(names, ["name", "name2"]).dropDuplicates(["name", "name2"])
    found = (
        hits.join(texts, ["name", "name2"])
        .withColumn("found", check("t", "number", "places"))
        .select(*carried, "item", "found")
    )
    kept = scratch.land(found.filter("found IS NOT NULL"), "decontam-found")
    return kept.select(
        *[F.col(f"key{i}").alias(c) for i, c in enumerate(key)],
        F.col("item").cast(items.schema[item_key].dataType if item_key in items.columns else T.StringType()).alias("item"),
        F.col("found")[0].alias("overlap"),
        F.col("found")[1].alias("answer_overlap"),
        F.col("found")[2].alias("cosine"),
    )


def _answer(text: str) -> list[bytes]:
    """Words of the last sentences, as many as have five words; the last five of a text of one."""
    sentences = [w for w in (split_words(s) for s in _SENTENCE_ENDS.split(text)) if w]
    if len(sentences) == 1:
        return sentences[0][-5:]
    words = sentences.pop()
    while sentences and len(words) < 5:
        words = sentences.pop() + words
    return words
