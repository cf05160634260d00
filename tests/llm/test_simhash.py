"""SimHash against a plain rendering of its definition and all pairs of a small table."""

import re

import numpy as np
import pytest
import xxhash

from minutefold.llm import components, queries, simhash
from minutefold.llm.work import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text, shingle=3):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(count)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > count)


def plain_classes(values, radius):
    """Smallest index reachable over pairs of values within the radius."""
    found = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = found[i], found[j]
                found = [min(a, b) if f in (a, b) else f for f in found]
    return found


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "One", "one two TWO Ünï", "a b c", "A b\x0bC d \x0c d d", "x y " * 90_000]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) % 2**64 == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4])
def test_links_connect_what_all_pairs_connect(spark, radius):
    rng = np.random.default_rng(radius)
    values = [0]
    for v in rng.integers(0, 2**64, 30, dtype=np.uint64).tolist():
        values.append(v)
        for _ in range(6):
            for b in rng.choice(64, rng.integers(1, 5), replace=False).tolist():
                v ^= 1 << b
            values.append(v)
    values = list(dict.fromkeys(values))
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    scratch = Scratch()
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), radius, scratch).collect()
    number = {s[0]: i for i, s in enumerate(signed)}
    found = list(range(len(values)))
    for e in edges:
        assert (values[number[e.a]] ^ values[number[e.b]]).bit_count() <= radius
        a, b = found[number[e.a]], found[number[e.b]]
        found = [min(a, b) if f in (a, b) else f for f in found]
    assert found == plain_classes(values, radius)
    scratch.drop()


def test_every_pair_within_the_radius_has_a_common_variant():
    rng = np.random.default_rng(1)
    for radius in (1, 2, 3):
        masks, inner = simhash.ball_masks(radius)
        for _ in range(300):
            a = int(rng.integers(0, 2**63))
            b = a
            for bit in rng.choice(64, rng.integers(1, radius + 1), replace=False).tolist():
                b ^= 1 << bit

            def ball(v):
                return {v ^ m for m in (masks if v.bit_count() % 2 else masks[:inner]).tolist()}

            assert ball(a) & ball(b)


def test_query(spark, folder):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words, 80)) for _ in range(8)]
    texts = base + [b.replace(" ", "\n", 3).upper() for b in base] + [b + " end" for b in base] + [None, "", " ", "w1", "w1"]
    rows = [(100 - i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, "w1", "en", "s", 0), (3, base[0], "", "", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    got = queries.op1_simhash(spark, folder).collect()
    prints = [plain_fingerprint(r[1]) for r in rows]
    classes = plain_classes(prints, 3)
    least = {}
    for c, r in zip(classes, rows, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = [(r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, classes, strict=True)]
    assert sorted(map(str, (tuple(g) for g in got))) == sorted(map(str, want))


def test_empty_table(spark, folder):
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    assert queries.op1_simhash(spark, folder).count() == 0


def test_stars_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 200), (250, 300)]
    scratch = Scratch()
    got = {r.a: r.b for r in components.stars(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)} | {300: 200, 250: 200}
    assert got == want
    scratch.drop()
