"""Hard negatives against brute force over all rows."""

import math

import numpy as np
import pytest

from minutefold.llm import negatives, queries
from minutefold.llm.work import Scratch

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows, every=100, positives=5, top=5, low=80, high=100, scale=256.0):
    live = [
        (i, label, [math.floor(scale * x) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, label, v) in enumerate(live):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), j, m, other) for m, (j, other, w) in enumerate(live) if m != n]
        scored.sort()
        for s, j, _, _ in [r for r in scored if r[3] == label][:positives]:
            found = [r for r in scored if r[3] != label and low * -s <= 100 * -r[0] <= high * -s][:top]
            out += [(i, j, k, r[1], -s, -r[0]) for k, r in enumerate(found, 1)]
    return out


def mined(spark, rows, schema=ROWS, **how):
    found = negatives.mine(spark.createDataFrame(rows, schema).repartition(5), Scratch(), **how)
    return sorted(map(tuple, found.collect()))


def vectors(rng, count, dims=6, labels=4, ids=None):
    points = rng.integers(-3, 4, (count, dims)) / 8 + 0.2  # few values: many ties
    ids = range(count) if ids is None else ids
    return [(int(i), p.tolist(), int(x)) for i, p, x in zip(ids, points, rng.integers(0, labels, count), strict=True)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS_BLOCK", 6 * 70)
    monkeypatch.setattr(negatives, "ANCHORS_BLOCK", 6 * 9)
    monkeypatch.setattr(negatives, "LEAST_BLOCK", 10)
    rows = vectors(np.random.default_rng(seed), 400)
    got = mined(spark, rows, every=20)
    assert got == sorted(plain(rows, every=20))
    assert len(got) > 100


def test_one_label_with_most_rows_and_tied_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [0.5, 0.5], 0 if i % 10 else 1) for i in range(300)]
    rows += [(300 + i, [float(x), 0.5], 2) for i, x in enumerate(rng.uniform(0, 1, 100))]
    assert mined(spark, rows) == sorted(plain(rows))


def test_rows_that_take_no_part_and_equal_rows(spark):
    rng = np.random.default_rng(5)
    rows = vectors(rng, 200)
    rows += [(None, [1.0] * 6, 1), (500, None, 1), (600, [1.0] * 6, None), (700, [1.0, None] + [0.0] * 4, 1)]
    rows += [(800, [float("nan")] + [0.0] * 5, 1), (900, [float("inf")] + [0.0] * 5, 2), (-100, [0.4] * 6, 1)]
    rows += [rows[100], rows[100], (100, rows[3][1], 2), rows[7]]
    assert mined(spark, rows) == sorted(plain(rows))


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.5], 1), (2, [0.0, 1.0], 1), (3, [0.0, 0.2], 2), (4, [-1.0, 0.0], 2), (5, [-0.9, 0.0], 2)]
    got = mined(spark, rows)
    assert got == sorted(plain(rows))
    assert any(r[4] == 0 for r in got)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(6)
    for size in (1e4, 1e6, 4e6):
        rows = [(i, (rng.integers(1, 9, 3) * size / 8).tolist(), int(i % 3)) for i in range(120)]
        assert mined(spark, rows, "vec_id long, embedding array<double>, label int") == sorted(plain(rows))


def test_scores_beyond_64_bits_are_held():
    huge = np.array([[1e200, 1e200], [1.0, 2.0]])
    assert negatives.scores(huge, huge).tolist() == [[2**63 - 1, 2**63 - 1], [2**63 - 1, 5]]
    assert np.isfinite(negatives.quantised(np.array([1e308, -1e308]), 256.0)).all()


def test_keys_sort_as_their_numbers():
    rng = np.random.default_rng(7)
    some = [tuple(int(x) for x in rng.integers(-(2**62), 2**62, 4)) + (int(k),) for k in rng.integers(0, 2, 200)]
    some += [(0, 0, s, i, 1) for s in (5, -5, 0, 2**63 - 1, -(2**63)) for i in (3, -3)]
    by_key = sorted(some, key=lambda r: negatives.packed((r[0], r[1]), r[2], r[4], (r[3], 0)))
    assert by_key == sorted(some, key=lambda r: (r[0], r[1], -r[2], r[4], r[3]))
    assert negatives.unpacked(negatives.packed((-4, 9), -7, 1, (-2, 8))) == ((-4, 9), -7, 1, -2)


def test_query_moves_labels(spark, folder):
    rng = np.random.default_rng(8)
    rows = [(i, v, x * 3) for i, v, x in vectors(rng, 250)] + [(700, None, 3), (800, [0.1] * 6, None)]
    spark.createDataFrame(rows, ROWS).write.parquet(f"{folder}/embeddings.parquet")
    moved = [(i, v, (x + 1) % 10 if x is not None and i % 7 == 0 else x) for i, v, x in rows]
    got = queries.op13_secondary_sort_negatives(spark, folder)
    assert got.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
        ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    # Floats as doubles, as the table holds them.
    as_held = [(i, None if v is None else [float(np.float32(x)) for x in v], x) for i, v, x in moved]
    assert sorted(map(tuple, got.collect())) == sorted(plain(as_held))


def test_empty_table_no_anchor_and_clashing_columns(spark):
    assert mined(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    empty = spark.createDataFrame([], ROWS)
    assert negatives.mine(empty, Scratch()).count() == 0
    schema = "row long, v array<double>, id string, label string, bounds string"
    rows = [(0, [0.5], "a", "x", "b"), (1, [0.5], "a", "x", "b"), (2, [0.45], "a", "y", "b")]
    found = negatives.mine(spark.createDataFrame(rows, schema), Scratch(), key="row", vector="v", label="label")
    assert list(map(tuple, found.collect())) == [(0, 1, 1, 2, 128 * 128, 128 * 115)]
