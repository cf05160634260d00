"""HNSW shards against brute force."""

import numpy as np
import pytest

from minutefold.llm import ann, queries
from minutefold.llm.work import Scratch


def exact(rows, every=20, top=20):
    kept = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for i, v in kept:
        if i % every == 0:
            near = sorted(((-float(v @ w), j) for j, w in kept if j != i))
            out[i] = [(j, -s) for s, j in near[:top]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({j for j, _ in got[q]} & {j for j, _ in w}) / len(w) for q, w in want.items()])


@pytest.mark.parametrize("unequal", [False, True])
def test_recall_over_several_shards(spark, monkeypatch, unequal):
    monkeypatch.setattr(ann, "SHARD", 700)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 24))
    vectors = centres[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 24))
    if unequal:
        vectors *= rng.uniform(0.2, 3, (2000, 1))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want, got = exact(rows), found(ann.nearest(df, Scratch()))
    assert recall(got, want) >= 0.9
    for q, hits in got.items():
        assert len(hits) == 20 and all(j != q for j, _ in hits)
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        for j, s in hits:
            assert s == pytest.approx(float(np.array(rows[q][1]) @ np.array(rows[j][1])), rel=1e-12)


@pytest.mark.parametrize("longest", [1e4, 1e36])
def test_one_long_vector_and_one_of_another_size(spark, longest):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(2000, 24))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[7] *= longest
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows[0] = (0, [1.0, 2.0, 3.0])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want, got = exact(rows[1:]), found(ann.nearest(df, Scratch()))
    assert set(got) == set(want)
    assert recall(got, want) >= 0.9


def test_equal_vectors_go_by_key_and_odd_ones_stay_out(spark):
    good = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.0, 1.0]), (101, [-1.0, 0.0])]
    odd = [(200, None), (220, [0.0, 0.0]), (240, [None, 1.0]), (260, [float("nan"), 1.0]), (280, [float("inf"), 1.0]), (300, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as v")
    got = found(ann.nearest(df, Scratch()))
    want = exact(good)
    assert set(got) == {0, 20, 40, 100}
    assert {q: [j for j, _ in h] for q, h in got.items()} == {q: [j for j, _ in h] for q, h in want.items()}


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (7, [2.0, 1.0])]])
def test_few_rows(spark, folder, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int" if not rows else "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    got = queries.op6_hnsw_shards(spark, folder).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == ([(0, 1, 7, 4.0)] if len(rows) == 2 else [])


def test_queries_of_one_key_keep_their_own_neighbours(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1, 200)]
    twins = [(20, rng.normal(size=8).tolist()), (20, rng.normal(size=8).tolist())]
    rows = [r for r in rows if r[0] != 20] + twins + [(40, rows[39][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, Scratch()).collect():
        got.setdefault((r.query_id, r.rank), []).append((r.vec_id, round(r.score, 9)))
    for query in (20, 40):
        own = [v for i, v in rows if i == query]
        lists = []
        for v in own:
            scored = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != query)
            lists.append([(i, round(-s, 9)) for s, i in scored[:20]])
        for rank in range(1, 21):
            assert sorted(got[query, rank]) == sorted(found[rank - 1] for found in lists)
        assert (query, 21) not in got
