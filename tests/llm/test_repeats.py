"""Repeated strings against a dictionary of every window."""

import hashlib

import numpy as np
import pytest

from minutefold.llm import queries, repeats
from minutefold.llm.work import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def by_windows(rows, least=100):
    """Rows as (key, text), in order of key, then of a hash of the text."""
    order = sorted(
        range(len(rows)),
        key=lambda i: (2**63 - 1 if rows[i][0] is None else rows[i][0], int(hashlib.sha256((rows[i][1] or "").encode()).hexdigest()[:15], 16)),
    )
    seen, out = set(), [None] * len(rows)
    for i in order:
        raw = (rows[i][1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - least + 1):
            window = raw[s : s + least]
            if window in seen:
                gone[s : s + least] = True
            seen.add(window)
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[i] = (rows[i][0], len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(map(str, out))


def cases():
    rng = np.random.default_rng(2)
    word = lambda n: " ".join("".join(rng.choice(list("abcdeé"), rng.integers(2, 8))) for _ in range(n))
    passage, longer = word(25), word(400)
    rows = [(i, word(int(rng.integers(5, 90)))) for i in range(40)]
    rows += [(100 + i, f"{word(8)} {passage} {word(9)}") for i in range(30)]  # one passage, many surroundings
    rows += [(300 + i, longer[:900] + word(3) + longer[900:]) for i in range(6)]  # near copies
    rows += [(50 - i, longer) for i in range(5)] + [(400, "ab" * 700), (401, "x" * 1000), (402, "x" * 99), (403, "x" * 100)]
    rows += [(404, None), (405, ""), (406, passage[:99]), (None, longer), (None, passage), (300, word(40) + longer), (7, longer), (7, longer)]
    rows += [(500, passage[:101]), (501, "\0" * 150 + passage), (502, passage + "\0" * 150)]
    return rows


@pytest.mark.parametrize("crowded", [4000, 3])
def test_query_as_every_window_says(spark, folder, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    monkeypatch.setattr(repeats, "BUCKET_PIECES", 200)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    rows = cases()
    spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    got = queries.op5_repeated_strings(spark, folder).collect()
    assert sorted(str(tuple(r)) for r in got) == by_windows(rows)


def test_texts_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PLACE_BITS", 11)
    monkeypatch.setattr(repeats, "BLOCK", 1 << 11)
    monkeypatch.setattr(repeats, "_POWERS", {})
    rng = np.random.default_rng(4)
    text = "".join(rng.choice(list("abcd "), 9000))
    rows = [(1, text), (2, text[500:7000] + "!" + text[7000:]), (3, "z" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = repeats.remove_repeats(df, "doc_id", Scratch(), with_text=True).collect()
    assert sorted(str(tuple(r)[:5]) for r in out) == by_windows(rows)
    for r in out:
        assert hashlib.sha256(bytes(r.kept or b"")).hexdigest() == r.kept_sha256 or r.n_removed == 0


def test_classes_of_random_pieces():
    rng = np.random.default_rng(0)
    for least in (5, 8, 10, 13, 20):
        raw = np.concatenate([np.append(rng.integers(1, 3, rng.integers(1, 60)), 0) for _ in range(60)]).astype(np.uint8)
        found, want, got = repeats.expand(raw, least), {}, {}
        for i in range(len(raw) - least + 1):
            if 0 not in raw[i : i + least]:
                want.setdefault(raw[i : i + least].tobytes(), []).append(i)
        for i in np.flatnonzero(found >= 0):
            got.setdefault(found[i], []).append(i)
        assert sorted(got.values()) == sorted(v for v in want.values() if len(v) > 1)


def test_empty_table(spark, folder):
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    assert queries.op5_repeated_strings(spark, folder).count() == 0
