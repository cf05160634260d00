"""Decontamination: planted items are found, clean texts are left alone."""

import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from minutefold.llm import decontam, queries
from minutefold.llm.work import Scratch

SF = "/root/testdata/sf0.01"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


@given(st.lists(st.integers(0, 4), max_size=80), st.lists(st.integers(0, 4), max_size=40))
def test_longest_common_subsequence(a, b):
    assert decontam.lcs(a, b) == plain_lcs(a, b)


def test_words():
    assert len(decontam.word_ids(None)) == len(decontam.word_ids(" .,\n")) == 0
    assert (decontam.word_ids("The, CAT's") == decontam.word_ids("the cat S")).all()


def test_query_finds_what_is_planted_and_nothing_else(spark):
    low = lambda t: " ".join(t.lower().split())
    items = [(r.item_id, low(r.text)) for r in queries.table(spark, SF, "benchmark").collect()]
    want = {(r.doc_id, i) for r in queries.table(spark, SF, "documents").collect() for i, t in items if t in low(r.text)}
    got = {(r.doc_id, r.item_id) for r in queries.op4_latent_decontamination(spark, SF).collect()}
    assert want and got == want


def altered(rng, words, share):
    return [rng.choice(["quite", "other", "term"]) if rng.random() < share else w for w in words]


def test_paraphrases_long_texts_and_odd_rows(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l", "")]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: text(n) for i, n in enumerate([16, 25, 40, 70, 300])}
    docs = [(1000 + i, " ".join(text(rng.randint(1, 300))), "x") for i in range(150)]
    for i, words in items.items():
        docs.append((i, " ".join(text(50) + words + text(60)), "x"))
        docs.append((10 + i, " ".join(text(7) + altered(rng, words[:-5], 0.1) + words[-5:] + text(3)), "x"))
        docs.append((20 + i, " ".join(words).upper().replace(" ", " ,\n"), "x"))
        docs.append((30 + i, " ".join(words[: len(words) // 3]), "x"))
    docs.append((40, " ".join(text(70_000) + items[1] + text(70_000) + items[3]), "x"))
    docs += [(50, None, "x"), (51, "", "x"), (52, "...", "x"), (0, docs[150][1], "x"), (None, " ".join(items[2]), "x")]
    bench = [(i, " ".join(w)) for i, w in items.items()] + [(90, None), (91, "?!"), (None, "")]
    found = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string, item string"),
        spark.createDataFrame(bench, "item_id long, text string"),
        Scratch(),
        ["doc_id"],
    ).collect()
    got = sorted((str(r.doc_id), r.item) for r in found)
    want = [(str(base + i), i) for i in items for base in (0, 10, 20)] + [("40", 1), ("40", 3), ("0", 0), ("None", 2)]
    assert got == sorted(want)


def test_a_short_last_sentence_does_not_veto_a_copy(spark):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l", "")]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: text(n) for i, n in enumerate([17, 25, 40, 59])}
    # The last sentence has one word, or two; a full sentence of six words stands before it.
    ends = {i: 1 + i % 2 for i in items}
    written = {i: " ".join(w[: -6 - ends[i]]) + ". " + " ".join(w[-6 - ends[i] : -ends[i]]) + ". " + " ".join(w[-ends[i] :]) + "." for i, w in items.items()}
    docs = [(1000 + i, " ".join(text(rng.randint(1, 300)))) for i in range(150)]
    for i, words in items.items():
        docs.append((i, " ".join(text(40) + words[:-1] + ["changed"] + text(50))))
        docs.append((10 + i, " ".join(text(40) + words[: -ends[i]])))
        docs.append((20 + i, " ".join(text(9) + altered(rng, words[:-8], 0.1) + words[-8:-1] + ["changed"] + text(9))))
        docs.append((30 + i, " ".join(text(9) + words[: len(words) * 3 // 4] + altered(rng, words[len(words) * 3 // 4 :], 1) + text(9))))
    found = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(list(written.items()), "item_id long, text string"),
        Scratch(),
        ["doc_id"],
    ).collect()
    # A changed answer of a whole sentence still speaks against a copy.
    want = [(base + i, i) for i in items for base in (0, 10, 20)]
    assert [r for r in want if r not in {(f.doc_id, f.item) for f in found}] == []
    assert not {f.doc_id for f in found if f.doc_id >= 30}
    assert [len(decontam._answer(t)) for t in ("a b. c d e. f g.", "a b c d e f", "a. b", "a b c d e f g. h i j k l m")] == [5, 5, 2, 6]


def test_short_items_and_scripts_without_spaces(spark):
    rng = random.Random(7)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l", "")]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    signs = lambda n: "".join(chr(rng.randint(0x4E00, 0x4FFF)) for _ in range(n))
    bench = {i: " ".join(["zo", "qua", *text(i)][:i]) for i in range(1, 16)}
    bench |= {40: signs(9) + "。" + signs(8) + "？", 41: "ประเทศไทยมีเมืองหลวงชื่ออะไร", 42: "日本の首都はどこですか。", 43: "𠮷野家"}
    docs = [(1000 + i, " ".join(text(rng.randint(1, 300)))) for i in range(100)] + [(2000 + i, signs(200)) for i in range(30)]
    for i, t in bench.items():
        near = (lambda n: " ".join(text(n))) if i < 40 else signs
        docs.append((i, near(90) + " " * (i < 40) + t + " " * (i < 40) + near(90)))
    docs.append((100, " ".join(text(40) + bench[10].split()[:4] + ["other"] + bench[10].split()[5:] + text(40))))
    found = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([*bench.items(), (50, bench[7])], "item_id long, text string"),
        Scratch(),
        ["doc_id"],
    ).collect()
    got = {(r.doc_id, r.item) for r in found}
    # The item of one word is the first word of the others.
    want = {(i, i) for i in bench} | {(7, 50), (100, 10)} | {(i, 1) for i in [*range(1, 16), 100]} | {(i, 2) for i in [*range(2, 16), 100]}
    assert want <= got and got - want == set()
    assert len(decontam.word_ids("東京 Tokyo、ไทย!")) == 6


def test_a_short_item_does_not_reach_over_into_the_next_text(spark):
    docs = [(1, " ".join(["x"] * 30 + ["alpha", "beta"])), (2, "gamma delta " + " ".join(["y"] * 40))]
    found = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").coalesce(1),
        spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string"),
        Scratch(),
        ["doc_id"],
    )
    assert found.count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.contaminated(none, bench, Scratch(), ["doc_id"]).count() == 0
    some = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    assert decontam.contaminated(some, bench.limit(0), Scratch(), ["doc_id"]).count() == 0


def test_decomposition_spans_the_leading_directions(spark):
    rng = np.random.default_rng(0)
    topics = rng.integers(0, 1 << 16, (4, 12))
    rows = [(rng.choice(topics[i % 4], 200).astype(np.uint16).tobytes(),) for i in range(200)]
    model = decontam.fit(spark.createDataFrame(rows, "words binary"))

    def embed(words):
        x = model.fold[words & (decontam.TERMS - 1)].sum(axis=0)[:4]  # as many as topics
        return x / np.linalg.norm(x)

    same = embed(rng.choice(topics[0], 400)) @ embed(rng.choice(topics[0], 400))
    other = embed(rng.choice(topics[0], 400)) @ embed(rng.choice(topics[1], 400))
    assert same > 0.9 and abs(other) < 0.5


def test_words_of_equal_hashes_are_told_apart(spark):
    """Of 16-bit hashes many words share one; none of these texts holds an item."""
    by_hash, pairs = {}, []
    for i in range(200_000):
        code = int(decontam.word_ids(f"w{i}")[0])
        if code in by_hash and len(pairs) < 60:
            pairs.append((by_hash.pop(code), f"w{i}"))
        else:
            by_hash.setdefault(code, f"w{i}")
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert ("w94", "w6800") in pairs
    items = [(1, a[0]), (2, " ".join(a[:3])), (3, " ".join(a[:20])), (4, " ".join(a))]
    texts = [b[0], " ".join(b[:3]), " ".join(b[:20]), " ".join(b), "x w6800 y", " ".join(a), f"x {a[0]} y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontam.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), Scratch(), ["doc_id"])
    assert {(r.doc_id, r.item) for r in found.collect()} == {(5, 1), (5, 2), (5, 3), (5, 4), (6, 1)}


def test_an_item_behind_a_false_place_is_found(spark):
    """A place that only hashes agree on does not hide the true one further on."""
    rng = random.Random(9)
    words = [f"v{rng.randrange(10**6)}" for _ in range(24)]
    text = ["lead"] * 50 + words[:12] + ["gap"] * 400 + words + ["tail"] * 70_000
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(text[:60]))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    found = decontam.contaminated(docs, items, Scratch(), ["doc_id"]).collect()
    assert [(r.doc_id, r.item, r.overlap) for r in found] == [(1, 7, 1.0)]
