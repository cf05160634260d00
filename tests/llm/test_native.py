"""The operators built from SQL expressions alone, against plain Python."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from minutefold.llm import chat, mixing, pii, queries, sharding
from minutefold.llm.work import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, folder):
    spark.createDataFrame(rows, DOCS).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return folder


def as_rows(texts, source="a"):
    return [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]


# Personal data ---------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    turned = [int(d) for d in reversed(digits)]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(turned)) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def by_re(text):
    found = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if passes(kind, m.group()):
                found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(f[2] for f in sorted(found))


TEXTS = [
    "",
    None,
    "write to a.b@c.de or x@y, x@y.z_q@r.st. é🙂 me@host.example",
    "@a.b a@b.c@d.e a@b..c a@b.c.",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.02.003.4 1.2.3 99999999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 12 3 4111  1111",
    "+1 (743) 555-3824 +49 30 1234567 +12 +1+2345678901 +1.2.3.4.5.6.7.8.9",
    "🙂🙂 +1 (743) 555-3824🙂4111111111111111🙂1.2.3.4",
    "x" * 50_000 + "@" + "a." * 20_000 + "b " + "1" * 40_000,
    "1.2.3.4 " * 700,
    "DE89 3704 0044 0532 0130 00 and DE89370400440532013001 GB82WEST12345698765432",
]


def test_pii_as_plain_patterns_find(spark, folder):
    found = queries.op7_pii(spark, documents(spark, as_rows(TEXTS), folder)).collect()
    assert len(found) == len(TEXTS)
    for row in found:
        want = by_re(TEXTS[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        base = [s for s in row.spans.split(",") if s.split(":")[0] in PLAIN]
        assert ",".join(base) == want
        assert row.n_ip == sum(s.startswith("ip:") for s in base)


def test_pii_added_kinds_need_their_checksum(spark):
    df = spark.createDataFrame(
        [
            (1, "bank DE89 3704 0044 0532 0130 00 x"),
            (2, "bank DE89370400440532013001"),
            (3, "GB82WEST12345698765432"),
            (4, "ssn 219-09-9999"),
            (5, "part 219-09-9999"),
        ],
        "id long, text string",
    )
    spans = {r.id: [(s.kind, s.s, s.e) for s in r.spans if not s.base] for r in pii.find_pii(df, ["id"]).collect()}
    assert spans == {1: [("iban", 5, 32)], 2: [], 3: [("iban", 0, 22)], 4: [("ssn", 4, 15)], 5: []}


def test_account_codes_end_at_their_length(spark):
    texts = {
        "AT611904300234573201 Wien": (0, 20),
        "ES91 2100 0418 4502 0005 1332 BIC CAIX": (0, 29),
        "BE68 5390 0754 7034 2024 ": (0, 19),
        "bank BE68 5390 0754 7034 AT611904300234573201": (5, 24),
        "NO93 8601 1117 947 MT84MALT011000012345MTLCAST001S": (0, 18),
        "LC55 HEMM 0001 0001 0012 0012 0002 3015 NEXT": (0, 39),
        "ES91 2100 0418 4502 0005 1333 BIC": None,
        "ES91 2100 0418 4502 0005 1332BIC": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.text: [(s.s, s.e) for s in r.spans if s.kind == "iban"] for r in pii.find_pii(df, ["text"]).collect()}
    assert {t: s[0] if s else None for t, s in found.items()} == texts
    assert len(found["bank BE68 5390 0754 7034 AT611904300234573201"]) == 2
    assert len(found["NO93 8601 1117 947 MT84MALT011000012345MTLCAST001S"]) == 2


def test_context_words_raise_the_score(spark):
    df = spark.createDataFrame([("call +49 30 1234567",), ("x +49 30 1234567",)], "text string")
    scores = [r.spans[0].score for r in pii.find_pii(df, ["text"]).collect()]
    assert scores == [pytest.approx(0.8), pytest.approx(0.6)]


def test_context_reaches_over_neighbouring_matches(spark):
    texts = [
        "SSN 219-09-9999, 219-09-8888, 219-09-7777 and 219-09-6666",
        "🙂" * 300 + "219-09-9999, 219-09-8888 é ssn " + "x" * 300,
        "x" * 111 + " ssn 219-09-9999",
        "ssn" + " " * 45 + "219-09-9999",
        "ssn" + " " * 46 + "219-09-9999",
        "219-09-9999 " + " " * 20 + "ssn",
        "219-09-9999 " + " " * 21 + "ssn",
        "1.2.3.4 5.6.7.8 server",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = {r.id: r.spans for r in pii.find_pii(df, ["id"]).collect()}
    ssn = {i: [s.s for s in spans if s.kind == "ssn"] for i, spans in rows.items()}
    assert ssn == {0: [4, 17, 30, 46], 1: [300, 313], 2: [116], 3: [48], 4: [], 5: [0], 6: [], 7: []}
    assert [s.score for s in rows[7]] == [pytest.approx(0.8)] * 2


# Sharding --------------------------------------------------------------------------------


def by_prefix_sums(rows, shards):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    total, at, slots, out = sum(r[1] for r in rows), 0, {}, []
    for key, size, crc in rows:
        number = min(shards - 1, at * shards // total)
        out.append((key, size, crc, number, slots.get(number, 0)))
        slots[number] = slots.get(number, 0) + 1
        at += size
    return out


def sized(texts):
    return [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts]


@pytest.mark.parametrize(
    "texts",
    [
        [(i, "é" * (i * 37 % 90)) for i in range(500)],
        [(i, None if i % 5 == 0 else "x" * i) for i in range(30)],
        [(7, "same")] * 400 + [(None, f"n{i}") for i in range(200)] + [(9, "y" * 3000)],
        [(1, "x" * 100_000), (2, "y"), (3, "")],
        [],
    ],
)
def test_shards_cut_at_equal_prefix_sums(spark, folder, texts):
    rows = [(i, t, "en", "a", 0) for i, t in texts]
    found = queries.op3_prefix_sum_shards(spark, documents(spark, rows, folder)).collect()
    got = sorted(tuple(r[c] for c in ("doc_id", "size", "text_crc32", "shard", "slot")) for r in found) if None not in [i for i, _ in texts] else None
    want = by_prefix_sums(sized(texts), 24)
    if got is None:
        text = lambda rows: sorted(map(str, rows))
        assert text((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in found) == text(want)
    else:
        assert got == sorted(want)


@pytest.mark.parametrize("sizes", [[9] * 60, [1 + i * 37 % 90 for i in range(300)], [5] * 200 + [4000] + [5] * 200 + [900]])
def test_cuts_inside_the_last_row_of_a_partition(spark, sizes):
    held = {"spark.sql.shuffle.partitions": "100", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, n long")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = sharding.shard(df, Scratch(), F.col("n"), ["id"], 24).select("id", "n", F.lit(0), "shard", "slot").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, found)) == by_prefix_sums([(i, n, 0) for i, n in enumerate(sizes)], 24)


def test_shard_replaces_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", 9, 9), (2, "b", 9, 9)], "id long, text string, Shard int, `slot` int")
    out = sharding.shard(df, Scratch(), sharding.doc_bytes(df["text"]), ["id"], 2)
    assert sorted(tuple(r) for r in out.select("id", "text", "shard", "slot").collect()) == [(1, "a", 0, 0), (2, "b", 1, 0)]


# Mixing ----------------------------------------------------------------------------------


def test_mix_comes_near_its_targets(spark):
    rows = [(i, " ".join(["w"] * (i % 17)), f"s{i % 7}" if i % 3 else "s0") for i in range(3000)]
    rows += [(5000 + i, "a b c", None) for i in range(40)] + [(9000, None, "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, Scratch(), ["doc_id"]).toPandas()
    assert len(out) == len(rows)
    assert out["times"].max() <= 3
    taken = (out["size"] * out["times"]).groupby(out["source"].fillna("~")).sum()
    target = out.groupby(out["source"].fillna("~"))["target"].first()
    assert ((taken - target).abs() <= 17).all()
    assert abs(target.sum() - out["size"].sum()) < 1e-6


def test_larger_shares_take_at_least_as_much(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), f"s{i % 4}") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, Scratch(), ["doc_id"], shares=(0.2, 0.5, 1.0)).toPandas()
    wide = out.pivot(index="doc_id", columns="share", values="times")
    assert (wide[0.2] <= wide[0.5]).all() and (wide[0.5] <= wide[1.0]).all()


def test_mix_of_one_group_of_copies_and_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b", "s")] * 50 + [(i, "c d", "t") for i in range(100)], "doc_id long, text string, source string")
    assert mixing.mix(df, Scratch(), ["doc_id"]).count() == 150
    assert mixing.mix(df.limit(0), Scratch(), ["doc_id"]).count() == 0


# Chat ------------------------------------------------------------------------------------


def test_each_participant_is_the_assistant_once(spark):
    df = spark.createDataFrame(
        [
            (1, 0, "system", "be brief", "x"),
            (1, 1, "ann", "hi <|im_end|>", "x"),
            (1, 2, "bob", "yo", "x"),
            (1, 2, "bob", "yo", "x"),
            (2, None, None, None, "x"),
            (None, 3, "system", "alone", "x"),
        ],
        "conv_id long, turn long, role string, text string, perspective string",
    )
    out = {(r.conv_id, r.perspective): r for r in chat.rotate(df).collect()}
    assert set(out) == {(1, "ann"), (1, "bob"), (2, "unknown"), (None, None)}
    bob = out[1, "bob"]
    assert bob.text == (
        "<|im_start|>system\nbe brief<|im_end|>\n<|im_start|>user name=ann\nhi < |im_end|><|im_end|>\n"
        "<|im_start|>assistant\nyo<|im_end|>\n"
    )
    start, end = map(int, bob.mask.split(":"))
    assert bob.text[start:end] == "yo<|im_end|>"
    assert (bob.n_turns, bob.n_rows) == (3, 4)
    assert out[None, None].mask == ""
    s, e = map(int, out[2, "unknown"].mask.split(":"))
    assert out[2, "unknown"].text[s:e] == "<|im_end|>"


def test_long_dialogues_come_in_parts(spark):
    df = spark.range(1000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.lit("t").alias("text"))
    parts = chat.rotate(df).orderBy("part").collect()
    assert [p.n_turns for p in parts] == [256, 256, 256, 232]
