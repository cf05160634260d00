"""The corpus pipeline: what each stage keeps, from its own input."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from minutefold.llm import decontam, queries, simhash
from minutefold.llm.work import Scratch

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_on_a_given_table(spark):
    docs = queries.table(spark, SF, "documents")
    known = cp.identify_language(spark, docs, SF)
    assert known.columns == docs.columns and known.count() >= 0.97 * docs.count()
    once = Scratch().land(cp.drop_near_duplicates(spark, known, SF), "once")
    kept = {}
    for r in known.collect():
        kept.setdefault(simhash.fingerprint(r.text, 3) % 2**64, []).append(r.doc_id)
    prints, group = list(kept), {}
    for p in prints:
        group[p] = p
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                old, new = group[a], group[b]
                group = {k: new if v == old else v for k, v in group.items()}
    least = {}
    for p, ids in kept.items():
        least[group[p]] = min([least.get(group[p], min(ids)), *ids])
    assert sorted(r.doc_id for r in once.collect()) == sorted(least.values())
    clean = cp.decontaminate(spark, once, SF)
    items = [" ".join(r.text.lower().split()) for r in queries.table(spark, SF, "benchmark").collect()]
    want = {r.doc_id for r in once.collect() if not any(i in " ".join(r.text.lower().split()) for i in items)}
    assert {r.doc_id for r in clean.collect()} == want


def test_run(spark):
    out = cp.run(spark, SF).collect()
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) <= set(range(24))
    for rows in by_shard.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert max(Counter(r.doc_id for r in out).values()) <= 3


def test_odd_rows_and_empty_tables(spark, folder):
    text = "the of and thing that ation thes with in the heat of and onther thing " * 4
    rows = [(1, text, "en", "a", 1)] * 3 + [(None, text + "x", "en", None, 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n", "en", "b", 0)]
    rows += [(10 + i, f"{i} {i * 7} and {i * 13} of the {i * 17} ation {i * 19} thing " * 5, "en", "b", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    known = cp.identify_language(spark, docs, SF)
    assert rows_of(known) == Counter(r for r in rows if r[0] not in (2, 3, 4))
    once = cp.drop_near_duplicates(spark, docs, SF)
    ids = [r.doc_id for r in once.collect()]
    assert ids.count(1) == 1 and ids.count(2) == 1 and 3 not in ids and 4 not in ids and None not in ids
    mixed = cp.mix_sources(spark, docs, SF)
    assert set(rows_of(mixed)) <= set(rows)
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_documents_without_labels_stay(spark):
    rows = [(i, f"the of and {i} thing that", None, "a", 1) for i in range(5)]
    gone = [(10, None, None, "a", 0), (11, "", None, "a", 0), (12, " \n \n", None, "a", 0)]
    docs = spark.createDataFrame([*rows, *gone], DOCS)
    assert rows_of(cp.identify_language(spark, docs, SF)) == Counter(rows)
    assert cp.identify_language(spark, docs.limit(0), SF).count() == 0


def test_only_leaks_go(spark, folder):
    bench = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(i, f"word{i} other{i * 3} more{i * 5} text " * 6, "en", "s", 1) for i in range(30)]
    leak = (99, "so " * 9 + bench[0][1].upper() + " end" * 4, "en", "s", 1)
    docs = spark.createDataFrame([*rows, leak, leak, (None, leak[1], "en", "s", 1)], DOCS)
    assert rows_of(cp.decontaminate(spark, docs, folder)) == Counter(rows)
    assert len(decontam.word_ids(bench[0][1])) == 16


def test_one_identity_in_two_sources_is_mixed_by_source(spark):
    """Copies of a row under two sources are taken as often as each source says."""
    small = [(i, f"w{i} x y z", "en", "s3", 1) for i in range(4)]
    large = [(100 + i, f"v{i} x y z", "en", "s1", 1) for i in range(40)]
    rows = [*small, *large, (7, "both of them here", "en", "s1", 1), (7, "both of them here", "en", "s3", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    mixed = queries.mixing.mix(docs, Scratch(), ["doc_id"]).select("doc_id", "source", "times").distinct().collect()
    want = Counter({(r.doc_id, r.source): r.times for r in mixed if r.times})
    out = cp.mix_sources(spark, docs, SF)
    assert Counter((r.doc_id, r.source) for r in out.collect()) == want
    assert want[7, "s1"] != want[7, "s3"]


CLASHING = ("kept", "__times", "__row", "row", "times", "hash", "threshold", "component", "__copy", "fp", "first")


def test_columns_of_any_name_pass_through(spark):
    """Every stage but the last returns the columns it got, whatever they are called."""
    docs = queries.table(spark, SF, "documents").limit(60)
    for name in CLASHING:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    docs = Scratch().land(docs, "clashing")
    for name, stage in cp.STAGES[:-1]:
        docs = Scratch().land(stage(spark, docs, SF), name)
        assert docs.count() > 0
        for c in CLASHING:
            assert docs.filter(F.col(f"`{c}`") != F.concat(F.lit(c), F.col("doc_id").cast("string"))).isEmpty()
    assert cp.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_copies_of_one_row_leave_one(spark):
    rows = [(5, "many copies of a text", "en", "s", 1)] * 400 + [(9, "another one that is alone", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    assert sorted(r.doc_id for r in cp.drop_near_duplicates(spark, docs, SF).collect()) == [5, 9]
