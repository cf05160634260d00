"""A training corpus from raw documents, in stages that each call one operator.

A stage gets what its predecessor kept, decides on narrow tables that hold a row's identity (a
hash of its document number and text) and takes its decision into effect by one join. What is
to go is written first, so that Spark knows its size and broadcasts it only if it is small.
Rows equal in number and text are one identity. Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutefold.llm import decontam, langid, mixing, queries, simhash
from minutefold.llm.work import Scratch, unused

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def identified(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with their rows' identity, and the name of that column, which no other has."""
    name = unused(docs, "row")
    return docs.withColumn(name, mixing.row_hash(F.col("doc_id"), F.col("text"))), name


def less(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents without the rows whose identity is listed in the only column of ``gone``."""
    own, name = identified(docs)
    return own.join(gone.toDF(name).distinct(), name, "left_anti").select(*named(docs))


def named(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach; undecided and wordless ones go.

    Text and source, which stands for the host, are the evidence. The ``lang`` column is what the
    model is fitted on, so it is no declaration as well: a wrong label would vouch for itself.
    Where no row is labelled nothing can be decided, so all documents that have words stay: the
    rows with a trigram that is not all white space. Other columns may have any name.
    """
    scratch = Scratch()
    model = langid.fit(docs, "doc_id", "text", "lang")
    if not model.taught:
        return docs.filter((F.octet_length("text") >= 3) & F.regexp_like("text", F.lit(r"[^\s]")))
    own, row = identified(docs)
    nothing = F.lit(None).cast("string")
    judged = langid.identify(own, model, scratch, [row], F.col("text"), nothing, F.col("source"))
    # Landed before it is filtered: Spark would write the whole formula of a posterior into the
    # filter, several times, which takes a driver seconds and hundreds of megabytes.
    judged = scratch.land(judged.select(row, "lang", "text_lang"), "stage-judged")
    rejected = judged.filter((F.col("lang") == "und") | (F.col("text_lang") == "und")).select(row).distinct()
    return less(docs, scratch.land(rejected, "stage-rejected"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one of smallest number.

    A null number comes last. Of equal numbers the least identity stays, of equal rows one.
    Other columns may have any name.
    """
    scratch = Scratch()
    own, row = identified(docs)
    found = simhash.near_duplicates(own, [row, "doc_id"], scratch).toDF("row", "doc_id", "fp", "component")
    ranked = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    kept = scratch.land(
        found.groupBy("component").agg(F.min(ranked).alias("first")).select(F.col("first.row").alias(row)),
        "stage-kept",
    )
    # Rows of one identity collapse before they are shuffled, so that copies of a text, be they
    # a third of all rows, come together as one row of each task.
    return own.dropDuplicates([row]).join(kept, row, "left_semi").select(*named(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    scratch = Scratch()
    benchmark = queries.table(spark, sf_dir, "benchmark")
    own, row = identified(docs)
    found = decontam.contaminated(own, benchmark, scratch, [row])
    return less(docs, scratch.land(found.select(row).distinct(), "stage-leaks"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, each as often as it takes it.

    Rows of one identity and source share their decision; in another source it may be another.
    Other columns may have any name.
    """
    scratch = Scratch()
    row, source, times = (unused(docs, n) for n in ("row", "source", "times"))
    taken = mixing.mix(docs, scratch, ["doc_id"]).select(
        F.col("hash").alias(row), F.col("source").alias(source), F.col("times").alias(times)
    )
    decided = scratch.land(
        taken.groupBy(row, source).agg(F.max(times).alias(times)).filter(F.col(times) > 0), "stage-mix"
    )
    identity = mixing.row_hash(F.col("doc_id"), F.col("text"))
    return (
        docs.join(decided, (identity == F.col(row)) & F.col("source").eqNullSafe(F.col(source)))
        .withColumn(unused(docs, "copy"), F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
        .select(*named(docs))
    )


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number, size, checksum, shard and slot of every document."""
    return queries.shard_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard_documents", shard_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again as the next one's input."""
    scratch = Scratch()
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        opened = len(Scratch.opened)
        docs = scratch.land(stage(spark, docs, sf_dir), f"stage-{name}")
        Scratch.drop_opened(opened)  # what the stage landed on its way
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages hold a trained model, a random projection and fingerprints, which SQL cannot express.
ORACLE_SQL = None
