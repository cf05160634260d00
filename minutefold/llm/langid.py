"""Language identification by fusing the evidence of text, markup, address and host."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minutefold.llm.urlfilter import host_of
from minutefold.llm.work import Scratch

#: Hashed byte trigrams that the text model tells apart.
FEATURE_BITS = 15
FEATURES = 1 << FEATURE_BITS
#: Labelled rows per language that the text model is fitted on, at most.
FIT_ROWS = 2_000
#: Languages that a model can hold in memory; a table with more is refused, none is left out.
LANGUAGES = 512
#: Trigrams that a text counts for at most: its trigrams depend on each other.
WEIGHT = 64.0
#: Rows that a prior counts as, when the level below it is smoothed towards it.
SMOOTHING = 4.0
#: Bytes of a long text looked at in one go.
BLOCK = 1 << 20


def _features(raw: bytes):
    """Hashed trigrams of the text's bytes, A-Z in lower case, in blocks."""
    raw = raw.lower()
    for at in range(0, max(0, len(raw) - 2), BLOCK):
        b = np.frombuffer(raw[at : at + BLOCK + 2], np.uint8).astype(np.uint32)
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        yield (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)


def _counts(raw: bytes) -> np.ndarray:
    out = np.zeros(FEATURES, np.int64)
    for part in _features(raw):
        out += np.bincount(part, minlength=FEATURES)
    return out


class TextModel:
    """Multinomial likelihoods of hashed trigrams by language, add-one-half smoothed."""

    def __init__(self, languages: list[str], counts: np.ndarray, taught: bool = True):
        self.taught = taught
        smooth = counts + 0.5
        self.languages = languages
        self.logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.copy()

    def score(self, raw: bytes) -> np.ndarray:
        """Log likelihoods by language, as of at most WEIGHT trigrams; zeros without any."""
        total, count = np.zeros(len(self.languages)), 0
        for part in _features(raw):
            seen = np.bincount(part, minlength=FEATURES)
            some = np.flatnonzero(seen)
            total += seen[some] @ self.logs[some]
            count += len(part)
        return total / count * min(count, WEIGHT) if count else total


def fit(labelled: DataFrame, key: str, text: str, label: str) -> TextModel:
    """The text model of at most FIT_ROWS labelled rows per language, those of least hash.

    Null labels and texts are no examples. Every label is learned; more than LANGUAGES of them
    raise an error. Without any example the model is not ``taught`` and has the class ``und``.
    """
    rows = labelled.select(
        F.col(f"`{label}`").alias("label"), F.col(f"`{text}`").alias("text"),
        F.pmod(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")), F.lit(1 << 30)).alias("draw"),
    ).filter(F.col("label").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("label").count().limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} labels in column {label}: the text model holds no more")
    # Twice as many as are wanted pass a threshold on the hash; copies share one.
    limits = [(s["label"], math.ceil(min(1.0, 2 * FIT_ROWS / s["count"]) * (1 << 30))) for s in sizes]
    shares = rows.sparkSession.createDataFrame(limits, "of string, share long")
    drawn = (
        rows.join(F.broadcast(shares), F.col("label") == F.col("of"))
        .filter(F.col("draw") < F.col("share"))
        .drop("of", "share")
        .dropDuplicates(["label", "draw"])
    )
    least = F.slice(F.array_sort(F.collect_list("draw")), 1, FIT_ROWS)
    last = drawn.groupBy(F.col("label").alias("of")).agg(F.element_at(least, -1).alias("last"))
    chosen = drawn.join(F.broadcast(last), F.col("label") == F.col("of")).filter("draw <= last")

    def count(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(FEATURES, np.int64)
        for t in group["text"]:
            total += _counts(t.encode())
        return pd.DataFrame({"label": [group["label"].iloc[0]], "counts": [total.tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in group["counts"])
        return pd.DataFrame({"label": [group["label"].iloc[0]], "counts": [total.tobytes()]})

    # At most FIT_ROWS texts of a language in ten parts, of many languages in fewer. They are
    # added up before they come back: one array of fixed size for each language.
    parts_each = max(1, 640 // max(64, len(sizes)))
    parts = (
        chosen.select("label", "text", (F.col("draw") % parts_each).alias("part"))
        .groupBy("label", "part")
        .applyInPandas(count, "label string, counts binary")
        .groupBy("label")
        .applyInPandas(add, "label string, counts binary")
        .collect()
    )
    languages = sorted(s["label"] for s in sizes)
    counts = np.zeros((max(1, len(languages)), FEATURES))
    for p in parts:
        counts[languages.index(p["label"])] += np.frombuffer(p["counts"], np.int64)
    return TextModel(languages or ["und"], counts, bool(languages))


def _added(parts: list[Column]) -> Column:
    """The sum by halves, so that many parts are no deep expression."""
    if len(parts) == 1:
        return parts[0]
    return _added(parts[: len(parts) // 2]) + _added(parts[len(parts) // 2 :])


def _with_normal(df: DataFrame, logs: Column, name: str, size: int) -> DataFrame:
    """The frame with logarithms as probabilities that add up to one.

    Step by step and by element, so that each step is computed once and by compiled code.
    """
    raised = [F.exp(F.col("__logs")[i] - F.col("__most")) for i in range(size)]
    shares = [F.col("__raised")[i] / F.col("__total") for i in range(size)]
    return (
        df.withColumn("__logs", logs)
        .withColumn("__most", F.array_max("__logs"))
        .withColumn("__raised", F.array(*raised))
        .withColumn("__total", _added([F.col("__raised")[i] for i in range(size)]))
        .withColumn(name, F.array(*shares))
        .drop("__logs", "__most", "__raised", "__total")
    )


def _sums(of: str, size: int, as_: str) -> Column:
    return F.array(*[F.sum(F.col(of)[i]) for i in range(size)]).alias(as_)


def _smoothed(counts: list[Column], whole: str, towards: list[Column]) -> list[Column]:
    """``whole`` names the column of the counts' sum, which is computed once."""
    return [(n + SMOOTHING * p) / (F.col(whole) + SMOOTHING) for n, p in zip(counts, towards, strict=True)]


def identify(
    df: DataFrame,
    model: TextModel,
    scratch: Scratch,
    key: list[str],
    text: Column,
    declared: Column,
    host: Column,
) -> DataFrame:
    """``key``, ``lang``, ``posterior``, ``text_lang``, ``declared``, ``host`` and ``suffix`` of every row.

    The posterior is the text's likelihood, times how often rows of a language (by their text)
    declare what the row declares and have its address suffix, times the prior of its host.
    Priors are counts of text posteriors, smoothed from all rows to the domain (the last two
    parts of a host) and from there to the host, less the row itself. ``lang`` is ``und``
    where no language has half of the posterior.

    A null or empty text has no likelihood, so the other evidence decides; a null declaration
    or host counts as an empty one. Repeated rows are judged alike. An empty table has no rows.
    Only the named columns are read, so others may have any name.
    """
    size, names = len(model.languages), model.languages

    @F.pandas_udf("array<double>")
    def likelihoods(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t.encode()).tolist() for t in texts])

    blank = F.lit("")
    texts = df.select(
        *[F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(key)],
        F.coalesce(F.lower(declared), blank).alias("declared"),
        F.coalesce(host, blank).alias("host"),
        likelihoods(F.coalesce(text, blank)).alias("logs"),
    )
    parted = texts.withColumn("domain", F.substring_index("host", ".", -2)).withColumn(
        "suffix", F.substring_index("host", ".", -1)
    )
    scored = scratch.land(_with_normal(parted, F.col("logs"), "own", size), "langid-scored")
    sums = scored.agg(*[F.coalesce(F.sum(F.col("own")[i]), F.lit(0.0)) for i in range(size)]).first()
    overall = [(n + SMOOTHING / size) / (sum(sums) + SMOOTHING) for n in sums]
    prior = [F.lit(p) for p in overall]

    def elements(name: str) -> list[Column]:
        return [F.col(name)[i] for i in range(size)]

    def given(column: str) -> DataFrame:
        """Per value, its logarithmic probability in each language."""
        values = scored.groupBy(F.col(column).alias(f"{column}1")).agg(_sums("own", size, "n"))
        count = scored.agg(F.approx_count_distinct(column)).first()[0]
        logs = [F.log((n + 1.0) / (whole + count + 1.0)) for n, whole in zip(elements("n"), sums, strict=True)]
        return scratch.land(values.select(f"{column}1", F.array(*logs).alias(f"{column}_logs")), f"langid-{column}")

    # Each table of evidence is landed on its own: one plan of all of them takes a driver more
    # memory than the rest of a run.
    hosts = scored.groupBy(F.col("host").alias("host1"), F.col("domain").alias("domain0")).agg(_sums("own", size, "n"))
    hosts = scratch.land(hosts, "langid-hosts")
    domains = hosts.groupBy(F.col("domain0").alias("domain1")).agg(_sums("n", size, "domain_n"))
    hosts = (
        hosts.join(domains, F.col("domain0") == F.col("domain1"))
        .withColumn("whole", _added(elements("domain_n")))
        .select("host1", "n", F.array(*_smoothed(elements("domain_n"), "whole", prior)).alias("towards"))
    )
    hosts = scratch.land(hosts, "langid-host-priors")
    others = [F.greatest(n - own, F.lit(0.0)) for n, own in zip(elements("n"), elements("own"), strict=True)]
    fused = (
        scored.join(hosts, F.col("host") == F.col("host1"))
        .join(given("declared"), F.col("declared") == F.col("declared1"))
        .join(given("suffix"), F.col("suffix") == F.col("suffix1"))
        .withColumn("others", F.array(*others))
        .withColumn("whole", _added(elements("others")))
        .withColumn("host_prior", F.array(*_smoothed(elements("others"), "whole", elements("towards"))))
    )
    parts = [elements(c) for c in ("logs", "declared_logs", "suffix_logs", "host_prior")]
    added = [a + b + c + F.log(d) for a, b, c, d in zip(*parts, strict=True)]
    labels = F.array(*[F.lit(n) for n in names])

    def best(p: Column) -> Column:
        return F.element_at(labels, F.array_position(p, F.array_max(p)).cast("int"))

    judged = _with_normal(fused, F.array(*added), "p", size)
    top = F.array_max("p")
    known = F.size(F.filter("logs", lambda x: x != 0)) > 0
    return judged.select(
        *[F.col(f"key{i}").alias(c) for i, c in enumerate(key)],
        F.when(top >= 0.5, best(F.col("p"))).otherwise("und").alias("lang"),
        top.alias("posterior"),
        F.when(known, best(F.col("logs"))).otherwise("und").alias("text_lang"),
        "declared",
        "host",
        "suffix",
    )


def _cut(text: Column, opens: str, closes: str) -> Column:
    """The text less every stretch from an opening pattern to the next closing one.

    Split at the ends, so that each piece is looked at once: a pattern over the whole stretch
    reads to the end of the text from every beginning that has no end.
    """

    # Bound by a lambda, so that the text is split once.
    def joined(pieces: Column) -> Column:
        ended = F.slice(pieces, 1, F.size(pieces) - 1)
        kept = F.transform(ended, lambda p: F.regexp_replace(p, f"(?s){opens}.*", " "))
        return F.array_join(F.concat(kept, F.array(F.element_at(pieces, -1))), " ")

    return F.get(F.transform(F.array(F.split(text, closes)), joined), F.lit(0))


def _readable(markup: Column) -> Column:
    """Markup less scripts, styles, comments, tags and character references, in linear time."""
    for name in ("script", "style"):
        markup = _cut(markup, rf"(?i)<{name}\b[^<>]*>", rf"(?i)</{name}\s*+>")
    return F.regexp_replace(_cut(markup, "<!--", "-->"), r"<[^<>]*+>|&#?+\w++;", " ")


def page_evidence(html: str = "html", url: str = "url") -> dict[str, Column]:
    """Text, declared language and host of a raw page, as arguments of ``identify``."""
    markup = F.col(f"`{html}`")
    return {
        "text": _readable(markup),
        "declared": F.regexp_extract(markup, r"""(?is)<html\b[^<>]*?\slang\s*+=\s*+["']?([a-z]{2,3})""", 1),
        "host": host_of(F.col(f"`{url}`")),
    }
