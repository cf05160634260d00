"""The registered queries of this subpackage, on whole tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutefold.llm import ann, chat, decontam, fim, langid, minhash, mixing, negatives, pii, repeats, sharding, simhash
from minutefold.llm import urlfilter
from minutefold.llm.work import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], Scratch())
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op2_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def shard_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every document."""
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id",
        sharding.doc_bytes(docs["text"]).alias("n_bytes"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # The scratch tables stay: the result reads them.
    placed = sharding.shard(slim, Scratch(), F.col("n_bytes"), ["doc_id", "text_crc32"], 24)
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")


def op3_prefix_sum_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontam.contaminated(table(spark, sf_dir, "documents"), benchmark, Scratch(), ["doc_id"])
    return found.withColumnRenamed("item", "item_id")


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", Scratch())
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_hnsw_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), Scratch())


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"), ["doc_id"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k.name) for k in pii.BASE],
        F.sha2(pii.joined(F.col("spans"), base_only=True), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        pii.joined(F.col("spans"), with_score=True).alias("scored"),
    )


def op8_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), Scratch(), ["doc_id"])
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def op9_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fit(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    pages = table(spark, sf_dir, "pages")
    return langid.identify(pages, model, Scratch(), ["page_id"], **langid.page_evidence())


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), ["page_id"])


def op11_fast_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], Scratch())
    kept = F.col("doc_id").eqNullSafe(F.col("component"))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


def op12_repeated_capture_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return Scratch().land(
        made.select(
            "doc_id",
            F.col("n_units").alias("n"),
            "form",
            "prefix_chars",
            "middle_chars",
            F.sha2("output", 256).alias("output_sha256"),
            F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
        ),
        "fim-digests",
    )


def op13_secondary_sort_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select("vec_id", "embedding", moved.alias("label")), Scratch())


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_perspective_rotation": op2_perspective_rotation,
    "op3_prefix_sum_shards": op3_prefix_sum_shards,
    "op4_latent_decontamination": op4_latent_decontamination,
    "op5_repeated_strings": op5_repeated_strings,
    "op6_hnsw_shards": op6_hnsw_shards,
    "op7_pii": op7_pii,
    "op8_hash_threshold_mix": op8_hash_threshold_mix,
    "op9_language_evidence": op9_language_evidence,
    "op10_url_filter": op10_url_filter,
    "op11_fast_similarity_sketch": op11_fast_similarity_sketch,
    "op12_repeated_capture_fim": op12_repeated_capture_fim,
    "op13_secondary_sort_negatives": op13_secondary_sort_negatives,
}

#: Fixed value of the contracts: a word.
_WORDS = r"len(regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+'))"

MIX_SQL = f"""
sized AS (
  SELECT doc_id, source, {_WORDS.format('text')} AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS hash
  FROM mix_input),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) * 1.0::DOUBLE AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, source_size * 3.0::DOUBLE AS most, sum(source_size) OVER () AS budget,
         row_number() OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST) AS place
  FROM sources),
levels AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ordered),
common AS (SELECT min_by(level, place) AS common FROM levels WHERE most >= level * weight),
targets AS (
  SELECT source, source_size, least(most, coalesce(common * weight, most)) AS target FROM levels, common),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds FROM targets),
rests AS (SELECT *, target - rounds * source_size AS rest FROM budgets),
hashes AS (
  SELECT source, hash, sum(size) AS size FROM sized GROUP BY source, hash),
walked AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY hash) AS upper FROM hashes),
decided AS (
  SELECT w.source, w.hash, r.source_size, r.target,
         r.rounds + CASE WHEN r.rest > 0 AND (w.upper <= r.rest OR (w.upper - w.size <= r.rest
           AND w.upper - r.rest < r.rest - (w.upper - w.size))) THEN 1 ELSE 0 END AS times
  FROM walked w JOIN rests r ON w.source IS NOT DISTINCT FROM r.source)
"""

SQL: dict[str, str] = {
    "op2_perspective_rotation": """
WITH lines AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body,
         count(*) AS times, CAST(floor(turn / 256.0) AS BIGINT) AS part
  FROM conversations GROUP BY ALL),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM lines WHERE speaker <> 'system'),
seen AS (
  SELECT l.*, p.perspective,
         '<|im_start|>' || CASE WHEN speaker IS NOT DISTINCT FROM perspective THEN 'assistant'
           WHEN speaker = 'system' THEN 'system'
           ELSE 'user name=' || regexp_replace(speaker, '[\\s<|>]', '_', 'g') END || chr(10) AS head,
         body || '<|im_end|>' AS rest
  FROM lines l LEFT JOIN people p ON l.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, speaker IS NOT DISTINCT FROM perspective AS own,
         sum(length(head) + length(rest) + 1) OVER (PARTITION BY conv_id, part, perspective
           ORDER BY turn NULLS FIRST, speaker, body) - length(rest) - 1 AS s
  FROM seen)
SELECT conv_id, part, perspective, count(*) AS n_turns, CAST(sum(times) AS BIGINT) AS n_rows,
       string_agg(head || rest || chr(10), '' ORDER BY turn NULLS FIRST, speaker, body) AS text,
       coalesce(string_agg(CAST(s AS BIGINT)::VARCHAR || ':' || CAST(s + length(rest) AS BIGINT)::VARCHAR, ','
         ORDER BY turn NULLS FIRST, speaker, body) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, part, perspective
""",
    "op8_hash_threshold_mix": f"""
WITH mix_input AS (SELECT doc_id, text, source FROM documents), {MIX_SQL}
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, d.source_size, d.target, CAST(s.size * d.times AS BIGINT) AS taken
FROM sized s JOIN decided d ON s.source IS NOT DISTINCT FROM d.source AND s.hash = d.hash
""",
    "op10_url_filter": r"""
WITH parted AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parted)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host = '' OR contains(path, '/wp-admin/') OR contains(path, '/cgi-bin/') OR host || path LIKE '%.exe'
              OR host || path LIKE '%.zip' OR (host LIKE '%.onion' AND starts_with(path, '/')) THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
""",
    "op11_fast_similarity_sketch": r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS items
  FROM docs),
distinct_sets AS (
  SELECT min(r) AS s, list_sort(items) AS items, len(any_value(items)) AS n FROM sets WHERE len(items) > 0 GROUP BY 2),
items AS (SELECT s, n, unnest(items) AS item FROM distinct_sets),
pairs AS (
  SELECT a.s AS x, b.s AS y FROM items a JOIN items b ON a.item = b.item AND a.s < b.s
  GROUP BY a.s, b.s, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs UNION ALL SELECT s, s FROM distinct_sets),
reach AS (SELECT s AS x, s AS y FROM distinct_sets UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
members AS (SELECT t.r, t.doc_id, d.s FROM sets t JOIN distinct_sets d ON list_sort(t.items) = d.items),
least AS (SELECT s, min(doc_id) AS doc_id FROM members GROUP BY s),
classes AS (SELECT x AS s, min(l.doc_id) AS component FROM reach JOIN least l ON reach.y = l.s GROUP BY x)
SELECT t.doc_id, CAST(len(t.items) AS BIGINT) AS n_shingles,
       CASE WHEN len(t.items) > 0 THEN c.component ELSE t.doc_id END AS component_id,
       t.doc_id IS NOT DISTINCT FROM CASE WHEN len(t.items) > 0 THEN c.component ELSE t.doc_id END AS kept
FROM sets t LEFT JOIN members m ON t.r = m.r LEFT JOIN classes c ON m.s = c.s
""",
    "op12_repeated_capture_fim": r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS hs FROM hashed),
placed AS (
  SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS first, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS second,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 100
           THEN 'plain' WHEN hs[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (
  SELECT *, array_to_string(units[1:first], '') AS prefix, array_to_string(units[first + 1:second], '') AS middle,
         array_to_string(units[second + 1:], '') AS suffix
  FROM placed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM cut
""",
    "op13_secondary_sort_negatives": """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score, b.r
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id, n.r) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
""",
}
