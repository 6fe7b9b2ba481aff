"""The registered queries of this subpackage: thin, one per operator.

Each applies its operator, with production parameters, to its whole table and
derives the contract's digest columns from the operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.llm.bag_search import ranked_documents
from ledgerguard.llm.common import doc_id, table
from ledgerguard.llm.decontamination import contaminated_documents
from ledgerguard.llm.gumbel_pieces import sample_rows
from ledgerguard.llm.html_gbt import extract
from ledgerguard.llm.line_dedup import dedup_lines
from ledgerguard.llm.packing import pack
from ledgerguard.llm.pfp_dedup import drop_repeats
from ledgerguard.llm.pivot_codes import coded_vectors
from ledgerguard.llm.quality_bayes import judge_sites
from ledgerguard.llm.quality_rules import quality_rules
from ledgerguard.llm.sharding import shard_documents
from ledgerguard.llm.simhash_gray import near_groups
from ledgerguard.llm.sketches import edited_fingerprints


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(table(spark, sf_dir, "documents"), digest=True)
    return rows.select(doc_id(), "n_lines", "n_dropped", F.col("kept").alias("kept_sha256"))


def op3_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(table(spark, sf_dir, "documents"), samples=4)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), capacity=2048)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host: the source; path: the language section of it."""
    return judge_sites(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), host="source", path="lang")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_repeats(table(spark, sf_dir, "documents"), length=400, digest=True)
    return rows.select(doc_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept").alias("text"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_groups(table(spark, sf_dir, "documents"), words_per_shingle=3, limit=3)
    return rows.select(doc_id(), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       doc_id("component").alias("component_id"))


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_vectors(table(spark, sf_dir, "embeddings"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_line_dedup": op2_line_dedup,
    "op3_sentencepiece_sampling": op3_sentencepiece_sampling,
    "op4_sharding": op4_sharding,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_benchmark_decontamination": op11_benchmark_decontamination,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_vector_code_compression": op13_vector_code_compression,
}

# DuckDB, on the same tables. A line's key: ASCII white space stripped at both
# ends, A-Z lower-cased.
_OP2 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM docs
), keys AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keys WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > f.first, false) AS gone
  FROM keys k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Each level's draw: -ln(u) / weight, u from 52 bits of the MD5 of key and path.
# The regions of 24 shards weigh 12 each, the region of shard 24 weighs 1.
_DRAW = "-ln((CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || {path}), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) / {weight}"
_OP4 = f"""
WITH crc_step AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS i))
), d AS (
  SELECT row_number() OVER () AS row, doc_id, strlen(coalesce(text, '')) + 8 AS size,
         coalesce(text, '') AS text
  FROM documents
), crcs AS (
  SELECT row, CAST(xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32
  FROM d, crc_step
), region AS (
  SELECT row, arg_min(g, draw) AS g FROM (
    SELECT row, g, {_DRAW.format(path="'/g' || g", weight="12")} AS draw FROM d, generate_series(0, 1) t(g)) GROUP BY row
), rack AS (
  SELECT row, any_value(g) AS g, arg_min(r, draw) AS r FROM (
    SELECT row, g, r, {_DRAW.format(path="'/g' || g || '/r' || r", weight="4")} AS draw
    FROM d JOIN region USING (row), generate_series(0, 2) t(r)) GROUP BY row
), leaf AS (
  SELECT row, arg_min(s, draw) AS shard FROM (
    SELECT row, 12 * g + 4 * r + i AS s,
           {_DRAW.format(path="'/g' || g || '/r' || r || '/' || (12 * g + 4 * r + i)", weight="1")} AS draw
    FROM d JOIN rack USING (row), generate_series(0, 3) t(i)) GROUP BY row
), grown AS (
  SELECT row, least({_DRAW.format(path="'/g0'", weight="12")}, {_DRAW.format(path="'/g1'", weight="12")})
              > {_DRAW.format(path="'/x24'", weight="1")} AS moves
  FROM d
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, text_crc32, size) - 1 AS slot,
       CAST(CASE WHEN moves THEN 24 ELSE shard END AS INTEGER) AS grown_shard
FROM d JOIN crcs USING (row) JOIN leaf USING (row) JOIN grown USING (row)
"""

# Words: A-Z lower-cased, all ASCII but digits and letters separates.
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP11 = rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS width, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS said
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), doc_windows AS (
  SELECT r, width, i, array_to_string(w[i:i + width - 1], ' ') AS said
  FROM (SELECT r, w, width, unnest(generate_series(1, len(w) - width + 1)) AS i
        FROM doc_words, (SELECT DISTINCT width FROM item_windows) WHERE len(w) >= width)
), hits AS (
  SELECT r, i, d.width, item_id FROM doc_windows d JOIN item_windows s ON d.width = s.width AND d.said = s.said
), words_hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + width - 1)) AS p FROM hits) GROUP BY r
), items_hit AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), '') AS item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN words_hit USING (r) LEFT JOIN items_hit USING (r)
"""

_TERMS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents
), corpus AS (
  SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus
), doc AS (
  SELECT r, doc_id, 100 - 50 + (50 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM d, corpus WHERE len(w) > 0
), item AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), scored AS (
  SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN doc USING (r) GROUP BY item_id, r
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank,
         doc_id, score
  FROM scored JOIN doc USING (r) WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""


def _op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Integer k-means written out round by round, every distance evaluated."""
    steps = [f"""usable AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(embedding) % {parts} = 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT))) AS r,
         vec_id, label, embedding
  FROM usable WHERE len(embedding) = (SELECT len(embedding) FROM usable ORDER BY vec_id NULLS LAST, len(embedding) LIMIT 1)
), comps AS MATERIALIZED (
  SELECT r, (i - 1) // (size // {parts}) AS part, (i - 1) % (size // {parts}) AS pos,
         CAST(floor(4096 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT r, embedding, len(embedding) AS size, unnest(generate_series(1, len(embedding))) AS i FROM kept)
), book0 AS MATERIALIZED (
  SELECT part, r - 1 AS e, pos, v FROM comps WHERE r <= {entries}
)"""]
    near = """near{k} AS MATERIALIZED (
  SELECT r, part, arg_min(e, d * {entries} + e) AS e, min(d) AS d
  FROM (SELECT c.r, part, b.e, sum((c.v - b.v) * (c.v - b.v)) AS d FROM comps c JOIN book{k} b USING (part, pos) GROUP BY ALL)
  GROUP BY r, part
)"""
    for k in range(rounds):
        steps.append(near.format(k=k, entries=entries))
        steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT part, e, pos, coalesce(n.v, b.v) AS v FROM book{k} b LEFT JOIN (
    SELECT part, e, pos, CAST((s - ((s % c) + c) % c) // c AS BIGINT) AS v
    FROM (SELECT part, e, pos, sum(v) AS s, count(*) AS c FROM near{k} JOIN comps USING (r, part) GROUP BY ALL)) n
  USING (part, e, pos)
)""")
    steps.append(near.format(k=rounds, entries=entries))
    steps.append(f"""codes AS (
  SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, e, pos)) FROM book{rounds}) AS codebooks_sha256
FROM codes JOIN kept USING (r)
"""


LLM_ORACLE: dict[str, str] = {
    "op2_line_dedup": _OP2,
    "op4_sharding": _OP4,
    "op11_benchmark_decontamination": _OP11,
    "op12_ranked_lexical_search": _OP12,
    "op13_vector_code_compression": _op13(),
}
