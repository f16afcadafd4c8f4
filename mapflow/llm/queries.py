"""One query for each operator over its whole table; `QUERIES` and `ORACLES` are what is registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.llm import (
    collocations,
    decontaminate,
    encoding,
    exact_dedup,
    language_model,
    near_dedup,
    neighbours,
    packing,
    periodic_runs,
    repeats,
    secrets,
    token_store,
    toxicity,
)
from mapflow.llm.common import table, tokenizer_path
from mapflow.session import scratch_path

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.digests(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"), path="source")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_ids(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), path)
    return token_store.read_documents(spark, path)


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=2, percent=80)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_secrets": op2_secrets,
    "op3_token_store": op3_token_store,
    "op4_repeats": op4_repeats,
    "op5_neighbours": op5_neighbours,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packing": op7_packing,
    "op8_near_dedup": op8_near_dedup,
    "op9_language_model": op9_language_model,
    "op10_toxicity": op10_toxicity,
    "op11_decontaminate": op11_decontaminate,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}
#: Equal texts by grouping on the normalised text itself.
EXACT_DEDUP = r"""
WITH plain AS (
    SELECT doc_id, coalesce(text, '') AS original, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER same AS keep_id,
       count(*) OVER (PARTITION BY normal) AS group_size,
       doc_id = first_value(doc_id) OVER same AS kept,
       sha256(normal) AS text_sha256
FROM plain
WINDOW same AS (PARTITION BY normal ORDER BY length(original) DESC, doc_id)
"""

#: Windows of items met with all stretches of as many words in the documents.
DECONTAMINATE = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), starts AS (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, w[i:i + 9] AS piece FROM starts
), sizes AS (
    SELECT DISTINCT size FROM windows
), places AS (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size
), stretches AS (
    SELECT doc_id, size, i, w[i:i + size - 1] AS piece FROM places
), hits AS (
    SELECT s.doc_id, s.i, s.size, x.item_id FROM stretches AS s JOIN windows AS x ON s.size = x.size AND s.piece = x.piece
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

#: All phrases counted, cut everywhere and ranked.
COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), places AS (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, range(1, 6) AS sizes(size) WHERE len(w) >= size
), phrases AS (
    SELECT lang, w[i:i + size - 1] AS p, size, count(*) AS f FROM (SELECT lang, size, i, w FROM places) GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT lang, p, size, f AS a, unnest(range(1, size)) AS cut FROM phrases WHERE size > 1
), scored AS (
    SELECT c.lang, c.p, c.size, c.a, x.f AS l, y.f AS r, t.n, c.cut,
           CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM cuts AS c JOIN phrases AS x ON x.lang = c.lang AND x.p = c.p[1:c.cut]
    JOIN phrases AS y ON y.lang = c.lang AND y.p = c.p[c.cut + 1:] JOIN totals AS t ON t.lang = c.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), inside AS (
    SELECT DISTINCT lang, p[b:b + k - 1] AS p, f FROM (
        SELECT lang, p, f, k, unnest(range(1, size - k + 2)) AS b FROM phrases, range(2, 5) AS shorter(k) WHERE size > k)
), kept AS (
    SELECT * FROM lowest AS c WHERE NOT EXISTS (SELECT 1 FROM inside AS o WHERE o.lang = c.lang AND o.p = c.p AND o.f >= c.a)
), ranked AS (
    SELECT *, array_to_string(p, ' ') AS phrase,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op6_exact_dedup": EXACT_DEDUP, "op11_decontaminate": DECONTAMINATE, "op12_collocations": COLLOCATIONS}
