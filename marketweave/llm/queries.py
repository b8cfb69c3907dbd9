"""The registered queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketweave.llm import (bpe, codes, embeddings, infill, jaccard, licenses, mixing, quality,
                             revisits, sharding, substrings, tokenfiles, toxicity)
from marketweave.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def held_out() -> Column:
    """Every fifth id by checksum is kept from learning (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                  F.lit(5)) == 0


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"),
                           "toxic", keep=~held_out())
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule")


@query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(
        table(spark, sf_dir, "documents"), jaccard.Similarity(4, 85, 100)).select(
        "doc_id", "n_shingles", "component_id")


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, md5(html) AS tag, strlen(html) AS n_bytes,
         regexp_replace(url, '#.*$', '') AS bare FROM pages),
o AS (SELECT *, regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*') AS origin FROM p),
q AS (SELECT *, substr(bare, length(origin) + 1) AS rest,
             regexp_replace(regexp_replace(lower(origin), '^(http://.*):80$', '\1'),
                            '^(https://.*):443$', '\1') AS host FROM o),
u AS (SELECT *, regexp_extract(rest, '^[^?]*') AS path,
             list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
                       lambda x: x <> '' AND NOT regexp_matches(x, '^utm_[a-z]+='))) AS params FROM q),
c AS (SELECT page_id, tag, n_bytes, host || CASE WHEN path = '' THEN '/' ELSE path END ||
             CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical
      FROM u),
full_r AS (SELECT canonical, page_id * 3 AS id, page_id * 60 AS at, tag, page_id, n_bytes FROM c),
rev AS (
  SELECT canonical, page_id * 3 + 1 AS record_id, page_id * 60 + 86400 * (1 + page_id % 3) AS at,
         CASE WHEN page_id % 4 = 0 THEN 'stale' ELSE tag END AS tag, page_id, 0 AS dated FROM c
  UNION ALL
  SELECT canonical, page_id * 3 + 2, page_id * 60 - 30, NULL, page_id, 1 FROM c),
j AS (
  SELECT r.*, (SELECT arg_max(f.id, f.at * 1000000000 + f.id) FROM full_r f
               WHERE f.canonical = r.canonical AND f.at < r.at) AS ref FROM rev r),
k AS (
  SELECT j.*, f.tag AS ftag, f.page_id AS fpage, f.n_bytes,
         CASE WHEN ref IS NULL THEN 'orphan'
              WHEN dated = 0 THEN CASE WHEN j.tag = f.tag THEN 'resolved' ELSE 'changed' END
              WHEN j.page_id % 7 = f.page_id % 7 THEN 'resolved' ELSE 'changed' END AS outcome
  FROM j LEFT JOIN full_r f ON f.id = j.ref)
SELECT record_id, canonical, outcome, CASE WHEN outcome = 'resolved' THEN ref END AS refers_to,
       CASE WHEN outcome = 'resolved' THEN
         'content-length=' || n_bytes || ';content-type=text/html;date=day ' ||
         CASE WHEN dated = 0 THEN page_id + 1 ELSE fpage END || ';etag=' ||
         CASE WHEN dated = 0 THEN 'W/"' || tag || '"' ELSE '"' || ftag || '"' END ||
         CASE WHEN dated = 0 THEN ';expires=day ' || (page_id + 2) ELSE '' END ||
         ';last-modified=day ' || (fpage % 7) END AS merged
FROM k
"""


@query("op4_revisits", OP4_SQL)
def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revisits.resolve_revisits(revisits.captures(table(spark, sf_dir, "pages")))
    pairs = F.array_sort(F.transform(F.map_entries("headers"),
                                     lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select("record_id", "canonical", "outcome", "refers_to",
                      F.array_join(pairs, ";").alias("merged"))


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfiles.scratch_folder(spark)
    manifest = tokenfiles.write_token_files(table(spark, sf_dir, "documents"), folder, TOKENIZER)
    return tokenfiles.read_token_files(manifest, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_bpe_roundtrip")
def op6_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    both = bpe.decode_documents(bpe.encode_documents(docs, TOKENIZER), TOKENIZER)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents")).drop("passage").distinct()


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0)::DOUBLE AS symbols,
         (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '-' || md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE
           + 0.5) / 4503599627370496.0 AS u
  FROM documents),
k AS (SELECT *, pow(u, 1.0 / greatest(0.05, 1.0 - symbols / greatest(size, 1))) AS mix_key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
r AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM s),
c AS (SELECT *, 3.0 * source_size AS cap, 3.0 * source_size / w AS ratio,
             sum(source_size) OVER ()::DOUBLE AS total FROM r),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY ratio, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size,
             least(cap, coalesce((SELECT arg_min(level, ratio) FROM l WHERE level <= ratio) * w, cap))
               AS target FROM l),
p AS (SELECT k.doc_id, k.source, size, source_size, target,
             floor(target / greatest(source_size, 1)) AS epochs,
             coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY mix_key DESC, size, doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS prefix
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN target - epochs * source_size > 0
                        AND prefix + size / 2.0 <= target - epochs * source_size
                       THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM p
"""


@query("op8_mixing", OP8_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "n_tokens")


@query("op10_embedding_near_dup")
def op10_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def _words_sql(text: str) -> str:
    """DuckDB text: the words of a text as the license scan sees them."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (f"regexp_extract_all(translate({text}, '{upper}', '{upper.lower()}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def op11_sql() -> str:
    """The license scan with every block compared with every template of its length."""
    quoted = [(label, t.replace("'", "''"), licenses.block_step(len(licenses.text_words(t))))
              for label, t in licenses.TEMPLATES]
    templates = ",\n  ".join(f"({i}, '{label}', {c}, '{t}')" for i, (label, t, c) in enumerate(quoted))
    phrases = []
    for label, t in licenses.PHRASES:
        w = t.split()
        same = " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(w))
        phrases.append(f"list_transform(list_filter(range(1, len(w) - {len(w) - 2}), lambda i: {same}), "
                       f"lambda i: {{'p': i - 1, 'label': '{label}'}})")
    num, den = licenses.SHARE
    return f"""
WITH t AS (
  SELECT tid, label, step, {_words_sql("text")} AS w FROM (VALUES
  {templates}) AS v(tid, label, step, text)),
tw AS (SELECT DISTINCT tid, step, unnest(w) AS word FROM t),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_words_sql("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT rid, doc_id, len(w)::BIGINT AS n_words,
             list_concat({", ".join(phrases)}) AS found FROM d),
u AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
h AS (SELECT DISTINCT rid, c.step, u.word, pos // c.step - back AS block
      FROM u JOIN (SELECT DISTINCT step, word FROM tw) c ON c.word = u.word,
           (VALUES (0), (1)) AS s(back) WHERE pos // c.step - back >= 0),
m AS (SELECT rid, tid, count(*) AS shared FROM h JOIN tw USING (step, word) GROUP BY rid, tid, block),
s AS (SELECT rid, t.label, max(shared::DOUBLE / len(list_distinct(t.w))) AS part
      FROM m JOIN t USING (tid) WHERE {den} * shared >= {num} * len(list_distinct(t.w))
      GROUP BY rid, t.label),
r AS (SELECT rid, list(label) AS more, max(part) AS part FROM s GROUP BY rid)
SELECT doc_id, n_words, len(found)::BIGINT AS n_base,
       list_min(list_transform(found, lambda x: x.p))::BIGINT AS first_word,
       list_max(list_transform(found, lambda x: x.p))::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(found, lambda x: x.label))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(list_transform(found, lambda x: x.label),
                                                           coalesce(more, [])))), ',') AS labels,
       CASE WHEN len(found) > 0 THEN 1.0 ELSE coalesce(part, 0.0) END AS score
FROM b LEFT JOIN r USING (rid)
"""


@query("op11_license_scan", op11_sql())
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("blocks")


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
           FROM documents),
u AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
             ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3,
             ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.with_digests(infill.fill_in_middle(
        infill.store_frames(table(spark, sf_dir, "documents")), seed=1))


def op13_sql() -> str:
    """Lloyd rounds with every part compared with every entry."""
    n, k = codes.PARTS, codes.ENTRIES
    steps = [f"""
k AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS rid, vec_id, label,
             list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS q
      FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT rid, part, q[part * len(q) // {n} + 1:(part + 1) * len(q) // {n}] AS v
      FROM k, range({n}) AS r(part)),
b0 AS (SELECT part, rid AS entry, v FROM p WHERE rid < {k})"""]
    near = """SELECT rid, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
        SELECT rid, p.part, entry, list_sum(list_transform(list_zip(p.v, b.v),
               lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM p JOIN b{} b ON b.part = p.part) GROUP BY rid, part"""
    for i in range(codes.ROUNDS):
        steps.append(f"""
a{i} AS MATERIALIZED ({near.format(i)}),
b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY j) AS v FROM (
      SELECT part, entry, j, CASE WHEN s >= 0 THEN s // c ELSE -((-s + c - 1) // c) END AS mean FROM (
        SELECT part, entry, j, sum(x)::BIGINT AS s, count(*) AS c FROM (
          SELECT a.part, a.entry, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS j
          FROM a{i} a JOIN p ON p.rid = a.rid AND p.part = a.part) GROUP BY part, entry, j))
    GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry)""")
    last = codes.ROUNDS
    steps.append(f"""
z AS ({near.format(last)}),
c AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
      FROM z GROUP BY rid),
e AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
      FROM b{last})""")
    return "WITH" + ",".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM c JOIN k USING (rid), e
"""


@query("op13_vector_codes", op13_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.with_label_error(found).select(
        "vec_id", "code", "error", "label_error",
        F.lit(codes.books_digest(books)).alias("codebooks_sha256"))
