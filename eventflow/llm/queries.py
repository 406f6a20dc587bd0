"""The registered queries of the text operators: thin forms over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm import (bpe, dartminhash, merkle, mixing, multiprobe, pii, pivots, quality, secrets, tokens,
                           toxicity, warc, whitening)
from eventflow.llm.common import table, write_cut

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                           keep=["doc_id"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"verdict.{n}").alias(n) for n in names])


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "mixed.*")


ORACLES["op9_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws(chr(1), 'mix', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, ([5.0, 2.0, 1.0])[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)]::DOUBLE AS w,
         (2 * source_size)::DOUBLE AS cap
  FROM s),
c AS (
  SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
            / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER before, 0)) AS level,
         row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS r
  FROM w WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT level FROM c WHERE cap >= level * w ORDER BY r LIMIT 1) * w, cap)) AS target
  FROM c),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, round(target)::BIGINT - epochs * source_size
         - coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    s = F.col("secrets")
    base = secrets.KINDS[:3]

    def count(kind: str):
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(kind) for kind in base],
        F.sha2(secrets.spans_text(s, base), 256).alias("base_sha256"),
        secrets.spans_text(s, secrets.KINDS).alias("spans"))


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    return bpe.decode(coded, path).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_cut(warc.write_archives(table(spark, sf_dir, "pages")), "warc")
    read = warc.read_archives(archives, with_payload=False)

    def page(uri: str):
        return F.expr(f"try_cast(substring({uri}, {len(warc.RECORD_ID) + 1}) AS bigint)")

    return read.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", page("refers_to").alias("refers_to"))


@query
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    s = F.col("spans")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.element_at(F.array(*map(F.lit, pii.KINDS)), x["place"] + 1),
            x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(place: int):
        return F.size(F.filter(s, lambda x: x["place"] == place)).cast("long")

    return found.select(
        "row.doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.BASE)],
        F.sha2(joined(F.filter(s, lambda x: x["place"] < len(pii.BASE))), 256).alias("base_sha256"),
        joined(s).alias("spans"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                            keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    altered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rows = docs.select(
        "doc_id", "source", merkle.leaf_digest(*fields, F.col("text")).alias("leaf"),
        F.when(altered, merkle.leaf_digest(*fields, F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"))
    done = merkle.manifest(rows)
    m = F.col("merkle")
    done = done.select("doc_id", "leaf", "merkle.subroot", "merkle.root",
                       F.sha2(merkle.proof(m["path"]), 256).alias("proof_sha256"),
                       merkle.fold(F.coalesce("tampered", "leaf"), m["path"]).alias("folded_root"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLES["op13_merkle_manifest"] = r"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce('=' || source, '-') AS g, sha256(head || part(text)) AS leaf,
         sha256(head || CASE WHEN doc_id IS NOT NULL AND list_reduce(
             list_prepend(4294967295::BIGINT, list_transform(range(1, len(doc_id::VARCHAR) + 1),
                          lambda i: ascii(substr(doc_id::VARCHAR, i::INTEGER, 1))::BIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(1, 9)),
               lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) % 2 = 1
           THEN part(replace(text, chr(10), '')) ELSE part(text) END) AS tampered
  FROM (SELECT *, part(doc_id::VARCHAR) || part(source) || part(lang) || part(n_chars::VARCHAR) AS head
        FROM documents)),
nodes(it, g, pos, h) AS (
  SELECT 0, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1, leaf FROM leaves
  UNION ALL
  SELECT it + 1, g, pos // 3, CASE WHEN any_value(size) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS size, max(pos) OVER () AS most FROM nodes)
  WHERE most > 0 GROUP BY it, g, pos // 3),
subroots AS (SELECT g, h FROM nodes WHERE it = (SELECT max(it) FROM nodes)),
tops(it, pos, h) AS (
  SELECT 0, row_number() OVER (ORDER BY g) - 1, h FROM subroots
  UNION ALL
  SELECT it + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, max(pos) OVER () AS most FROM tops) WHERE most > 0 GROUP BY it, pos // 3),
every AS (
  SELECT it, g, pos, h FROM nodes
  UNION ALL
  SELECT 1000 + it, '', pos, h FROM tops),
sized AS (SELECT it, g, pos, pos // 3 AS run, h, count(*) OVER (PARTITION BY it, g) AS size FROM every),
sibs AS (
  SELECT a.it, a.g, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM sized a JOIN sized b ON a.it = b.it AND a.g = b.g AND a.run = b.run
  WHERE a.size > 1 GROUP BY a.it, a.g, a.pos),
walk(it, k, g, pos, proof, f) AS (
  SELECT 0, k, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1, '', tampered FROM leaves
  UNION ALL
  SELECT w.it + 1, k, w.g, w.pos // 3, proof || coalesce(before || after, ''),
         CASE WHEN before IS NULL THEN f ELSE sha256(before || f || after) END
  FROM walk w LEFT JOIN sibs s ON s.it = w.it AND s.g = w.g AND s.pos = w.pos
  WHERE w.it < (SELECT max(it) FROM nodes)),
climb(it, k, pos, proof, f) AS (
  SELECT 0, k, t.pos, proof, f
  FROM walk w JOIN (SELECT g, row_number() OVER (ORDER BY g) - 1 AS pos FROM subroots) t ON t.g = w.g
  WHERE it = (SELECT max(it) FROM nodes)
  UNION ALL
  SELECT w.it + 1, k, w.pos // 3, proof || coalesce(before || after, ''),
         CASE WHEN before IS NULL THEN f ELSE sha256(before || f || after) END
  FROM climb w LEFT JOIN sibs s ON s.it = 1000 + w.it AND s.g = '' AND s.pos = w.pos
  WHERE w.it < (SELECT max(it) FROM tops))
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM climb JOIN leaves USING (k) JOIN subroots s USING (g)
JOIN (SELECT h FROM tops WHERE it = (SELECT max(it) FROM tops)) t ON climb.it = (SELECT max(it) FROM tops)
""".replace("part(replace(text, chr(10), ''))", "CASE WHEN text IS NULL THEN '-' ELSE "
            "strlen(replace(text, chr(10), ''))::VARCHAR || ':' || replace(text, chr(10), '') END")
for _name in ("doc_id::VARCHAR", "n_chars::VARCHAR", "source", "lang", "text"):
    ORACLES["op13_merkle_manifest"] = ORACLES["op13_merkle_manifest"].replace(
        f"part({_name})", f"CASE WHEN {_name} IS NULL THEN '-' ELSE strlen({_name})::VARCHAR || ':' || {_name} END")


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
