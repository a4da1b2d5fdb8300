"""The queries of the operators over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, cotraining, decontaminate, forest, media, packing, pfor, ppm, sharding, simhash, templates, urls, whitening


#: Noisy copies of vectors: their number, of each how manyth, and how much of each entry's neighbour is added.
COPIES = ((1, 5, 0.3), (2, 10, 0.44))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), 24)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "n_tokens",
    )


def op2_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.train(pages))


def op5_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pfor.encode_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract_text(table(spark, sf_dir, "pages"))


def op11_signature_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents"))


def op12_tiled_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def shard_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operator 1's result must add up to: totals, gapless slots, no split text that fits a shard, shards a text apart at most."""
    out = sharding.shard(table(spark, sf_dir, "documents"), 24)
    by_shard = out.groupBy("shard").agg(
        F.sum("size").alias("b"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("slot").alias("slots"),
        F.max("slot").alias("last"),
    )
    spread = by_shard.agg(
        (F.max("b") - F.min("b")).alias("spread"),
        F.bool_and((F.col("slots") == F.col("n")) & (F.col("last") == F.col("n") - 1)).alias("gapless"),
    )
    totals = out.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("size").alias("bytes"),
        F.sum("n_tokens").alias("n_tokens"),
        F.max("size").alias("largest"),
    )
    groups = out.groupBy("text_crc32", "size").agg(
        F.countDistinct("shard").alias("shards"),
        F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("b"),
        F.sum("n_tokens").alias("t"),
    )
    fits = (F.col("n") * 24 <= F.col("n_rows")) & (F.col("b") * 24 <= F.col("bytes")) & (F.col("t") * 24 <= F.col("all_tokens"))
    whole = groups.join(totals.select("n_rows", "bytes", F.col("n_tokens").alias("all_tokens"))).agg(F.bool_and((F.col("shards") == 1) | ~fits).alias("whole"))
    return totals.join(spread).join(whole).select(
        "n_rows",
        "bytes",
        "n_tokens",
        "gapless",
        "whole",
        (F.col("spread") <= F.col("largest")).alias("even"),
    )


def base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of operator 2 that word counts alone settle."""
    out = ppm.score(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 3).alias("base_score"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of operator 4 that the rules settle; ``ruled`` is the verdict where a rule fits."""
    out = op4_url_filter(spark, sf_dir)
    return out.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled"))


def packing_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operator 7's result must add up to: totals, and no bin that is too full, clashes or has gaps."""
    out = op7_best_fit_packing(spark, sf_dir)
    bins = out.groupBy("bin_id").agg(
        F.sum("n_tokens").alias("tokens"),
        F.max(F.col("bin_offset") + F.col("n_tokens")).alias("end"),
        (F.count("source") - F.countDistinct("source")).alias("sources"),
        (F.count("cluster") - F.countDistinct("cluster")).alias("clusters"),
    )
    bad = bins.agg(*[F.count_if(c).alias(n) for n, c in (("too_full", F.col("tokens") > 2048), ("gaps", F.col("tokens") != F.col("end")), ("clashes", F.col("sources") + F.col("clusters") > 0))])
    totals = out.agg(F.countDistinct("doc_id").alias("n_docs"), F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"))
    return totals.join(bad)


def linked_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over the vectors and noisy copies of some, as the tables' own have no links: every fifth turned by a third, every tenth by more."""
    own = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda c: c.cast("double")).alias("v"))
    turned = lambda a: F.transform("v", lambda c, i: c + a * F.element_at("v", F.when(i == 0, -1).otherwise(i)))
    copies = [own.where(f"vec_id % {k} = 0").select((F.col("vec_id") + m * 1_000_000).alias("vec_id"), turned(a).alias("v")) for m, k, a in COPIES]
    return forest.near_duplicates(own.unionByName(copies[0]).unionByName(copies[1]), vector_col="v")


def media_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of operator 11 that don't depend on the format."""
    return op11_signature_sniffing(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def vector_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of operator 12 that sums settle."""
    return op12_tiled_whitening(spark, sf_dir).select("vec_id", "component", "n", "deviation")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_vector_bin_packing,
        op2_ppm_scoring,
        op3_decontamination,
        op4_url_filter,
        op5_pfor_tokens,
        op6_cotraining,
        op7_best_fit_packing,
        op8_simhash,
        op9_projection_forest,
        op10_html_extraction,
        op11_signature_sniffing,
        op12_tiled_whitening,
        op13_filter_audit,
        shard_laws,
        base_scores,
        url_rules,
        packing_laws,
        linked_vectors,
        media_payloads,
        vector_deviations,
    )
}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Plain containment of five-word shingles, without any search structure.
CONTAINMENT_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, list_slice(w, i, i + least(5, len(w)) - 1) AS s
       FROM b, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 4))) AS i) WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s
       FROM d, LATERAL (SELECT unnest(generate_series(1, len(w) - 4)) AS i)),
n AS (SELECT item_id, count(*) AS k FROM bs GROUP BY item_id)
SELECT doc_id, item_id, max(k)::BIGINT AS item_shingles, count(*)::BIGINT AS shared, count(*)::DOUBLE / max(k) AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * max(k)
"""

#: All pairs by cosine, and the smallest id that links reach.
LINKED_SQL = """
WITH RECURSIVE e AS ({vectors}),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT vec_id, vec_id AS c FROM e UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = r.vec_id)::BIGINT AS n_links, min(c) AS component_id, vec_id = min(c) AS kept
FROM r GROUP BY vec_id
"""
VECTORS_SQL = "SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings"
COSINE_SQL = LINKED_SQL.format(vectors=VECTORS_SQL)
COPIES_SQL = "".join(
    f" UNION ALL SELECT vec_id + {m * 1_000_000}, list_transform(v, lambda c, i: c + {a} * v[CASE WHEN i = 1 THEN len(v) ELSE i - 1 END]) FROM ({VECTORS_SQL}) WHERE vec_id % {k} = 0"
    for m, k, a in COPIES
)

WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+')"

SHARD_SQL = f"""
SELECT count(*) AS n_rows, sum(octet_length(encode(coalesce(text, ''))) + 8)::BIGINT AS bytes, sum(len({WORDS_SQL}))::BIGINT AS n_tokens,
       true AS gapless, true AS whole, true AS even
FROM documents
"""

#: The polynomial's remainder byte by byte and bit by bit, of the id's digits.
CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

#: Add-one unigrams over words and ends.
BASE_SQL = f"""
WITH d AS (SELECT doc_id, {CRC_SQL} % 7 = 2 AS held_out, list_append({WORDS_SQL}, chr(10)) AS w FROM documents),
t AS (SELECT doc_id, held_out, unnest(w) AS word FROM d),
c AS (SELECT word, count(*) AS c FROM t WHERE NOT held_out GROUP BY word),
n AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
SELECT t.doc_id, t.held_out, count(*) AS n_tokens, count(c.c) AS n_known, max(n.n)::BIGINT AS train_tokens,
       round(sum(log10((coalesce(c.c, 0) + 1) / (n.n + n.v + 1)::DOUBLE)), 3) AS base_score
FROM t CROSS JOIN n LEFT JOIN c USING (word) GROUP BY t.doc_id, t.held_out
"""

RULES_SQL = f"""
WITH r(ruled, rule_host, rule_path) AS (VALUES {", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in urls.RULES)}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, regexp_extract(rest, '^[^?#]*') AS part FROM u),
h AS (SELECT page_id, translate(regexp_extract(part, '^[^/]*'), '{UPPER}', '{UPPER.lower()}') AS host, regexp_extract(part, '^[^/]*(.*)$', 1, 's') AS path FROM p)
SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(ruled, length(rule_host || rule_path)) AS ruled
FROM h LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id, host, path
"""

PACKING_SQL = f"""
WITH d AS (SELECT doc_id, len({WORDS_SQL}) + 1 AS n FROM documents)
SELECT count(DISTINCT doc_id) AS n_docs, sum((n + 2047) // 2048)::BIGINT AS n_pieces, sum(n)::BIGINT AS n_tokens, 0::BIGINT AS too_full, 0::BIGINT AS gaps, 0::BIGINT AS clashes FROM d
"""

PAYLOAD_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
p AS (SELECT doc_id, octet_length(t) AS n, CASE WHEN octet_length(t) = 0 THEN 576 ELSE (octet_length(t) + 575) // 576 * 576 END AS m, t FROM d)
SELECT doc_id, n AS n_bytes, m AS payload_bytes, sha256(t || unhex(repeat('FF', (m - n)::BIGINT))) AS payload_sha256 FROM p
"""

#: Whole numbers of each dimension, and their exact distance from the sums; 32 components of 64 dimensions.
DEVIATION_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)::BIGINT + 1000000) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))),
e AS (SELECT vec_id, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM v),
s AS (SELECT i, sum(x) AS s, count(*) AS n FROM e GROUP BY i),
d AS (SELECT vec_id, max(n)::BIGINT AS n, sum((n * x - s) * (n * x - s))::BIGINT AS deviation FROM e JOIN s USING (i) GROUP BY vec_id)
SELECT vec_id, component::INT AS component, n, deviation FROM d CROSS JOIN generate_series(1, 32) AS c(component)
"""

#: Each document's failures, and what each step of each order does with it, counted.
AUDIT_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
         regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails
      FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
h AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM a p, a q, a r, a s, a t
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
k AS (SELECT filter_order, step::INT AS step, ascii(filter_order[step]) - 64 AS own,
        list_transform(range(1, step), lambda i: ascii(filter_order[i]) - 64) AS before FROM o, generate_series(1, 5) AS s(step)),
c AS (SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS here, fails,
        len(list_filter(before, lambda i: fails[i])) > 0 AS gone FROM h, k),
r AS (SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (WHERE NOT here AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE here AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE here AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE here AND len(list_filter(fails, lambda x: x)) = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (WHERE here AND NOT gone), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (WHERE here AND NOT gone), 0)::BIGINT AS toxic_lost
      FROM c GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM r
"""

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": CONTAINMENT_SQL,
    "op9_projection_forest": COSINE_SQL,
    "shard_laws": SHARD_SQL,
    "base_scores": BASE_SQL,
    "url_rules": RULES_SQL,
    "packing_laws": PACKING_SQL,
    "linked_vectors": LINKED_SQL.format(vectors=VECTORS_SQL + COPIES_SQL),
    "op13_filter_audit": AUDIT_SQL,
    "media_payloads": PAYLOAD_SQL,
    "vector_deviations": DEVIATION_SQL,
}
