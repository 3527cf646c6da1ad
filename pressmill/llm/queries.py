"""The registered queries of the operators in this folder, over whole tables, with SQL where it can say the same."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from pressmill.llm import audit, bpe, embeddings, language, leaks, lines, manifest, mixing, near_documents, quality, repeats, token_files, topk
from pressmill.llm.common import table
from pressmill.session import checkpoint_dir


def op1_language_mixture(spark, sf_dir):
    """Language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2)
    languages, shares = language.learn(docs.where(~F.col("held_out")))
    return language.predict(docs, languages, shares, keep=("held_out",)).select(
        F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


def op2_embedding_near_duplicates(spark, sf_dir):
    """Links and components of the vectors of each label."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op3_exact_top_k(spark, sf_dir):
    """Ten best rows by integer inner product for every hundredth vector."""
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows.where("vec_id % 100 = 0"), rows)


def op4_mixture_weights(spark, sf_dir):
    """Raked probabilities and the sample of all documents."""
    out = mixing.mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    return out.withColumn("probability", F.round("probability", 6)).withColumn("weight", F.round("weight", 3))


def op5_repeated_passages(spark, sf_dir):
    """Bytes of every document that lie in strings of 100 bytes which also start earlier."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_files(spark, sf_dir):
    """Writes all documents as token files and reads them back."""
    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    read = token_files.crc32_column(token_files.read_tokens(spark, path))
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op7_bpe_round_trip(spark, sf_dir):
    """Encodes and decodes every document."""
    out = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op8_line_dedup(spark, sf_dir):
    """Lines and removed lines of every document, and a digest of what remains."""
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op9_ngram_jaccard_join(spark, sf_dir):
    """Components of near-duplicate documents."""
    return near_documents.near_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_weak_quality(spark, sf_dir):
    """Score of every document by the scorer trained on the labellers' verdicts."""
    out = quality.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("row")
    return out.withColumnRenamed("id", "doc_id")


def op11_merkle_manifest(spark, sf_dir):
    """Leaf, proof and check of every document against the root over all sources; some texts are tampered with."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents")
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    tampered = F.unhex(manifest.leaf(*(F.translate("text", letters, letters.lower()) if c == "text" else F.col(c) for c in columns)))
    built = manifest.build(docs, columns, keep={"doc_id": F.col("doc_id"), "tampered": F.when(touched, tampered)})
    out = manifest.prove(built, digest=F.coalesce("row.tampered", "digest"))
    hexed = {c: F.lower(F.hex(c)) for c in ("digest", "subroot", "root")}
    return out.select("row.doc_id", hexed["digest"].alias("leaf"), hexed["subroot"].alias("subroot"), hexed["root"].alias("root"),
                      "proof_sha256", F.col("folded").alias("folded_root"), (F.col("folded") == hexed["root"]).alias("verified"))


def op12_benchmark_decontamination(spark, sf_dir):
    """Words of every document that lie in windows of benchmark items, and those items."""
    out = leaks.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"])
    return out.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def op13_source_divergence(spark, sf_dir):
    """Distances between the sources of each language, and the terms that each uses beyond it."""
    return audit.audit(table(spark, sf_dir, "documents"))


SQL_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
 FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s) WHERE n <= 10
"""


def _sql_manifest(source_levels: int = 6, root_levels: int = 4) -> str:
    """The tree, level by level, for up to 16 ** levels leaves."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    field = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    head = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    steps = [f"""a AS (SELECT doc_id, source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
 sha256({head} || {field.format("text")}) AS leaf, sha256({head} || {field.format(lower)}) AS other,
 xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc FROM documents)""",
             "l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM a)",
             "t0 AS (SELECT g, i, leaf AS d FROM l)"]

    def tree(name: str, levels: int) -> None:
        for k in range(levels):
            steps.append(f"{name}r{k} AS (SELECT g, i // 16 AS r, list(d ORDER BY i) AS ds FROM {name}{k} WHERE g IN "
                         f"(SELECT g FROM {name}{k} GROUP BY g HAVING count(*) > 1) GROUP BY ALL)")
            steps.append(f"{name}{k + 1} AS (SELECT g, r AS i, sha256(array_to_string(ds, '')) AS d FROM {name}r{k})")
        one = " UNION ALL ".join(f"SELECT g, any_value(d) AS d FROM {name}{k} GROUP BY g HAVING count(*) = 1" for k in range(levels + 1))
        steps.append(f"{name}top AS ({one})")

    tree("t", source_levels)
    steps.append("u0 AS (SELECT 0 AS g, g AS i, d FROM ttop)")
    tree("u", root_levels)
    steps.append("p0 AS (SELECT l.*, CASE WHEN crc % 5 = 0 THEN other ELSE leaf END AS x, '' AS s FROM l)")
    ways = [(f"tr{k}", "p.g", f"(p.i >> {4 * k})") for k in range(source_levels)] + [
        (f"ur{k}", "0", f"(p.g >> {4 * k})") for k in range(root_levels)]
    for k, (runs, g, at) in enumerate(ways):
        rest = f"ds[:{at} % 16]", f"ds[{at} % 16 + 2:]"
        steps.append(f"""p{k + 1} AS (SELECT p.* EXCLUDE (x, s), CASE WHEN ds IS NULL THEN x ELSE sha256(array_to_string({rest[0]} || [x] || {rest[1]}, '')) END AS x,
 s || coalesce(array_to_string({rest[0]} || {rest[1]}, ''), '') AS s FROM p{k} p LEFT JOIN {runs} r ON r.g = {g} AND r.r = {at} // 16)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, ttop.d AS subroot, utop.d AS root, sha256(s) AS proof_sha256, x AS folded_root, x = utop.d AS verified
FROM p{len(ways)} JOIN ttop USING (g) CROSS JOIN utop"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALPHANUMERIC = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SQL_LEAKS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_ALPHANUMERIC}) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, {_ALPHANUMERIC}) AS w FROM benchmark),
iw AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS passage FROM (
 SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT r, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS passage FROM (
 SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
hit AS (SELECT DISTINCT r, k, p, item FROM dw JOIN iw USING (k, passage)),
n AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + k)) AS at FROM hit) GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""


SQL_AUDIT = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
 regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM (SELECT DISTINCT r, lang, term FROM o) GROUP BY ALL HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
a AS (SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total,
  sum(coalesce(n, 0)) OVER (PARTITION BY lang, term) AS lang_n, sum(coalesce(n, 0)) OVER (PARTITION BY lang) AS lang_total
 FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (total + 5 * v) AS p,
 1 + (1000000000 * CAST(lang_n + 5 AS HUGEINT)) // (lang_total + 5 * v) AS q FROM a JOIN v USING (lang)),
x AS (SELECT l.lang, l.source, 'pair' AS part, r.source AS item, coalesce(value, 0) AS value
 FROM g l JOIN g r ON l.lang = r.lang AND l.source <> r.source LEFT JOIN (
  SELECT s.lang, s.source, t.source AS item, sum(abs(s.p - t.p)) AS value FROM p s JOIN p t ON s.lang = t.lang AND s.term = t.term
  GROUP BY ALL) f ON f.lang = l.lang AND f.source = l.source AND f.item = r.source
 UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x) WHERE part = 'pair' OR rank <= 50
"""


def queries():
    return {f.__name__: f for f in (
        op1_language_mixture, op2_embedding_near_duplicates, op3_exact_top_k, op4_mixture_weights, op5_repeated_passages, op6_token_files,
        op7_bpe_round_trip, op8_line_dedup, op9_ngram_jaccard_join, op10_weak_quality, op11_merkle_manifest,
        op12_benchmark_decontamination, op13_source_divergence)}


def oracle_sql():
    return {"op3_exact_top_k": SQL_TOP_K, "op4_mixture_weights": mixing.oracle(),
            "op11_merkle_manifest": _sql_manifest(), "op12_benchmark_decontamination": SQL_LEAKS,
            "op13_source_divergence": SQL_AUDIT}
