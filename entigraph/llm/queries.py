"""Queries over the whole tables, one for each operator, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, html_blocks, lexical, lines, manifest, neardup, packing, pieces, quality, substrings, toxicity, vecdup, vptree
from .common import table


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; the folder is a parameter (the environment's TOKENIZER_DIR or the installed package)."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, weights)
    return out.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecdup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "posterior", "score", "kept")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))
    return out.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = bytebpe.encode_ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, manifest.leaf_digest(*fields, F.replace("text", F.lit("\n"), F.lit(""))))
    out = manifest.manifest(table(spark, sf_dir, "documents"), carried={"tampered": tampered})
    siblings = F.array_join(F.transform("proof", lambda step: F.concat(step["before"], step["after"])), "")
    out = out.withColumn("proof_sha256", F.sha2(siblings, 256)).withColumn("folded_root", manifest.folded(F.coalesce("tampered", "leaf"), "proof"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_minhash_near_dedup, op2_nearest_neighbours, op3_toxicity, op4_html_extraction, op5_best_fit_packing, op6_substring_dedup, op7_embedding_near_dedup, op8_quality, op9_sentencepiece, op10_line_dedup, op11_ranked_search, op12_byte_bpe, op13_merkle_manifest)}

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x20\x09-\x0D]+'"

ORACLES: dict[str, str] = {}

ORACLES["op10_line_dedup"] = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM split),
k AS (SELECT *, translate(trim(line, {_SPACE}), {_LOWER}) AS key FROM l),
r AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE r.key IS NOT NULL AND r.keep <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (WHERE r.key IS NULL OR r.keep = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN r ON k.key = r.key GROUP BY k.doc_id
"""

ORACLES["op1_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, CASE WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END AS shs FROM w WHERE len(ws) > 0) t(doc_id, shs), unnest(shs) u(sh)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

ORACLES["op6_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS win FROM w, unnest(range(1, greatest(len(ws) - 18, 1))) u(i)),
f AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM g),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM f, range(0, 20) t(j) WHERE k > 1),
x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w)
SELECT w.doc_id, len(w.ws) AS n_words, count(gone.i) AS n_removed,
       sha256(coalesce(string_agg(x.word, ' ' ORDER BY x.i) FILTER (WHERE gone.i IS NULL), '')) AS kept_sha256
FROM w LEFT JOIN x ON x.doc_id = w.doc_id LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY w.doc_id, len(w.ws)
"""

ORACLES["op7_embedding_near_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x AS vec_id, count(*) AS n_links FROM e GROUP BY x)
SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_CRC32 = """list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT), lambda crc, b: list_reduce(
      [xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""

# t: nodes of the sources' trees, then u: of the tree over their roots; step: the siblings before and after a leaf's node.
ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE leaf AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
      FROM (SELECT doc_id, source, sha256({_FIELDS} || {_FIELD.format('text')}) AS leaf,
            CASE WHEN xor({_CRC32}, 4294967295) % 2 = 0 THEN sha256({_FIELDS} || {_FIELD.format("replace(text, chr(10), '')")}) END AS tampered FROM documents)),
t AS (SELECT source, 0 AS lvl, i, leaf AS h, n FROM leaf UNION ALL
      SELECT source, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY source, lvl, i // 3, n),
sub AS (SELECT source, lvl AS depth, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, j AS i, subroot AS h, n FROM sub UNION ALL
      SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, i // 3, n),
step AS (SELECT doc_id, leaf.source, leaf.i, t.lvl AS k, coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (WHERE t.i < leaf.i // (3 ** t.lvl)::BIGINT), '') AS a,
            coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (WHERE t.i > leaf.i // (3 ** t.lvl)::BIGINT), '') AS z
      FROM leaf JOIN t ON leaf.source IS NOT DISTINCT FROM t.source AND t.n > 1 AND t.i // 3 = leaf.i // (3 ** (t.lvl + 1))::BIGINT GROUP BY ALL
      UNION ALL SELECT doc_id, leaf.source, leaf.i, sub.depth + u.lvl, coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (WHERE u.i < sub.j // (3 ** u.lvl)::BIGINT), ''),
            coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (WHERE u.i > sub.j // (3 ** u.lvl)::BIGINT), '')
      FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source JOIN u ON u.n > 1 AND u.i // 3 = sub.j // (3 ** (u.lvl + 1))::BIGINT GROUP BY ALL),
fold AS (SELECT source, i, 0 AS k, coalesce(tampered, leaf) AS h FROM leaf UNION ALL
      SELECT fold.source, fold.i, fold.k + 1, sha256(a || h || z) FROM fold JOIN step ON fold.source IS NOT DISTINCT FROM step.source AND fold.i = step.i AND fold.k = step.k),
proof AS (SELECT source, i, string_agg(a || z, '' ORDER BY k) AS p FROM step GROUP BY ALL)
SELECT leaf.doc_id, leaf.leaf, sub.subroot, u.h AS root, sha256(coalesce(proof.p, '')) AS proof_sha256, last.h AS folded_root, last.h = u.h AS verified
FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source JOIN u ON u.n = 1
LEFT JOIN proof ON leaf.source IS NOT DISTINCT FROM proof.source AND leaf.i = proof.i
JOIN (SELECT source, i, arg_max(h, k) AS h FROM fold GROUP BY ALL) last ON leaf.source IS NOT DISTINCT FROM last.source AND leaf.i = last.i
"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

ORACLES["op11_ranked_search"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_TERM}) AS ts FROM documents),
s AS (SELECT count(*) AS docs, sum(len(ts))::BIGINT AS tokens FROM d WHERE len(ts) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_TERM})) AS t FROM benchmark),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t, docs),
x AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(ts) * docs) // tokens))))::BIGINT AS score
      FROM q JOIN w USING (t) JOIN tf USING (t) JOIN d USING (r), s GROUP BY item_id, doc_id, r),
y AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 50
"""
