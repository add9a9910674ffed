"""The registered queries of the training-data operators and their SQL.

Each query applies its operator, with production parameters, to its whole
table. Vocabulary files come from the installed ``public_tokenizers`` package.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blockjoin, bpe, centroids, kdtree, linededup, neardup, ngrams, packing, quality, separators, toxicity, trie, warc
from .common import fold, prepare, read_table

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
BYTE_BPE = "byte_bpe_50k.json"
END_OF_TEXT = 50256  # of BYTE_BPE


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts encoded by merge replay and decoded again, as digests."""
    docs = read_table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    archives = warc.write(read_table(spark, sf_dir, "pages"))
    return warc.read(archives, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per document, counted between separators of flat token files."""
    docs = read_table(spark, sf_dir, "documents")
    return separators.document_counts(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, END_OF_TEXT).select("doc_id", "n_tokens")


def _judged(scores: DataFrame, cut: float) -> DataFrame:
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(True))
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def op4_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; a fifth of the labels is held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return _judged(quality.scored(docs, labels, fold(F.col("doc_id")) != 0), quality.CUT)


def op5_recurrent_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; a fifth of the labels is held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return _judged(toxicity.scored(docs, labels, fold(F.col("doc_id")) != 0), toxicity.CUT)


def op6_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one, by int8 tiles and bounds."""
    return blockjoin.search(read_table(spark, sf_dir, "embeddings"), divisor=20, k=20)


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into sequences of binary lengths."""
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, with_ids=False)


def op9_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best whole-number inner products of every fiftieth vector."""
    return kdtree.search(read_table(spark, sf_dir, "embeddings"), divisor=50, k=5)


def op10_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every whole text; a fifth of the texts is held out."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(True))
    return ngrams.score(docs, ~held).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_cuckoo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least three documents go, but for the largest document's."""
    docs = read_table(spark, sf_dir, "documents")
    kept = linededup.LineIndex(spark).insert(docs).clean(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", linededup.text_sha256("kept").alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    turns = trie.rebuilt(trie.numbered(read_table(spark, sf_dir, "conversations")))
    return trie.nodes(turns).drop("digest")


def op13_vantage_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rounds of clustering all vectors around eight centroids."""
    return centroids.cluster(read_table(spark, sf_dir, "embeddings")).drop("centroid")


OP2_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, url, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
     r AS (SELECT payload_digest, max(page_id) AS newest FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, url, payload_bytes, payload_digest,
       CASE WHEN newest IS NULL OR newest = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN newest <> page_id THEN newest END AS refers_to
FROM d LEFT JOIN r USING (payload_digest)
"""

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND vec_id IS NOT NULL"

OP6_SQL = f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
           WHERE {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score,
                  row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS rank
           FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM s WHERE rank <= 20
"""

OP9_SQL = f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE {_FINITE}),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score,
                  row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS rank
           FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM s WHERE rank <= 5
"""

OP11_SQL = """
WITH l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
           FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
     k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     m AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
     j AS (SELECT k.*, coalesce(m.keeper <> k.doc_id, false) AS gone FROM k LEFT JOIN m USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY r
"""

# crc32 bit by bit; a node is known by the digests of its turns, one after the other
OP12_SQL = """
WITH RECURSIVE o AS (SELECT conv_id, md, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md) - 1 AS pos FROM (
         SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
                sha256(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS md
         FROM conversations WHERE conv_id IS NOT NULL)),
     crc(conv_id, s, i, v) AS (
         SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM o
         UNION ALL
         SELECT conv_id, s, i + 1, CASE WHEN w & 1 = 1 THEN xor(w >> 1, CAST(3988292384 AS BIGINT)) ELSE w >> 1 END
         FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ord(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END AS w FROM crc WHERE i < 8 * length(s))),
     h AS (SELECT conv_id, xor(v, CAST(4294967295 AS BIGINT)) % 9 AS h FROM crc WHERE i = 8 * length(s)),
     b AS (SELECT h.conv_id, o.pos, o.md, o.bytes FROM h JOIN o ON o.conv_id = h.conv_id - h.conv_id % 5 AND o.pos < h.h
           UNION ALL SELECT o.conv_id, o.pos, o.md, o.bytes FROM h JOIN o ON o.conv_id = h.conv_id AND o.pos >= h.h),
     p AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(md, '') OVER w AS key, bytes FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
           UNION ALL SELECT conv_id, 0, '', 0 FROM h),
     n AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM p GROUP BY key, depth),
     c AS (SELECT left(key, 64 * (depth - 1)) AS key, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
     e AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
           FROM (SELECT conv_id, arg_max(key, depth) AS key FROM p GROUP BY conv_id) GROUP BY key),
     t AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM n LEFT JOIN c USING (key)),
     s AS (SELECT a.key, count(*) FILTER (WHERE z.n_children = 0) AS n_leaves, CAST(sum((z.n_convs - 1) * z.bytes) AS BIGINT) AS saved_tokens
           FROM t a JOIN t z ON starts_with(z.key, a.key) GROUP BY a.key)
SELECT t.conv_id, t.depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM t JOIN s USING (key) LEFT JOIN e USING (key) LEFT JOIN n u ON t.depth > 0 AND u.key = left(t.key, 64 * (t.depth - 1))
"""


def _op13_sql(rounds: int = centroids.ROUNDS) -> str:
    """One step a round; floor division is spelt out, ties go to the smaller number."""
    gap = "CAST(list_sum(list_transform(list_zip(x.v, y.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [f"""a{i} AS MATERIALIZED (SELECT x.r, x.vec_id, x.v, min([{gap}, y.c]) AS best FROM x JOIN c{i} y ON true GROUP BY x.r, x.vec_id, x.v)""" for i in range(rounds + 1)]
    moves = [f"""s{i} AS (SELECT best[2] AS c, p, CAST(sum(e) AS BIGINT) AS s, count(*) AS n FROM (SELECT best, unnest(v) AS e, generate_subscripts(v, 1) AS p FROM a{i - 1}) GROUP BY 1, 2),
     c{i} AS MATERIALIZED (SELECT y.c, coalesce(m.v, y.v) AS v FROM c{i - 1} y LEFT JOIN (
         SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS v FROM s{i} GROUP BY c) m USING (c))""" for i in range(1, rounds + 1)]
    ctes = [steps[0]] + [x for pair in zip(moves, steps[1:]) for x in pair]
    return f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({centroids.SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE {_FINITE} AND len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda e: abs(e) >= {centroids.LARGEST})) = 0),
     c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c, v FROM x QUALIFY c < {centroids.K}),
     {""",
     """.join(ctes)}
SELECT a.vec_id, CAST(a.best[2] AS INTEGER) AS cluster, a.best[1] AS distance, CAST(sum(a.best[1]) OVER (PARTITION BY a.best[2]) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.best[2]
"""


OP13_SQL = _op13_sql()

QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_warc, op3_token_counts, op4_bradley_terry, op5_recurrent_network, op6_block_matrix_join, op7_bottom_k, op8_packing, op9_kd_trees, op10_backoff_automaton, op11_cuckoo_lines, op12_prefix_trie, op13_vantage_clusters)}
ORACLE = {"op2_warc": OP2_SQL, "op6_block_matrix_join": OP6_SQL, "op9_kd_trees": OP9_SQL, "op11_cuckoo_lines": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_vantage_clusters": OP13_SQL}


def _with_folder(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def all_queries() -> dict:
    return {k: _with_folder(q) for k, q in QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return dict(ORACLE)
