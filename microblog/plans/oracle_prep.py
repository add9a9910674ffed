"""Oracles for preparation, vocabulary, batches, scores and keyed sinks."""

from __future__ import annotations

from . import sqlfrag as S
from .catalog_ml import COUNTED_CLASSES
from .catalog_prep import HEAD_EXAMPLES, LOOKUP_EVENT, NEW_VERSION, VERSIONS
from .oracle import oracle
from ..functions.labels import DOC_KEY_SUFFIX
from ..operators.prep import NA_VALUES
from ..operators.vocab import BATCH_SIZE
from ..schema import edge_rows_sql, sql_str

EX = S.with_(S.examples_cte())
LAB = S.with_(S.LABELLED)
NA = "[" + ", ".join(sql_str(v) for v in NA_VALUES) + "]"

oracle("rename_drop", LAB + "SELECT sentiment, tweet FROM labelled")
oracle("label_remap", LAB + f"SELECT id, {S.remap('sentiment')} AS label FROM labelled")

_EDGES = f""", rows AS (SELECT id, tweet FROM labelled UNION ALL SELECT id, tweet FROM {edge_rows_sql()}),
c AS (SELECT id, {S.clean_full('tweet')} AS tweet FROM rows)
"""
oracle("drop_missing", LAB + _EDGES + f"SELECT id, tweet FROM c WHERE tweet IS NOT NULL AND NOT list_contains({NA}, tweet)")
oracle("drop_blank", LAB + _EDGES + f"""SELECT id, tweet FROM c WHERE tweet IS NOT NULL AND NOT list_contains({NA}, tweet)
AND NOT {S.is_blank('tweet')}""")
oracle("prepared_examples", EX + "SELECT id, label, text AS tweet FROM examples ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id LIMIT 1000")
oracle("prepared_head", EX + f"SELECT id, label, text AS tweet FROM examples ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id LIMIT {HEAD_EXAMPLES}")
oracle("preview", LAB + "SELECT sentiment, tweet FROM (SELECT id, sentiment, tweet FROM labelled ORDER BY id LIMIT 5)")
oracle("csv_rescan", LAB + _EDGES + f"SELECT id, tweet FROM c WHERE tweet IS NOT NULL AND NOT list_contains({NA}, tweet)")
oracle("examples_csv_raw", LAB + f"SELECT {S.remap('sentiment')} AS label, tweet AS text FROM labelled")
oracle("head_n", LAB + "SELECT id, tweet FROM labelled ORDER BY id LIMIT 100")
oracle("split_70_30", LAB + "SELECT id, md5(CAST(id AS VARCHAR)) < 'b333' AS is_train FROM labelled")
oracle("split_70_30_long_ids", LAB + """SELECT 1312534567590000000 + id AS id,
md5(CAST(1312534567590000000 + id AS VARCHAR)) < 'b333' AS is_train FROM labelled""")
oracle("prep_pipeline", EX + """SELECT id, label, text AS tweet,
row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) AS pos FROM examples""")
oracle("labelled_csv_scan", LAB + "SELECT sentiment, id, date, query, \"user\", tweet FROM labelled")
oracle("shuffle_rows", LAB + """SELECT id, tweet, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) AS pos
FROM labelled""")
oracle("function_scores", LAB + f""", served AS (
  SELECT id, {S.clean_serving('tweet')} AS text FROM labelled UNION ALL SELECT id, {S.clean_serving('tweet')} FROM {edge_rows_sql()})
SELECT id, CAST(CASE WHEN len({S.ws_tokens('text')}) = 0 THEN -1 ELSE (length(text) - length(replace(text, ' ', ''))) % {COUNTED_CLASSES} END AS INTEGER) AS sentiment
FROM served""")
oracle("csv_scan_roundtrip", EX + "SELECT label, text FROM examples")

VOCAB = f""", freq AS (
  SELECT token, count(*) AS freq FROM (SELECT unnest({S.ws_tokens('text')}) AS token FROM train) GROUP BY token),
vocab AS (SELECT token, freq, CAST(row_number() OVER (ORDER BY freq DESC, token) + 1 AS BIGINT) AS idx FROM freq)
"""


def _enc(src: str) -> str:
    return f""", tok AS (
  SELECT id, unnest({S.ws_tokens('text')}) AS token, unnest(range(len({S.ws_tokens('text')}))) AS pos FROM {src}),
enc AS (
  SELECT t.id, string_agg(CAST(coalesce(v.idx, 0) AS VARCHAR), ' ' ORDER BY t.pos) AS ids,
         string_agg(CASE WHEN v.idx IS NULL THEN '<unk>' ELSE t.token END, ' ' ORDER BY t.pos) AS decoded,
         CAST(count(*) AS INTEGER) AS n_tokens
  FROM tok t LEFT JOIN vocab v USING (token) GROUP BY t.id)
"""


oracle("vocab_build", EX + VOCAB + "SELECT token, freq, idx FROM vocab")
oracle("vocab_size", EX + VOCAB + "SELECT count(*) + 2 AS n FROM vocab")
oracle("label_counts", EX + "SELECT label, count(*) AS n FROM train GROUP BY label")
oracle("vocab_encode", EX + VOCAB + _enc("examples") + "SELECT id, ids, n_tokens FROM enc")
oracle("encode_1xn", EX + VOCAB + ", " + S.TWEETS.strip() + f""",
served AS (SELECT id_str AS id, {S.clean_serving('text')} AS text FROM tweets)""" + _enc("served") + """
SELECT id, CAST(1 AS INTEGER) AS n_rows, n_tokens AS n_cols, ids FROM enc""")
oracle("vocab_decode", EX + VOCAB + _enc("examples") + "SELECT id, decoded AS text FROM enc")
oracle("vocab_roundtrip", EX + VOCAB + """SELECT '<unk>' AS token, CAST(0 AS BIGINT) AS idx
UNION ALL SELECT '<pad>', CAST(1 AS BIGINT) UNION ALL SELECT token, idx FROM vocab""")

_BATCH = f""", r AS (SELECT id, ids, n_tokens, (row_number() OVER (ORDER BY n_tokens, id) - 1) // {BATCH_SIZE} AS batch
FROM enc)
"""
oracle("length_batches", EX + VOCAB + _enc("train") + _BATCH + """SELECT id, CAST(batch AS BIGINT) AS batch,
row_number() OVER (PARTITION BY batch ORDER BY n_tokens DESC, id) AS pos FROM r""")
oracle("pad_batches", EX + VOCAB + _enc("train") + _BATCH + """SELECT id,
ids || repeat(' 1', CAST(max(n_tokens) OVER (PARTITION BY batch) - n_tokens AS INTEGER)) AS padded, n_tokens FROM r""")

SCORES = """WITH sc AS (
  SELECT doc_id AS id, [CAST(quality AS DOUBLE), CAST(toxic AS DOUBLE), 0.5] AS s,
         CAST(CASE WHEN quality = 1 AND toxic = 0 THEN 2 WHEN quality = 1 THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM labels)
"""
oracle("argmax_class", SCORES + "SELECT id, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS sentiment FROM sc")
oracle("cross_entropy", SCORES + """SELECT round(avg(ln(exp(s[1]) + exp(s[2]) + exp(s[3])) - list_extract(s, label + 1)), 6) AS ce
FROM sc""")
oracle("insert_if_absent", S.with_(S.TWEETS) + f"""SELECT id_str || {sql_str(DOC_KEY_SUFFIX)} AS _id,
CASE WHEN event_id % 2 = 0 THEN text ELSE text || {sql_str(NEW_VERSION)} END AS text FROM tweets""")
oracle("document_table_fold", S.with_(S.TWEETS) + f"""SELECT id_str || {sql_str(DOC_KEY_SUFFIX)} AS _id,
text || CASE WHEN event_id % {VERSIONS[2]} = 0 THEN ' (v3)' WHEN event_id % {VERSIONS[1]} = 0 THEN ' (v2)' ELSE '' END AS text FROM tweets""")
oracle("point_lookup", S.with_(S.TWEETS) + f"""SELECT id_str || {sql_str(DOC_KEY_SUFFIX)} AS _id, text FROM tweets
WHERE event_id = {LOOKUP_EVENT}""")

# every test row must get the same class from the reloaded model
oracle("sentiment_model_roundtrip", EX + "SELECT count(*) AS n_equal FROM examples WHERE md5(CAST(id AS VARCHAR)) >= 'b333'")
oracle("sentiment_train_eval", EX + "SELECT count(*) AS n, true AS below_uniform FROM examples WHERE md5(CAST(id AS VARCHAR)) >= 'b333'")
oracle("dead_letter_rows", S.with_(S.TWEETS) + """SELECT event_id AS "offset",
CASE WHEN event_id % 10 = 1 THEN 'not json' ELSE '{"id_str":"' || id_str || '","user":{"verified":' || CAST(verified AS VARCHAR)
  || ',"followers_count":' || CAST(followers_count AS VARCHAR) || ',"friends_count":' || CAST(friends_count AS VARCHAR) || '}}' END AS "value",
CASE WHEN event_id % 10 = 1 THEN 'bad_json' ELSE 'missing_field' END AS reason
FROM tweets WHERE event_id % 10 IN (0, 1)""")
