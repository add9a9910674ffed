"""DuckDB SQL oracles, one per catalogue query (same output column names).

Sliding windows are stated here by brute force (a range join of change points
against panes) rather than with the delta/running-sum rewrite the Spark plan
uses, so the two sides are independent.
"""

from __future__ import annotations

from . import sqlfrag as S
from .catalog import DENSE_SLIDE, DENSE_WIDTH, PHRASE_WORDS
from ..functions.labels import DOC_KEY_PATTERN, DOC_KEY_SUFFIX
from ..operators.topics import TRACK_TERMS
from ..operators.windows import WIDTH
from ..schema import sql_str

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


TW = S.with_(S.TWEETS)

GOOD_MESSAGE = "SELECT id_str, text, verified, followers_count, friends_count FROM tweets"

oracle("tweets_base", TW + "SELECT id_str, sec, lang, text, verified, followers_count, friends_count FROM tweets")
oracle("kafka_envelope_value", TW + "SELECT id_str, CAST(length(text) AS BIGINT) AS value_len FROM tweets")
oracle("kafka_sink_payload", TW + f"""SELECT id_str, text, 'here' AS place, verified, followers_count, friends_count
FROM tweets WHERE {S.term_match('text', TRACK_TERMS)}""")
oracle("json_extract_message", TW + GOOD_MESSAGE)
oracle("json_extract_id_text", TW + "SELECT id_str, text FROM tweets")
oracle("user_fields", TW + "SELECT id_str, verified, followers_count FROM tweets")
oracle("dead_letter_split", TW + """
, env AS (
  SELECT CASE WHEN event_id % 10 = 1 THEN 'not json'
              WHEN event_id % 10 = 0 THEN CAST(to_json({'id_str': id_str, 'user': {'verified': verified,
                     'followers_count': followers_count, 'friends_count': friends_count}}) AS VARCHAR)
              ELSE CAST(to_json({'id_str': id_str, 'text': text, 'user': {'verified': verified,
                     'followers_count': followers_count, 'friends_count': friends_count}}) AS VARCHAR) END AS value
  FROM tweets)
SELECT CASE WHEN NOT json_valid(value) THEN 'bad_json'
            WHEN try(json_extract_string(value, '$.id_str')) IS NULL OR try(json_extract_string(value, '$.text')) IS NULL
              OR try(json_extract(value, '$.user')) IS NULL THEN 'missing_field'
            ELSE 'ok' END AS reason,
       count(*) AS n
FROM env GROUP BY 1""")

oracle("english_tweets", TW + "SELECT id_str, sec, text FROM te")
oracle("track_terms", TW + f"SELECT id_str FROM tweets WHERE {S.term_match('text', TRACK_TERMS)}")
oracle("track_phrases", TW + f"""
, ph AS (SELECT DISTINCT array_to_string(({S.ws_tokens('text')})[1:{PHRASE_WORDS}], ' ') AS phrase FROM benchmark WHERE text IS NOT NULL)
, pw AS (SELECT phrase, list_filter(list_transform({S.ws_tokens('lower(phrase)')}, lambda w: translate(w, {S.P}, '')), lambda w: w <> '') AS words FROM ph)
, tw AS (SELECT id_str, list_transform({S.ws_tokens('lower(text)')}, lambda w: translate(w, {S.P}, '')) AS words FROM tweets)
SELECT id_str, phrase FROM tw JOIN pw ON len(pw.words) > 0 AND list_has_all(tw.words, pw.words)""")
oracle("token_explode", TW + f"""
SELECT token, count(*) AS n FROM (SELECT unnest({S.space_tokens('text')}) AS token FROM te) GROUP BY token""")
oracle("tokens_ws", TW + f"SELECT id_str, CAST(len({S.ws_tokens('text')}) AS INTEGER) AS n_tokens FROM tweets")


def _tok(src: str, prefix: str, keep: str = "id_str") -> str:
    return (f"(SELECT {keep}, token FROM (SELECT {keep}, unnest({S.space_tokens('text')}) AS token FROM {src}) "
            f"WHERE starts_with(token, {sql_str(prefix)}))")


oracle("hashtag_tokens", TW + f"SELECT id_str, token FROM {_tok('te', '#')}")
oracle("mention_tokens", TW + f"SELECT id_str, token FROM {_tok('te', '@')}")
oracle("hashtag_counts", TW + f"SELECT token, count(*) AS n FROM {_tok('te', '#')} GROUP BY token")
oracle("mention_counts", TW + f"SELECT token, count(*) AS n FROM {_tok('te', '@')} GROUP BY token")
oracle("verified_counts", TW + "SELECT verified, count(*) AS n FROM tweets GROUP BY verified")
oracle("top_hashtags", TW + f"SELECT token, count(*) AS n FROM {_tok('te', '#')} GROUP BY token ORDER BY n DESC, token LIMIT 10")
oracle("top_mentions", TW + f"SELECT token, count(*) AS n FROM {_tok('te', '@')} GROUP BY token ORDER BY n DESC, token LIMIT 10")


def _sliding(rows: str, key: str = "token", additive: bool = False, keep_zero: bool = True) -> str:
    """Brute force: every change point joined to the panes inside its window."""
    if additive:
        value = (f"CAST(coalesce(sum(CASE WHEN q.sec <= p.sec THEN q.c END), 0) + "
                 f"coalesce(sum(CASE WHEN q.sec <= p.sec - {WIDTH} THEN q.c END), 0) AS BIGINT)")
        cond = f"q.{key} = p.{key} AND q.sec <= p.sec"
    else:
        value = "CAST(coalesce(sum(q.c), 0) AS BIGINT)"
        cond = f"q.{key} = p.{key} AND q.sec > p.sec - {WIDTH} AND q.sec <= p.sec"
    having = "" if keep_zero else f"HAVING {value} <> 0"
    return f"""
, panes AS (SELECT {key}, sec, count(*) AS c FROM {rows} GROUP BY {key}, sec)
, pts AS (SELECT {key}, sec FROM panes UNION SELECT {key}, sec + {WIDTH} FROM panes)
SELECT p.{key}, p.sec, {value} AS n
FROM pts p LEFT JOIN panes q ON {cond}
GROUP BY p.{key}, p.sec {having}"""


def _w(sql: str) -> str:
    return TW + sql


oracle("hashtags_sliding", _w(_sliding(_tok("te", "#", "sec"))))
oracle("mentions_sliding", _w(_sliding(_tok("te", "@", "sec"))))
oracle("mentions_sliding_all_langs", _w(_sliding(_tok("tweets", "@", "sec"))))
oracle("mentions_sliding_additive", _w(_sliding(_tok("tweets", "@", "sec"), additive=True)))
oracle("verified_sliding", _w(_sliding("(SELECT verified, sec FROM tweets)", "verified", keep_zero=False)))
oracle("token_panes", TW + f"SELECT token, sec, count(*) AS n FROM {_tok('te', '#', 'sec')} GROUP BY token, sec")

DENSE = f"""
, panes AS (SELECT token, sec, count(*) AS c FROM {{rows}} GROUP BY token, sec)
, dense AS (
  SELECT token, window_end, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT token, c, unnest(generate_series((sec // {DENSE_SLIDE}) * {DENSE_SLIDE} + {DENSE_SLIDE},
                                                (sec // {DENSE_SLIDE}) * {DENSE_SLIDE} + {DENSE_WIDTH}, {DENSE_SLIDE})) AS window_end
        FROM panes)
  GROUP BY token, window_end)"""


def _dense(rows: str) -> str:
    return TW + DENSE.format(rows=rows)


oracle("hashtags_window_dense", _dense(_tok("te", "#", "sec")) + "\nSELECT token, window_end, n FROM dense")
oracle("top_per_slide", _dense(_tok("te", "@", "sec")) + """
SELECT window_end, CAST(rank AS INTEGER) AS rank, token, n FROM (
  SELECT window_end, token, n, row_number() OVER (PARTITION BY window_end ORDER BY n DESC, token) AS rank FROM dense)
WHERE rank <= 10""")
oracle("top_as_of", TW + f"""
, m AS {_tok('te', '@', 'sec')}
SELECT token, count(*) AS n FROM m
WHERE sec > (SELECT max(sec) FROM m) - {DENSE_WIDTH} AND sec <= (SELECT max(sec) FROM m)
GROUP BY token ORDER BY n DESC, token LIMIT 10""")

FOLLOW = """WITH f AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS sec,
                  CAST(json_extract_string(props, '$.k') AS INTEGER) AS followers_count FROM events),
s AS (SELECT sec, count(*) AS n, CAST(sum(followers_count) AS BIGINT) AS total FROM f GROUP BY sec)
"""
oracle("follower_batch_stats", FOLLOW + "SELECT sec, n, total FROM s")
oracle("running_avg_followers", FOLLOW + """
SELECT sec, total_users, CAST(total_followers // total_users AS BIGINT) AS average FROM (
  SELECT sec, CAST(sum(n) OVER (ORDER BY sec) AS BIGINT) AS total_users,
         CAST(sum(total) OVER (ORDER BY sec) AS BIGINT) AS total_followers FROM s)""")
oracle("avg_followers_total", FOLLOW + """
SELECT CAST(count(*) AS BIGINT) AS total_users, CAST(sum(followers_count) // count(*) AS BIGINT) AS average FROM f""")

oracle("clean_full", TW + f"SELECT id_str, {S.clean_full('text')} AS clean FROM tweets")
oracle("clean_serving", TW + f"SELECT id_str, {S.clean_serving('text')} AS clean FROM tweets")
oracle("document_key", TW + f"""
SELECT id_str, id_str || {sql_str(DOC_KEY_SUFFIX)} AS _id,
       coalesce(regexp_matches(id_str || {sql_str(DOC_KEY_SUFFIX)}, {sql_str(DOC_KEY_PATTERN)}), false) AS valid
FROM tweets""")
