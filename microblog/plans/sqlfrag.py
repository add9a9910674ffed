"""SQL text for the DuckDB oracles, mirroring the rules in ``functions``.

The oracle is an independent statement of each rule in another engine; these
helpers only keep the repeated pieces (token rules, derived inputs) in one
place.
"""

from __future__ import annotations

from ..functions.text import PUNCT, ws_pattern
from ..schema import LABELLED_DATE, LABELLED_QUERY, LABELLED_USER, sql_str

P = sql_str(PUNCT)


def ws_re() -> str:
    return sql_str(ws_pattern())


def space_tokens(x: str) -> str:
    s = f"regexp_replace({x}, ' +\\z', '')"
    return f"(CASE WHEN {s} = '' AND {x} <> '' THEN []::VARCHAR[] ELSE string_split({s}, ' ') END)"


def ws_tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {ws_re()}), lambda w: w <> '')"


def clean_full(x: str) -> str:
    kept = (f"list_filter({ws_tokens(f'lower({x})')}, lambda w: substr(w, 1, 1) NOT IN ('@', '#') "
            f"AND NOT starts_with(w, 'http'))")
    return f"translate(array_to_string({kept}, ' '), {P}, '')"


def clean_serving(x: str) -> str:
    return f"translate(lower(coalesce({x}, 'None')), {P}, '')"


def is_blank(x: str) -> str:
    return f"regexp_full_match({x}, {ws_re()})"


def term_match(x: str, terms: list[str]) -> str:
    lst = "[" + ", ".join(sql_str(t) for t in terms) + "]"
    return (f"len(list_filter({ws_tokens(f'lower({x})')}, "
            f"lambda w: list_contains({lst}, translate(w, {P}, '')))) > 0")


TWEETS = f"""
tweets AS (
  SELECT event_id,
         lpad(CAST(event_id AS VARCHAR), 19, '0') AS id_str,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         lang,
         '@user' || CAST(user_id AS VARCHAR) || ' #' || event_type || ' http://t.co/'
           || CAST(event_id AS VARCHAR) || ' ' || text AS text,
         (user_id % 10 = 0) AS verified,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS followers_count,
         CAST(user_id % 50 AS INTEGER) AS friends_count
  FROM events JOIN documents ON event_id = doc_id
),
te AS (SELECT * FROM tweets WHERE lang = 'en')"""

LABELLED = f"""
labelled AS (
  SELECT CAST(CASE WHEN quality = 1 AND toxic = 0 THEN 4 WHEN quality = 1 THEN 2 ELSE 0 END AS INTEGER) AS sentiment,
         doc_id AS id, {sql_str(LABELLED_DATE)} AS date, {sql_str(LABELLED_QUERY)} AS query,
         {sql_str(LABELLED_USER)} AS "user", text AS tweet
  FROM documents JOIN labels USING (doc_id)
)"""

def remap(x: str) -> str:
    return f"CAST(CASE WHEN {x} = 0 THEN 0 WHEN {x} = 2 THEN 1 WHEN {x} = 4 THEN 2 END AS INTEGER)"


def examples_cte() -> str:
    from ..operators.prep import NA_VALUES

    na = "[" + ", ".join(sql_str(v) for v in NA_VALUES) + "]"
    return f"""{LABELLED},
cleaned AS (
  SELECT id, {remap('sentiment')} AS label, {clean_full('tweet')} AS text FROM labelled
),
examples AS (
  SELECT id, label, text FROM cleaned
  WHERE label IS NOT NULL AND text IS NOT NULL AND NOT list_contains({na}, text)
    AND NOT {is_blank('text')}
),
train AS (SELECT * FROM examples WHERE md5(CAST(id AS VARCHAR)) < 'b333')"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"
