"""Oracles of the softmax model on the vocabulary: the same steps of gradient
descent as SQL, one common table per step."""

from __future__ import annotations

from . import sqlfrag as S
from .oracle import oracle
from .oracle_prep import EX, VOCAB
from ..functions.labels import DOC_KEY_SUFFIX
from ..operators.softmax import BIAS, CLASSES, INNER_BELOW, Params
from ..schema import edge_rows_sql, sql_str

P = Params()
K = range(CLASSES)


def _features(name: str, src: str, text: str = "text") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT id, idx, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS x FROM (
    SELECT t.id, coalesce(v.idx, 0) AS idx, CAST(count(*) AS DOUBLE) AS c
    FROM (SELECT id, unnest({S.ws_tokens(text)}) AS token FROM {src}) t LEFT JOIN vocab v USING (token) GROUP BY 1, 2)
  UNION ALL SELECT id, {BIAS}, 1.0 FROM {src})"""


def _p(z: str, r: int) -> list[str]:
    top = f"greatest({', '.join(f'{z}.z{r}_{k}' for k in K)})"
    total = " + ".join(f"exp({z}.z{r}_{k} - {top})" for k in K)
    return [f"(exp({z}.z{r}_{k} - {top}) / ({total}))" for k in K]


def _fit(name: str, f: str, penalties: list[str]) -> list[str]:
    """Tables ``name``_w0, ... up to the last step; ``f``: id, label, idx, x."""
    rs = range(len(penalties))
    zero = ", ".join(f"CAST(0 AS DOUBLE) AS {a}{r}_{k}" for r in rs for a in "wv" for k in K)
    out = [f"{name}_w0 AS MATERIALIZED (SELECT DISTINCT idx, {zero} FROM {f})"]
    for t in range(P.steps):
        z = ", ".join(f"sum(x * w{r}_{k}) AS z{r}_{k}" for r in rs for k in K)
        g = ", ".join(f"sum(x * ({p} - CAST(label = {k} AS INTEGER))) / (SELECT count(*) FROM {f} WHERE idx = {BIAS}) AS g{r}_{k}" for r in rs for k, p in enumerate(_p("z", r)))
        v = {(r, k): f"(v{r}_{k} * {P.momentum} - (g{r}_{k} + w{r}_{k} * CASE WHEN w.idx = {BIAS} THEN 0.0 ELSE {pen} END) * {P.rate})" for r, pen in enumerate(penalties) for k in K}
        new = ", ".join(f"{e} AS v{r}_{k}, w{r}_{k} + {e} AS w{r}_{k}" for (r, k), e in v.items())
        out += [f"{name}_z{t} AS MATERIALIZED (SELECT id, {z} FROM {f} JOIN {name}_w{t} USING (idx) GROUP BY id)",
                f"{name}_g{t} AS MATERIALIZED (SELECT idx, {g} FROM {f} f JOIN {name}_z{t} z USING (id) GROUP BY idx)",
                f"{name}_w{t + 1} AS MATERIALIZED (SELECT w.idx, {new} FROM {name}_w{t} w JOIN {name}_g{t} g USING (idx))"]
    return out


def _scored(name: str, f: str, weights: str, rs: range) -> str:
    z = ", ".join(f"coalesce(sum(x * w{r}_{k}), 0) AS z{r}_{k}" for r in rs for k in K)
    return f"{name} AS MATERIALIZED (SELECT id, {z} FROM {f} LEFT JOIN {weights} USING (idx) GROUP BY id)"


def _loss(z: str, r: int) -> str:
    return "-ln(CASE label " + " ".join(f"WHEN {k} THEN {p}" for k, p in enumerate(_p(z, r))) + " END)"


def model() -> str:
    """Everything up to the weights (table ``weights``), after the tables of
    the examples and the vocabulary."""
    pens, rs = [str(p) for p in P.penalties], range(len(P.penalties))
    ctes = [_features("fe", "train"),
            "ft AS MATERIALIZED (SELECT fe.*, label FROM fe JOIN train USING (id))",
            f"fi AS MATERIALIZED (SELECT *, md5(CAST(id AS VARCHAR) || '-{P.seed}') < '{INNER_BELOW}' AS aside FROM ft)",
            "fo AS MATERIALIZED (SELECT * FROM fi WHERE NOT aside)", "fa AS MATERIALIZED (SELECT * FROM fi WHERE aside)",
            *_fit("inn", "fo", pens), _scored("za", "fa", f"inn_w{P.steps}", rs),
            "la AS (SELECT " + ", ".join(f"avg({_loss('za', r)}) AS l{r}" for r in rs) + " FROM za JOIN train USING (id))",
            "best AS (SELECT CASE " + " ".join(f"WHEN round(l{r}, 9) <= least({', '.join(f'round(l{q}, 9)' for q in rs)}) THEN CAST({p} AS DOUBLE)" for r, p in enumerate(pens)) + " END AS pen FROM la)",
            *_fit("fin", "ft", ["(SELECT pen FROM best)"]),
            f"weights AS MATERIALIZED (SELECT idx, {', '.join(f'w0_{k}' for k in K)} FROM fin_w{P.steps})"]
    return ",\n" + ",\n".join(ctes)


MODEL = EX + VOCAB + model()

oracle("softmax_train_eval", MODEL + f""",
test AS (SELECT * FROM examples WHERE md5(CAST(id AS VARCHAR)) >= 'b333'),
{_features("fx", "test")},
{_scored("zx", "fx", "weights", range(1))}
SELECT label, count(*) AS n, round(avg({_loss("zx", 0)}), 4) AS log_loss FROM zx JOIN test USING (id) GROUP BY label""")


def _classes(src: str, columns: str) -> str:
    """``columns`` and the class of the rows of ``src`` (id, text)."""
    best = f"greatest({', '.join(f'z0_{k}' for k in K)})"
    blank = f"len({S.ws_tokens('text')}) = 0"
    return f""",
{_features("fs", src)},
{_scored("zs", "fs", "weights", range(1))}
SELECT {columns}, CAST(CASE WHEN {blank} THEN -1 {' '.join(f'WHEN z0_{k} = {best} THEN {k}' for k in K)} END AS INTEGER) AS sentiment
FROM zs JOIN {src} USING (id)"""


oracle("score_with_sentinel", MODEL + f""",
served AS (SELECT id, {S.clean_serving('tweet')} AS text FROM labelled UNION ALL SELECT id, {S.clean_serving('tweet')} FROM {edge_rows_sql()})"""
       + _classes("served", "id"))

oracle("score_upsert_stream", MODEL + ",\n" + S.TWEETS.strip() + f""",
posts AS (SELECT event_id AS id, id_str || {sql_str(DOC_KEY_SUFFIX)} AS _id, text AS original, {S.clean_serving('text')} AS text
          FROM tweets WHERE event_id % 10 NOT IN (0, 1))""" + _classes("posts", "_id, original AS text"))
