"""Golden edge rows for the text rules (hand-computed with Python string methods)."""

import math

from pyspark.sql import functions as F

from microblog.functions import labels as L
from microblog.functions import text as T
from microblog.operators import prep

GOLDEN = [
    # text, full clean (None = dropped by the missing/blank rules), serving clean
    ("@Bob: Loving #Spark! see HTTP://t.co/x now", "loving see now", "bob loving spark see httptcox now"),
    ("Wow ... great", "wow  great", "wow  great"),
    ("  lead  and   trail  ", "lead and trail", "  lead  and   trail  "),
    ("a\tb\nc", "a b c", "a\tb\nc"),
    ("@only #tags https://x.y", None, "only tags httpsxy"),
    ("", None, ""),
    ("   ", None, "   "),
    ("null", None, "null"),
    ("e-mail me@x.com", "email mexcom", "email mexcom"),
    ("!@bob hi", "bob hi", "bob hi"),
    ("cafÉ #été d'or", "café dor", "café été dor"),
    ("httpfoo stays? no", "stays no", "httpfoo stays no"),
]


def python_full(t):
    import string

    words = [w for w in t.lower().split() if w[0] not in "@#" and w[:4] != "http"]
    return "".join(ch for ch in " ".join(words) if ch not in string.punctuation)


def test_clean_rules_match_golden(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "id BIGINT, tweet STRING")
    out = df.select("id", T.clean_full("tweet").alias("full"), T.clean_serving("tweet").alias("serving"))
    kept = {r.id for r in prep.drop_blank(prep.drop_missing(out.select("id", F.col("full").alias("t")), ["t"]), "t").collect()}
    rows = {r.id: r for r in out.collect()}
    for i, (text, full, serving) in enumerate(GOLDEN):
        assert rows[i].serving == serving, (text, rows[i].serving)
        if full is None:
            assert i not in kept, text
        else:
            assert rows[i].full == full == python_full(text), (text, rows[i].full)
            assert i in kept


def test_serving_clean_of_missing_text_is_none(spark):
    df = spark.createDataFrame([(None,)], "t STRING")
    assert df.select(T.clean_serving("t")).first()[0] == "none"


def test_hashtag_and_mention_tokens(spark):
    df = spark.createDataFrame([(GOLDEN[0][0],), ("!@bob hi",), ("hi\n@bob",), ("a  #x  ",), ("   ",), ("",)], "t STRING")
    r = df.select(T.hashtags("t").alias("h"), T.mentions("t").alias("m"), T.space_tokens("t").alias("s")).collect()
    assert r[0].h == ["#Spark!"] and r[0].m == ["@Bob:"]
    assert r[1].m == [] and r[2].m == []
    assert r[3].s == ["a", "", "#x"]          # interior empty kept, trailing removed
    assert r[4].s == [] and r[5].s == [""]     # Java split of all-space / empty text


def test_ws_tokens_match_python_split(spark):
    samples = ["a b", "  a\t\tb \n c  ", "x y z", "one", "", "\x1c\x1dq"]
    df = spark.createDataFrame([(s,) for s in samples], "t STRING")
    got = [r[0] for r in df.select(T.ws_tokens("t")).collect()]
    assert got == [s.split() for s in samples]


def test_label_remap_and_keys(spark):
    df = spark.createDataFrame([(0,), (2,), (4,), (3,), (None,)], "s INT")
    assert [r[0] for r in df.select(L.label_remap("s")).collect()] == [0, 1, 2, None, None]
    k = spark.createDataFrame([("1312534567597731840",), ("abc",)], "id STRING")
    rows = k.select(L.document_key("id").alias("k")).select("k", L.valid_document_key("k").alias("v")).collect()
    assert rows[0].k == "131253456759773184012345" and rows[0].v
    assert len(rows[1].k) == 8 and not rows[1].v


def test_argmax_and_cross_entropy(spark):
    df = spark.createDataFrame([([1.0, 5.0, 5.0], 0), ([0.0, 0.0, 0.0], 2)], "s ARRAY<DOUBLE>, y INT")
    r = df.select(L.argmax("s").alias("a"), L.cross_entropy("s", "y").alias("ce")).collect()
    assert r[0].a == 1
    assert math.isclose(r[1].ce, math.log(3), rel_tol=1e-12)


def test_track_terms(spark):
    from microblog.operators.topics import track_terms

    df = spark.createDataFrame([("a #Error here",), ("clicked",), ("CLICK!",), ("nothing",)], "text STRING")
    assert [r.text for r in track_terms(df).collect()] == ["a #Error here", "CLICK!"]


def java_split_space(t):
    """Java String.split(" "): trailing empty strings removed; "" -> [""]."""
    if t == "":
        return [""]
    parts = t.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def python_serving(t):
    import string

    return "".join(ch for ch in str(t).lower() if ch not in string.punctuation)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

PIECES = [" ", "  ", "\t", "\n", "#", "@", "http", "HTTP", "x", "Ab", "é", "É", "!", "...", "'", "-", ":",
          "tag", "user", "\x0b", " ", ",", "?"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=30))
def test_text_rules_match_python_on_random_strings(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, t STRING")
    rows = df.select("id", T.space_tokens("t").alias("sp"), T.ws_tokens("t").alias("ws"),
                     T.clean_full("t").alias("full"), T.clean_serving("t").alias("serv")).collect()
    for r in rows:
        t = texts[r.id]
        assert r.sp == java_split_space(t), repr(t)
        assert r.ws == t.split(), repr(t)
        assert r.full == python_full(t), repr(t)
        assert r.serv == python_serving(t), repr(t)
