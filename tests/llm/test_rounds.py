"""Line dedup, the conversation trie and centroid clustering against brute
force, with nulls, empty and long texts, ties, repeated rows, empty tables and
extra columns whose names clash."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from microblog.llm import centroids, linededup, trie
from microblog.llm.common import prepare
from microblog.llm.cuckoo import CuckooFilter
from microblog.llm.queries import all_queries
from microblog.llm.slots import SlotTable

DOCS = "doc_id BIGINT, text STRING, digest STRING, shard STRING, row STRING, kept STRING"


@pytest.fixture(scope="module", autouse=True)
def folder(spark):
    prepare(spark)


def words_of(seed, n):
    return np.random.default_rng(seed).integers(0, 2**63, size=(n, 2)).astype(np.uint64)


# ---------------------------------------------------------------- filters and tables

@settings(max_examples=30, deadline=None)
@given(st.integers(0, 1000), st.integers(0, 300), st.integers(0, 300), st.integers(0, 200))
def test_cuckoo_filter_never_forgets(seed, n, gone, room):
    w = words_of(seed, n)
    w = np.concatenate([w, w[:n // 3]])  # some twice
    f = CuckooFilter(room)
    f.add(w)
    assert f.holds(w).all()
    f = CuckooFilter.from_bytes(f.to_bytes())
    f.remove(w[:gone])
    assert f.holds(w[gone:]).all()
    f.remove(w[gone:])
    assert not f.slots.any() and not len(f.stash)


def test_cuckoo_filter_rules_out_and_refuses():
    w = words_of(1, 20_000)
    f = CuckooFilter(10_000)
    f.add(w[:10_000])
    assert not len(f.stash) and f.holds(w[10_000:]).mean() < 0.001
    with pytest.raises(ValueError):
        f.remove(words_of(2, 50))


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_slot_table_is_minimal_perfect_and_verified(n):
    w = words_of(3, n)
    table = SlotTable(w)
    assert sorted(table.slot) == list(range(n)) and (table.find(w) == table.slot).all()
    assert (table.find(words_of(4, 500)) == -1).all()
    if n:
        with pytest.raises(ValueError):
            SlotTable(np.concatenate([w, w[:1]]))


# ---------------------------------------------------------------- line dedup

def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def clean_by_force(held, rows, least=3, chars=20):
    """held: what the index holds; rows: what is cleaned."""
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    at = collections.defaultdict(set)
    for i, t in held:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= chars:
                at[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(at[key(x)]) < least or max(at[key(x)]) == i]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "digest", "shard", "row", "kept") for i, t in rows], DOCS)


def cleaned(index, spark, rows):
    return sorted(((r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in index.clean(frame(spark, rows)).collect()), key=str)


LONG = "a line that many documents share with others"
LINE_ROWS = [
    (1, f"{LONG}\nown 1"), (2, f"  {LONG.upper()}\t\nown 2\n{LONG}"), (3, f"x\n{LONG}\r\n{LONG}"), (4, None), (5, ""), (6, "\n\n"),
    (7, "not twenty letters!\nnot twenty letters!"), (8, "not twenty letters!"), (9, "not twenty letters!"),
    (10, "exactly 20 letters éé "), (11, "EXACTLY 20 letters éé "), (12, "exactly 20 letters éé "),  # no-break space is no ASCII space
    (13, "twice in two documents only, so it stays\n" * 3), (14, "twice in two documents only, so it stays"),
    (15, "one document, many rows with this line"), (15, "one document, many rows with this line"), (15, "one document, many rows with this line\nmore"),
    (None, LONG), (None, "a row without an id has this line too"), (16, "a row without an id has this line too"), (17, "a row without an id has this line too"),
    (18, "\n".join(f"line number {i} of a very long text" for i in range(5000))), (19, "\n".join(f"Line number {i} of a very long text" for i in range(0, 5000, 2))),
    (20, "\n".join(f"line number {i} of a very long TEXT " for i in range(0, 5000, 3)) + "\n" + "z" * 100_000), (-3, LONG), (21, "É" * 25 + "\n" + "é" * 25),
]


def test_line_dedup_equals_brute_force(spark):
    index = linededup.LineIndex(spark, shards=5).insert(frame(spark, LINE_ROWS))
    assert cleaned(index, spark, LINE_ROWS) == clean_by_force(LINE_ROWS, LINE_ROWS)


def test_line_dedup_is_incremental_and_reversible(spark):
    index = linededup.LineIndex(spark, shards=3)
    held = []
    for part in (LINE_ROWS[:2], LINE_ROWS[2:9], LINE_ROWS[9:]):
        index.insert(frame(spark, part))
        held += part
        assert cleaned(index, spark, LINE_ROWS[:3]) == clean_by_force(held, LINE_ROWS[:3])
    assert cleaned(index, spark, LINE_ROWS) == clean_by_force(LINE_ROWS, LINE_ROWS)
    ids = {3, 15, 20, 999, None}
    index.delete(frame(spark, [(i, "x") for i in ids]))
    rest = [r for r in LINE_ROWS if r[0] not in ids or r[0] is None]
    assert cleaned(index, spark, rest) == clean_by_force(rest, rest)
    again = linededup.LineIndex(spark, index.folder)  # as a later session finds it
    assert (again.version, again.shards) == (4, 3)
    again.delete(frame(spark, [(i, "x") for i in ids]))  # they are gone already
    again.insert(frame(spark, [r for r in LINE_ROWS if r[0] in ids and r[0] is not None]))
    assert cleaned(again, spark, LINE_ROWS) == clean_by_force(LINE_ROWS, LINE_ROWS)
    small = again.compact()
    assert small.version == 1 and cleaned(small, spark, LINE_ROWS) == clean_by_force(LINE_ROWS, LINE_ROWS)


def test_line_index_survives_a_batch_that_died(spark, monkeypatch):
    index = linededup.LineIndex(spark, shards=2).insert(frame(spark, LINE_ROWS[:9]))
    with monkeypatch.context() as m:
        m.setattr(linededup.LineIndex, "_write_filters", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.insert(frame(spark, LINE_ROWS[9:]))
    again = linededup.LineIndex(spark, index.folder)
    assert again.version == 1 and cleaned(again, spark, LINE_ROWS[:9]) == clean_by_force(LINE_ROWS[:9], LINE_ROWS[:9])
    again.insert(frame(spark, LINE_ROWS[9:]))
    assert cleaned(again, spark, LINE_ROWS) == clean_by_force(LINE_ROWS, LINE_ROWS)


def test_line_dedup_of_empty_tables(spark):
    index = linededup.LineIndex(spark, shards=2)
    assert index.clean(frame(spark, [])).count() == 0
    index.insert(frame(spark, []))
    assert cleaned(index, spark, LINE_ROWS[:4]) == clean_by_force([], LINE_ROWS[:4])
    index.insert(frame(spark, LINE_ROWS)).delete(frame(spark, []))
    assert cleaned(index, spark, LINE_ROWS) == clean_by_force(LINE_ROWS, LINE_ROWS)


# ---------------------------------------------------------------- conversation trie

def trie_by_force(turns):
    own = collections.defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(x)] for c, x in own.items()}
    paths = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(np.fmod(c, 5))
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
    end = lambda node: ",".join(str(c) for c in sorted(m for m in members[node] if paths[m] == node))
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n], hashlib.sha256(end(n).encode()).hexdigest()) for n, m in members.items()), key=str)


def conversations(seed, n):
    rng = np.random.default_rng(seed)
    said = ["", None, "hello", "Hello", "é" * 5, "ja", "a long answer " * 400]
    rows = []
    for c in [*range(n), -7, -10, 10**15, 10**15 + 1]:
        if rng.random() < 0.1:
            continue
        for t in range(int(rng.integers(1, 14))):
            hot = rng.random() < 0.7  # many equal beginnings, and equal conversations
            rows.append((c, t, ["user", "assistant"][t % 2] if hot else None, "hello" if hot else said[rng.integers(len(said))]))
    rows += [(c, t, "user", "the same conversation") for c in range(2 * n, 3 * n) for t in range(3)]
    rows += [(None, 0, "user", "nobody"), (3, None, "system", "first"), (3, None, "system", "also first"), (3, 1, "user", "hello"), (3, 1, "user", "hello"), (4 * n, 0, None, None)]
    return [(c, t, r, x, "digest", 7) for c, t, r, x in rows]


TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, digest STRING, pos INT"


@pytest.mark.parametrize("limit", [1, 3, 10_000])
def test_trie_equals_brute_force(spark, limit):
    rows = conversations(limit, 60)
    found = trie.nodes(trie.rebuilt(trie.numbered(spark.createDataFrame(rows, TURNS))), limit=limit)
    got = sorted((tuple(r)[1:] for r in found.collect()), key=str)
    assert got == trie_by_force([r[:4] for r in rows])


def test_trie_of_one_deep_and_of_no_conversation(spark):
    rows = [(0, t, "user", f"{t}", "d", 0) for t in range(3000)]
    found = trie.nodes(trie.rebuilt(trie.numbered(spark.createDataFrame(rows, TURNS)))).collect()
    assert len(found) == 3001 and {r.n_leaves for r in found} == {1} and max(r.depth for r in found) == 3000
    assert trie.nodes(trie.rebuilt(trie.numbered(spark.createDataFrame([], TURNS)))).count() == 0


def test_ids_that_end_at_a_node_are_hashed_in_order_over_runs(spark):
    rows = [(c, 0, "user", "same", "d", 0) for c in range(0, 60_000, 7)]
    found = trie.nodes(trie.rebuilt(trie.numbered(spark.createDataFrame(rows, TURNS)))).collect()
    assert sorted((tuple(r)[1:] for r in found), key=str) == trie_by_force([r[:4] for r in rows])


# ---------------------------------------------------------------- centroid clustering

def clusters_by_force(rows, k=8, rounds=10, dims=64):
    keep = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and len(v) == dims and all(x is not None and np.isfinite(x) and abs(x) < 2**16 for x in v)]
    first = sorted(keep, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), n) for n, x in enumerate(c))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in keep:
            own[near(v)[1]].append(v)
        c = [[sum(x) // len(own[n]) for x in zip(*own[n])] if n in own else old for n, old in enumerate(c)]
    got = [(i, *near(v)) for i, v in keep]
    each = collections.Counter()
    for _, d, n in got:
        each[n] += d
    return sorted((i, n, d, each[n], sum(each.values()), hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for i, d, n in got)


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, "cluster", "v", 1) for i, v in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, cluster STRING, v STRING, distance INT")


def vectors(seed, n, dims):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.integers(-3, 4, size=dims) / 4]) for i in rng.permutation(n)]
    rows += [(n + i, list(rows[0][1])) for i in range(n // 3)]  # a hot vector
    rows += [(0, rows[1][1]), (1, rows[2][1]), (None, rows[1][1]), (n * 2, None), (n * 2 + 1, []), (n * 2 + 2, [float("nan")] * dims), (n * 2 + 3, [None] * dims),
             (n * 2 + 4, [float("inf")] * dims), (n * 2 + 5, [1e30] * dims), (n * 2 + 6, [1.0] * (dims + 1)), (n * 2 + 7, [60_000.0, -60_000.0] * (dims // 2))]
    return rows


@pytest.mark.parametrize("k,n,dims", [(8, 300, 64), (5, 3, 64), (20, 200, 2)])
def test_clusters_equal_brute_force(spark, k, n, dims):
    rows = vectors(k, n, dims)
    got = centroids.cluster(vector_frame(spark, rows), k=k, dimensions=dims).drop("centroid")
    assert sorted(tuple(r) for r in got.collect()) == clusters_by_force(rows, k, dims=dims)


def test_clusters_of_no_vectors(spark):
    got = centroids.cluster(vector_frame(spark, [(1, [1.0]), (2, None)]))
    assert got.count() == 0 and got.columns[:3] == ["vec_id", "cluster", "distance"]


def test_tree_prunes_and_keeps_ties():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.integers(-50, 50, size=(200, 3)), rng.integers(-50, 50, size=(40, 3))]).astype(np.int64)
    points[200:] = points[:40]  # equal centroids: the smaller number wins
    some = rng.integers(-60, 60, size=(3000, 3)).astype(np.int64)
    number, best, asked = centroids.VantageTree(points).nearest(some)
    away = ((some[:, None] - points) ** 2).sum(axis=2)
    assert (number == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()
    assert asked < 0.5 * away.size
    assert (centroids.VantageTree(points[:1]).nearest(some)[0] == 0).all()


# ---------------------------------------------------------------- registered queries

@pytest.mark.parametrize("name", ["op11_cuckoo_lines", "op12_prefix_trie", "op13_vantage_clusters"])
def test_query_equals_its_sql(spark, duck_check, name):
    from microblog.llm.queries import all_oracles
    from tools.oracle_check import compare

    problems, _, n = compare(spark, duck_check, name, all_queries()[name], all_oracles()[name], "/root/testdata/sf0.01")
    assert not problems and n
