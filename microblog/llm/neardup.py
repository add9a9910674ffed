"""Near duplicates by bottom-k sketches of one hash function.

1. A text's distinct five-word shingles become 64-bit hashes; its sketch is the
   ``K`` smallest. Texts with equal sets form a group (one partial aggregate, so
   thousands of copies cost one row), which alone goes on.
2. Inverted lists of the ``LISTS`` smallest retained values give candidates.
   Lists of at most ``SHORT`` groups give all their pairs. Longer ones first
   name a hub, and each group is a candidate with the hub of its list: the one
   that stands in most long lists (a text that others were copied from is in
   all of its copies' lists). That joins large groups of copies at one pair per
   member, but settles only the lists that then lie in one component.
3. The union sketch (the K smallest values of both sketches) estimates the
   similarity; pairs far below the threshold go.
4. The others are confirmed on the full sets, which are computed once for the
   groups concerned (a bitmap of a stated size picks their texts: no text is ever
   shuffled) and written in buckets of the group: a pair is confirmed by sending
   one of its sets once. One pair of each group comes first, then whatever still
   lies between two components: a pair inside one cannot change the result.
5. Groups of long lists that still lie in several components are searched
   exactly, on their full sets: two sets above the threshold share one of the
   n - ceil(0.75 n) + 1 values of either that fewest of these groups hold (prefix
   filter). Positions in the two orders bound what a pair can share from its
   first common value on: a member whose bound suffices with no other of its list
   leaves it, and no pair is made whose bound does not suffice. So texts around a
   shared passage that have too much of their own meet nobody. Long lists name
   hubs as above, first the member with least before the value, in rounds until
   one links nothing (at most ``ROUNDS``), then all pairs that lie between
   components are paired out. No pair that can be similar enough is left out.
6. Components by minimum labels and pointer jumping.

Two texts above the threshold share each of the smallest values of their union
with probability >= 0.75, so a pair is in no common list with probability
below 0.25 ** LISTS. Sets of at most K shingles are kept whole.

Definitions: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``; fewer words than a
shingle: the whole sequence is one; null and empty texts have an empty set and
link with nothing. Rows with a null id link with nothing (null component, kept).
Rows that repeat an id are one document: they link all that any of them does.
Other columns are not read.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import blocks, column, materialise, release_shuffles, spread64, texts_of

WORDS = 5
K = 32
LISTS = 12
SHORT = 24
MARGIN = 0.35  # five standard deviations of the estimate at 0.75
ROUNDS = 12  # of hubs in the exact search, before the rest is paired out
BITS = 1 << 24  # of the map of the ids whose full sets are needed
BLOCK = 256  # members of a long list that one task meets with the others


class _Hashes(dict):
    """Words to 64-bit hashes."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_set(text: str, hashes: dict, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    own = text.encode().lower().split()
    if not own:
        return np.empty(0, dtype=np.int64)
    h = np.fromiter(map(hashes.__getitem__, own), dtype=np.uint64, count=len(own))
    if len(h) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(own), seed=len(own))], dtype=np.uint64).view(np.int64)
    n = len(h) - words + 1
    acc = np.zeros(n, dtype=np.uint64)
    for i in range(words):
        acc = (acc ^ spread64(h[i:i + n] * _ODD[i % len(_ODD)] + np.uint64(i))) * np.uint64(0x9FB21C651E98DF25)
    return np.unique(spread64(acc).view(np.int64))


def sketches(docs: DataFrame, words: int = WORDS, k: int = K, key: str = "doc_id", text: str = "text", only: Broadcast | None = None) -> DataFrame:
    """(id, n, print, items): a row per text, with its sketch; or, with its full
    set, of the texts whose id's bit is set in ``only``."""
    full = only is not None
    last = "items"
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), (last, pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text):
            if full:
                at = column(b, "_bit").to_numpy()
                b = b.filter(pa.array(only.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1))
            hashes = _Hashes()
            sets = [shingle_set(t, hashes, words) for t in texts_of(b, text)]
            yield pa.RecordBatch.from_arrays([
                column(b, key).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([s if full else s[:k] for s in sets], pa.list_(pa.int64()))], schema=schema)

    rows = docs.where(F.col(key).isNotNull()).select(key, text, _bit(key).alias("_bit")) if full else docs.select(key, text)
    return rows.mapInArrow(run, f"id bigint, n bigint, print binary, {last} array<bigint>")


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(BITS))


def _bitmap(ids: DataFrame, key: str) -> np.ndarray:
    """A bit for every id, of BITS; a row per word of 64 that is not empty."""
    bit = ids.select(_bit(key).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def group_number(seed: int, bits: int) -> Column:
    """A set's number, of its print."""
    return F.shiftrightunsigned(F.xxhash64("print", F.lit(seed)), 64 - bits)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of the links (a, b)
    reaches. In a round a node takes the smallest label among its neighbours,
    passes it to the node that its old label names, and then follows its new
    label one step on; every round is a written table."""
    ends = edges.select("a", "b").where("a <> b")
    both = _table(ends.union(ends.select("b", "a")).distinct(), "edges")
    labels = _table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("comp")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("comp").alias("seen"))
        near = both.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("low"))
        own = labels.join(near, "node").select("node", "comp", "low")
        told = own.where("low < comp").select(F.col("comp").alias("node"), F.lit(None).cast("long").alias("comp"), "low")
        lower = own.union(told).groupBy("node").agg(F.max("comp").alias("old"), F.min("low").alias("low")).select("node", "old", F.least("old", "low").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = _table(lower.join(jump, "comp").select("node", "old", F.least("comp", "far").alias("comp")), "round")
        labels = new.select("node", "comp")
        if _empty(new.where("old <> comp")):
            return labels


def _estimate(k: int) -> Column:
    """Share of the union sketch's values that both sketches hold."""
    union = F.slice(F.sort_array(F.array_union("items", "others")), 1, k)
    return F.size(F.array_intersect(union, F.array_intersect("items", "others"))) / F.size(union)


def _empty(df: DataFrame) -> bool:
    return not df.limit(1).count()


def _few(df: DataFrame, n: int) -> bool:
    return df.limit(n + 1).count() <= n


def _table(df: DataFrame, name: str) -> DataFrame:
    """A written table of links or numbers. It is far smaller than the texts by
    which the session's partitions are sized, so that an eighth as many files
    do."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.coalesce(min(parts, max(8, parts // 8))), name)


class _Store:
    """Rows with a group number g, written in buckets of it, as many as there
    are shuffle partitions: joins by g shuffle only what they are joined with.
    The table is one of the session's catalog until ``close``; its files lie in
    the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, scratch_path(spark, name)
        self.name, self.buckets = f"{name}_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.empty = True

    def add(self, rows: DataFrame, then: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Append what ``then`` makes of the rows, dealt by g."""
        out = then(rows.repartition(self.buckets, "g")).write.mode("append").bucketBy(self.buckets, "g").sortBy("g")
        out.format("parquet").option("path", self.path).saveAsTable(self.name)
        self.empty = False

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


class _Links:
    """The groups, how they are linked so far, and the tests on pairs of them."""

    def __init__(self, docs: DataFrame, groups: _Store, number: Column, words: int, percent: int, k: int, key: str, text: str):
        self.docs, self.groups, self.number, self.words, self.percent, self.k, self.key, self.text = docs, groups, number, words, percent, k, key, text
        self.labels: DataFrame | None = None
        self.sets = _Store(docs.sparkSession, "sets")

    def labelled(self, rows: DataFrame, node: str, name: str) -> DataFrame:
        if self.labels is None:
            return rows.withColumn(name, F.col(node))
        own = self.labels.select(F.col("node").alias(node), F.col("comp").alias(name))
        return rows.join(own, node, "left").withColumn(name, F.coalesce(name, node))

    def add(self, edges: DataFrame) -> bool:
        """Links (a, b) join components; whether any did."""
        release_shuffles(edges.sparkSession)
        new = edges.select("a", "b")
        if self.labels is not None:
            both = self.labelled(self.labelled(new, "a", "ca"), "b", "cb")
            new = _table(both.where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "links")
        if _empty(new):
            return False
        joined = components(new)  # of the components before
        if self.labels is None:
            self.labels = joined
            return True
        now = joined.select(F.col("node").alias("comp"), F.col("comp").alias("new"))
        old = self.labels.join(now, "comp", "left").select("node", F.coalesce("new", "comp").alias("comp"))
        fresh = joined.join(self.labels.select("node"), "node", "left_anti")  # groups that were alone
        self.labels = _table(old.union(fresh.select("node", "comp")), "labels")
        return True

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs that lie between two components."""
        if self.labels is None:
            return pairs
        return self.labelled(self.labelled(pairs, "a", "ca"), "b", "cb").where("ca <> cb").drop("ca", "cb")

    def met(self, pairs: DataFrame, store: _Store) -> DataFrame:
        """(g, h, n, items, m, others): the pairs (a, b), written, with both
        groups' rows. One group's row goes to the other, once per pair; what
        meets a group with more than BLOCK pairs is dealt to several tasks, with
        that group's row in each."""
        degree = pairs.select(F.explode(F.array("a", "b")).alias("g")).groupBy("g").agg(F.count("*").alias("d")).where(F.col("d") > BLOCK)
        crowds = None if _few(pairs, BLOCK) else _table(degree, "crowds")
        own = store.rows().select("g", "n", "items")
        other = store.rows().select(F.col("g").alias("h"), F.col("n").alias("m"), F.col("items").alias("others"))
        cold = pairs.select(F.col("a").alias("g"), F.col("b").alias("h"))
        if crowds is None or _empty(crowds):
            return cold.join(own, "g").join(other, "h").select("g", "h", "n", "items", "m", "others")
        marked = cold.join(crowds.select("g", F.col("d").alias("dg")), "g", "left").join(crowds.select(F.col("g").alias("h"), F.col("d").alias("dh")), "h", "left")
        marked = _table(marked.select("g", "h", F.coalesce("dg", F.lit(0)).alias("dg"), F.coalesce("dh", F.lit(0)).alias("dh")), "marked")
        one = marked.where("dg + dh = 0").select("g", "h").join(own, "g").join(other, "h")
        turned = marked.where("dg + dh > 0").select(F.expr("if(dg <= dh, g, h)").alias("g"), F.expr("if(dg <= dh, h, g)").alias("h"), F.ceil(F.greatest("dg", "dh") / BLOCK).cast("int").alias("parts"))
        dealt = turned.join(own, "g").withColumn("part", F.expr("cast(pmod(xxhash64(g), parts) as int)"))
        held = turned.select("h", "parts").distinct().join(other, "h").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
        most = dealt.join(held, ["h", "part"])
        names = ["g", "h", "n", "items", "m", "others"]
        return one.select(names).unionByName(most.select(names))

    def likely(self, pairs: DataFrame) -> DataFrame:
        """(a, b, est): the pairs that size and union sketch let through."""
        both = self.met(materialise(pairs.select("a", "b"), "candidates"), self.groups).where(F.least("n", "m") * 100 >= F.greatest("n", "m") * self.percent)
        both = both.withColumn("est", _estimate(self.k))
        margin = F.when((F.col("n") <= self.k) & (F.col("m") <= self.k), F.lit(1e-6)).otherwise(F.lit(MARGIN))
        return materialise(both.where(F.col("est") >= self.percent / 100 - margin).select(*_ordered("g", "h"), "est"), "likely")

    def need(self, nodes: DataFrame) -> None:
        """Full sets of the groups ``nodes`` (g), each computed once, from the
        text of one document of the group."""
        if not self.sets.empty:
            nodes = _table(nodes.join(self.sets.rows().select("g"), "g", "left_anti"), "nodes")
            if _empty(nodes):
                return
        wanted = materialise(self.groups.rows().join(nodes, "g").select("g", "rep"), "wanted")
        only = self.docs.sparkSession.sparkContext.broadcast(_bitmap(wanted, "rep"))  # BITS bits
        # the rows are dealt by g once: an equality of ids would become a key of the join, and its shuffle
        full = sketches(self.docs, self.words, self.k, self.key, self.text, only).select(self.number.alias("g"), "id", "n", "items")
        self.sets.add(full, lambda rows: rows.join(wanted, "g").where("id <= rep and id >= rep").dropDuplicates(["g"]).select("g", "n", "items"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """(a, b): the pairs whose full sets are similar enough."""
        both = self.met(pairs.select("a", "b"), self.sets).withColumn("met", F.size(F.array_intersect("items", "others")))
        united = F.col("n") + F.col("m") - F.col("met")
        return materialise(both.where(F.col("met") * 100 >= united * self.percent).select(*_ordered("g", "h")), "links")

    def prefixes(self, nodes: DataFrame) -> DataFrame:
        """(v, g, n, at): of every group in ``nodes`` (g) the values that decide,
        rarest first, where places and sizes let it share enough with any other
        group that has the value among its own; ``at``: place in that order.
        Values that one group alone holds come first and meet nobody, so they are
        counted only. A value is known by 16 bits
        of its number of holders (its order) and 47 of its hash: two that are
        taken for one can only add candidates."""
        self.need(nodes)
        own = self.sets.rows().join(nodes, "g", "left_semi")
        values = own.select(F.explode("items").alias("v"), "g")
        common = materialise(values.groupBy("v").agg(F.count("*").alias("holders")).where("holders > 1"), "common")
        rank = F.shiftleft(F.least("holders", F.lit(65_535)).cast("bigint"), 47).bitwiseOR(F.col("v").bitwiseAND(F.lit((1 << 47) - 1)))
        held = values.join(common, "v").groupBy("g").agg(F.sort_array(F.collect_list(rank)).alias("held"))
        held = held.join(own.select("g", F.size("items").alias("n")), "g").withColumn("alone", F.col("n") - F.size("held"))
        room = F.expr(f"greatest(n - (n * {self.percent} + 99) div 100 + 1 - alone, 0)").cast("int")
        rows = held.withColumn("held", F.slice("held", F.lit(1), room)).select("g", "n", "alone", F.posexplode("held").alias("i", "v"))
        rows = materialise(rows.select("v", "g", "n", (F.col("alone") + F.col("i")).alias("at")), "prefixes")
        best = rows.groupBy("v").agg(F.count("*").alias("size"), F.min("n").alias("m"), F.max(F.col("n") - F.col("at")).alias("rest")).where("size > 1")
        return rows.join(best, "v").where(self.enough(F.least(F.col("n") - F.col("at"), "rest"), F.col("n") + F.col("m"))).select("v", "g", "n", "at")

    def enough(self, met: Column, sizes: Column) -> Column:
        """Do so many common values suffice two sets of these sizes' sum?"""
        return met * (100 + self.percent) >= sizes * self.percent

    def test(self, pairs: DataFrame, best_first: bool) -> bool:
        """Confirm likely pairs; whether there was a link. ``best_first``: each
        group with one partner, then only what still lies between two
        components. The partner is, among those estimated to be similar enough
        if there are any, the one with most pairs: copies of a text choose the
        same one, so components are stars rather than long chains."""
        self.need(pairs.select(F.explode(F.array("a", "b")).alias("g")).distinct())
        if not best_first:
            return self.add(self.confirmed(pairs))
        either = pairs.select("est", "a", "b").unionByName(pairs.select("est", F.col("a").alias("b"), F.col("b").alias("a")))
        known = either.join(either.groupBy("b").agg(F.count("*").alias("known")), "b")
        choice = F.struct(F.col("est") >= self.percent / 100, "known", F.col("b"))
        best = _table(known.groupBy("a").agg(F.max(choice).alias("best")).select(*_ordered("a", "best.b")).distinct(), "best")
        some = self.add(self.confirmed(best))
        rest = _table(self.apart(pairs.select("a", "b").join(best, ["a", "b"], "left_anti")), "pairs")
        return (not _empty(rest) and self.add(self.confirmed(rest))) or some


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def classes(docs: DataFrame, words: int = WORDS, percent: int = 75, k: int = K, lists: int = LISTS, short: int = SHORT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component): a row per row of ``docs``; the component is
    the smallest id that its document reaches."""
    rows = materialise(sketches(docs, words, k, key, text), "sketches")
    some = rows.where("n > 0 and id is not null")
    prints = some.groupBy("print").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.min("items").alias("items"))
    bits = min(63, 2 * some.count().bit_length() + 8)  # numbers no longer than needed: they are most of what is shuffled
    for seed in itertools.count():  # until no two sets have one number, as a rule at once
        number, store = group_number(seed, bits), _Store(docs.sparkSession, "groups")
        store.add(prints.select("rep", "n", "items", number.alias("g")))
        if _empty(store.rows().groupBy("g").agg(F.count("*").alias("n")).where("n > 1")):
            break
        store.close()
    groups = store.rows()
    links = _Links(docs, store, number, words, percent, k, key, text)

    twice = materialise(some.groupBy("id").agg(F.min("print").alias("p"), F.max("print").alias("q")).where("p <> q").select("id"), "twice")
    if not _empty(twice):  # ids with several texts
        members = some.select("id", number.alias("g")).join(twice, "id").distinct()
        first = members.groupBy("id").agg(F.min("g").alias("a"))
        links.add(_table(members.join(first, "id").where("g <> a").select("a", F.col("g").alias("b")), "links"))

    held = groups.select("n", F.explode(F.slice("items", 1, lists)).alias("v"), "g")
    sizes = held.groupBy("v").agg(F.count("*").alias("size")).where("size > 1")
    held = materialise(held.join(sizes, "v"), "lists")
    fits = lambda n, m: F.least(n, m) * 100 >= F.greatest(n, m) * percent
    bound = lambda n, at, m, to: links.enough(F.least(F.col(n) - F.col(at), F.col(m) - F.col(to)), F.col(n) + F.col(m))

    def spans(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows with their components, and the lists in several of them."""
        now = links.labelled(rows, "g", "comp")
        return now, now.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("v")

    def hubs(rows: DataFrame, r: int) -> DataFrame:
        """Each list's members with its hub, if that is in another component.
        Even rounds draw it from those in most lists, odd ones from all, but the
        first of the exact search, which takes the one with least before the value."""
        now = links.labelled(rows, "g", "comp")
        placed = "at" in rows.columns
        first = "at" if r == 1 else -F.col("central")
        draw = F.xxhash64("g", "v", F.lit(r)) if r % 2 and r > 1 else F.struct(first, F.xxhash64("g", F.lit(r)))
        hub = now.groupBy("v").agg(F.min_by(F.struct("g", "comp", "n", *["at"] * placed), draw).alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        met = now.join(hub.where("lo <> hi").select("v", "hub"), "v").where("comp <> hub.comp").where(fits("n", "hub.n"))
        if placed:
            met = met.where(bound("n", "at", "hub.n", "hub.at"))
        return met.select(*_ordered("g", "hub.g"))

    def centred(rows: DataFrame, name: str) -> DataFrame:
        return materialise(rows.join(rows.groupBy("g").agg(F.count("*").alias("central")), "g"), name)

    def outer(rows: DataFrame) -> DataFrame:
        """All pairs of a list that lie between two components: those outside
        the component that most of its members are in, with all others. What
        follows the first shared value must suffice for the threshold."""
        now = links.labelled(rows, "g", "comp")
        parts = now.groupBy("v", "comp").agg(F.count("*").alias("own"))
        most = parts.groupBy("v").agg(F.max(F.struct("own", "comp")).alias("most"), F.count("*").alias("parts"), F.sum("own").alias("size")).where("parts > 1")
        now = now.join(most.select("v", F.col("most.comp").alias("most"), F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")), "v")
        now = materialise(now.select("v", "g", "n", "at", "comp", "most", "parts"), "apart")
        some = now.where("comp <> most").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("most", "parts")
        other = now.select("v", F.expr("cast(pmod(xxhash64(g), parts) as int)").alias("part"), F.col("g").alias("h"), F.col("n").alias("m"), F.col("at").alias("to"), F.col("comp").alias("beside"), F.col("comp") == F.col("most"))
        other = other.toDF("v", "part", "h", "m", "to", "beside", "inner")
        met = some.join(other, ["v", "part"]).where("comp <> beside and (inner or g < h)").where(fits("n", "m"))
        return met.where(bound("n", "at", "m", "to")).select(*_ordered("g", "h"))

    one = held.where(F.col("size") <= short).select("v", "g", "n")
    near = one.join(one.select("v", F.col("g").alias("h"), F.col("n").alias("m")), "v").where("g < h").where(fits("n", "m"))
    long = centred(held.where(F.col("size") > short).select("v", "g", "n"), "long-lists")
    first = near.select(F.col("g").alias("a"), F.col("h").alias("b")).union(hubs(long, 0)).distinct()
    pairs = links.likely(first)
    if not _empty(pairs):
        links.test(pairs, best_first=True)
    tested = pairs.select("a", "b")

    now, open_lists = spans(long)
    nodes = _table(now.join(open_lists, "v", "left_semi").select("g").distinct(), "open")
    if not _empty(nodes):  # the exact search
        rare = materialise(links.prefixes(nodes), "rare")
        rare = rare.join(rare.groupBy("v").agg(F.count("*").alias("size")).where("size > 1"), "v")
        long = centred(rare.where(F.col("size") > short).drop("size"), "long-rare")
        found = outer(rare.where(F.col("size") <= short)).union(hubs(long, 1))
        for r in range(1, ROUNDS + 1):
            pairs = links.likely((found if r == 1 else hubs(long, r)).distinct().join(tested, ["a", "b"], "left_anti"))
            tested = tested.union(pairs.select("a", "b"))
            if _empty(pairs) or not links.test(pairs, best_first=r == 1):
                break
        pairs = links.likely(outer(long).distinct().join(tested, ["a", "b"], "left_anti"))
        if not _empty(pairs):
            links.test(pairs, best_first=True)

    # components of groups, by the smallest id of their documents
    labels = materialise(links.labelled(groups.select("g", "rep"), "g", "comp"), "labelled")
    store.close()
    links.sets.close()
    least = labels.groupBy("comp").agg(F.min("rep").alias("component"))
    labels = labels.join(least, "comp").select("g", "component")
    linked = some.select("id", "n", number.alias("g")).join(labels, "g").select("id", "n", "component")
    alone = rows.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    return linked.union(alone).select("id", F.col("n").alias("n_shingles"), "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, n_shingles, component_id, kept)."""
    found = classes(docs, key=key, text=text, **options)
    return found.select(F.col("id").alias(key), "n_shingles", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
