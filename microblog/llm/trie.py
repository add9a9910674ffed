"""Conversation prefix trie over minimal-perfect-hash node tables.

A node is a distinct sequence of first turns. Its digest chains those of the
turns (role and text), so that only digests are shuffled, never texts. Spark
counts the conversations of every node with partial aggregates. Then the trie is
cut: a node whose subtree more than ``limit`` conversations pass is heavy, and
every topmost light node is the anchor of a whole subtree, which is dealt to a
shard by the anchor's digest. A shard assigns its nodes slots of a minimal
perfect hash table (look-ups are verified by the digest), scatters their counts
into flat arrays and adds up subtrees through the array of parent slots, deepest
nodes first. What anchors hand up is summed per parent by Spark, and the heavy
top is walked level by level, with one table for each level: a level has at most
``conversations / limit`` nodes, and ``limit`` grows with the conversations, so
that this is at most ``TOP_WIDTH`` nodes.

Sharing (``rebuilt``): conversation c begins with the first h turns of the
conversation c - c % 5, where h is the crc32 of c's decimal number modulo 9, and
goes on with its own turns after its first h.

Definitions: a null role or text is empty. Turns go by number, null first; equal
numbers by the SHA-256 digest of role and text. Rows without a conversation id
belong to none. Repeated rows are turns of their own. No conversations, no
nodes, not even a root. Texts count by their UTF-8 bytes. Other columns are not
read. One conversation is read by one task, in a stream; the ids that end at a
node are joined in runs of ``RUN`` numbers and hashed in a stream, so that no
group of equal conversations is ever held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, materialise
from .cuckoo import digest_words
from .slots import SlotTable

GROUP = 5  # conversations that may share a beginning
MOST_SHARED = 9  # their shared turns are fewer
LEAST_LIMIT = 64
TOP_WIDTH = 1_000_000
SHARD_NODES = 200_000
RUN = 4_096
ROOT = bytes(16)
_NODE = pa.schema([("digest", pa.binary()), ("up", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])
_NODE_DDL = "digest binary, up binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def numbered(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, digest, bytes): every turn with its place (from 0), its
    digest and the bytes of its text."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    rows = turns.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"), F.octet_length(said).cast("bigint").alias("bytes"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest"))
    return rows.withColumn("pos", place.cast("bigint") - 1).select("conv_id", "pos", "digest", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The turns of the rebuilt conversations, of what ``numbered`` gives, and a
    row without a digest (pos -1) of every conversation, turnless ones too."""
    turns = materialise(turns, "turns")
    convs = turns.where("pos = 0").select("conv_id", shared_turns(F.col("conv_id")).alias("h"))
    start = turns.where(F.col("pos") < MOST_SHARED - 1).withColumnRenamed("conv_id", "base")
    borrowed = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(start, "base").where("pos < h").select("conv_id", "pos", "digest", "bytes")
    own = turns.where(F.col("pos") >= shared_turns(F.col("conv_id")))
    marks = convs.select("conv_id", F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("bytes"))
    return own.unionByName(borrowed).unionByName(marks)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, parent, bytes, ends): every prefix of every
    conversation, the empty one included; ``ends``: it is the whole one."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("digest", pa.binary()), ("parent", pa.binary()), ("bytes", pa.int64()), ("ends", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # waits for the next row, which tells whether it ends
        for b in batches:
            out = []
            for conv, digest, size in zip(column(b, "conv_id").to_pylist(), column(b, "digest").to_pylist(), column(b, "bytes").to_pylist()):
                if digest is None:
                    row = (conv, 0, ROOT, None, 0)
                else:
                    row = (conv, last[1] + 1, hashlib.blake2b(last[2] + digest, digest_size=16).digest(), last[2], size)
                if last is not None:
                    out.append((*last, row[1] == 0))
                last = row
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)] if out else [pa.array([], t) for t in schema.types], schema=schema)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*last, True), schema.types)], schema=schema)

    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "digest", "bytes").mapInArrow(
        run, "conv_id bigint, depth bigint, digest binary, parent binary, bytes bigint, ends boolean")


def ends(paths: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the nodes where conversations end."""
    runs = (paths.where("ends").select("digest", "conv_id", F.shiftright("conv_id", RUN.bit_length() - 1).alias("run"))
            .groupBy("digest", "run").agg(F.sort_array(F.collect_list("conv_id")).alias("ids")))  # at most RUN different ids
    runs = runs.select("digest", "run", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    schema = pa.schema([("digest", pa.binary()), ("ends_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = None, None
        for b in batches:
            out = []
            for digest, ids in zip(column(b, "digest").to_pylist(), column(b, "ids").to_pylist()):
                if digest != own:
                    if own is not None:
                        out.append((own, state.hexdigest()))
                    own, state = digest, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(schema.types)], schema=schema)
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    return runs.repartition("digest").sortWithinPartitions("digest", "run").mapInArrow(hashed, "digest binary, ends_sha256 string")


def _numbers(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def accumulate(nodes: pa.Table) -> pa.Table:
    """Whole subtrees: every node with its children, leaves and savings; ``up``
    is the parent's digest where that is not among the nodes."""
    digests, parents = nodes.column("digest").to_pylist(), nodes.column("parent").to_pylist()
    words = digest_words(digests)
    table = SlotTable(words)
    n = len(words)
    scatter = lambda x: _scattered(x, table.slot, n)
    depth, convs, size, conv = (scatter(_numbers(nodes, c)) for c in ("depth", "n_convs", "bytes", "conv_id"))
    parent = scatter(table.find(digest_words(parents)))
    children = np.bincount(parent[parent >= 0], minlength=n)
    leaves, saved = (children == 0).astype(np.int64), (convs - 1) * size
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    own = table.slot
    top = parent[own] < 0
    above = np.where(top, 0, conv[parent[own]])
    return pa.Table.from_arrays([
        pa.array(digests, pa.binary()), pa.array([p if t else None for p, t in zip(parents, top)], pa.binary()), pa.array(conv[own]), pa.array(depth[own]),
        pa.array(above, mask=top), pa.array(convs[own]), pa.array(children[own]), pa.array(leaves[own]), pa.array(saved[own])], schema=_NODE)


def _scattered(values: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
    out = np.empty(n, np.int64)
    out[slot] = values
    return out


def _shards(light: DataFrame, shards: int) -> DataFrame:
    """Every shard's subtrees; a partition is a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            yield from accumulate(pa.Table.from_batches(got)).to_batches(max_chunksize=65_536)

    return light.repartition(shards, "anchor").select("digest", "parent", "conv_id", "depth", "n_convs", "bytes").mapInArrow(run, _NODE_DDL)


def _top(heavy: DataFrame) -> DataFrame:
    """The heavy nodes, deepest level first; two levels are held at a time.
    ``heavy`` has what the anchors handed up: children, leaves, saved."""

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, own = [], None
        for b in batches:
            depth = column(b, "depth").to_numpy()
            for part in np.split(np.arange(len(depth)), np.flatnonzero(np.diff(depth)) + 1):
                if len(part):
                    if own is not None and depth[part[0]] != own:
                        yield pa.Table.from_batches(held)
                        held = []
                    own = depth[part[0]]
                    held.append(b.slice(int(part[0]), len(part)))
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below: dict | None = None
        for nodes in levels(batches):
            words = digest_words(nodes.column("digest").to_pylist())
            now = {"words": words, "parents": nodes.column("parent").to_pylist()} | {c: _numbers(nodes, c).astype(np.int64) for c in ("conv_id", "depth", "n_convs", "children", "leaves", "saved", "bytes")}
            now["saved"] += (now["n_convs"] - 1) * now["bytes"]
            if below is not None:
                table = SlotTable(words)
                slot = table.find(digest_words(below["parents"]))
                at = np.empty(len(words), np.int64)
                at[table.slot] = np.arange(len(words))
                parent = at[slot]
                np.add.at(now["children"], parent, 1)
                for c in ("leaves", "saved"):
                    np.add.at(now[c], parent, below[c])
                yield from _rows(below, now["conv_id"][parent])
            now["leaves"] = np.where(now["children"] == 0, 1, now["leaves"])
            below = now
        if below is not None:
            yield from _rows(below, None)

    def _rows(level: dict, above: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        n = len(level["words"])
        yield pa.RecordBatch.from_arrays([
            pa.array([w.tobytes() for w in level["words"]], pa.binary()), pa.nulls(n, pa.binary()), pa.array(level["conv_id"]), pa.array(level["depth"]),
            pa.nulls(n, pa.int64()) if above is None else pa.array(above), pa.array(level["n_convs"]), pa.array(level["children"]), pa.array(level["leaves"]), pa.array(level["saved"])], schema=_NODE)

    one = heavy.select("digest", "parent", "conv_id", "depth", "n_convs", "bytes", "children", "leaves", "saved").repartition(1).sortWithinPartitions(F.desc("depth"))
    return one.mapInArrow(run, _NODE_DDL)


def nodes(turns: DataFrame, limit: int | None = None) -> DataFrame:
    """A row per node of the trie over conversations: digest, conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. ``turns``: what ``numbered`` or ``rebuilt`` gives, with a row of
    pos -1 for every conversation; ``limit``: conversations in a light subtree,
    chosen by their number unless given."""
    spark = turns.sparkSession
    paths = materialise(prefixes(turns), "trie-paths")
    table = paths.groupBy("digest").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.max("bytes").alias("bytes"))
    table = materialise(table, "trie-nodes")
    n_nodes, n_convs = table.agg(F.count("*"), F.max("n_convs")).first()
    limit = limit or max(LEAST_LIMIT, -(-(n_convs or 0) // TOP_WIDTH))
    is_heavy = (F.col("n_convs") > limit) | (F.col("depth") == 0)
    heavy, light = table.where(is_heavy), table.where(~is_heavy)
    anchors = light.join(heavy.select(F.col("digest").alias("parent")), "parent", "left_semi").select("digest")
    anchored = paths.join(anchors, "digest").select("conv_id", F.col("digest").alias("anchor"))  # each conversation passes at most one
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_nodes // SHARD_NODES))
    lower = materialise(_shards(light.join(anchored, "conv_id"), shards), "trie-shards")
    handed = lower.where("up is not null").groupBy(F.col("up").alias("digest")).agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("children", "leaves", "saved")}
    upper = materialise(_top(heavy.join(handed, "digest", "left").select(*heavy.columns, *zero.values())), "trie-top")
    above = upper.select(F.col("digest").alias("up"), F.col("conv_id").alias("top_conv"))
    lower = lower.join(above, "up", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_conv"))
    every = lower.select(upper.columns).unionByName(upper)
    none = hashlib.sha256(b"").hexdigest()
    return every.join(ends(paths), "digest", "left").select(
        "digest", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
