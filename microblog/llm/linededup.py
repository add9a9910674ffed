"""Line dedup that can be taken back: sharded cuckoo filters over exact
reference-count tables.

A document refers to the key of each of its lines (stripped of ASCII white
space, A-Z lower-cased) that has at least ``min_chars`` code points. The index
is a folder of

* ``refs``: the references (key digest, document) of every batch of inserted or
  deleted documents, with a sign, by shard of the digest;
* ``repeated``: how many documents refer to each key that ``min_docs`` do, and
  the largest of them, which keeps its lines;
* ``filters``: for every shard one cuckoo filter of the keys that any document
  refers to (``seen``) and one of the repeated ones (``repeated``).

An inserted or deleted batch touches the counts of its own keys only: the
``seen`` filters tell which of them earlier batches may hold, and only those are
looked up there. Cleaning asks the ``repeated`` filters first; only what they do
not rule out is joined with the exact table. Filters learn and forget keys as
counts rise and fall, so deleting documents brings back the lines of others.

A batch becomes visible by its ``done`` record, which is written last: a batch
that died is simply written again. References and counts are summed by partial
aggregates, and a line that every document has is split among tasks by document.

Definitions: a null text is the empty text, which has one empty line. Rows that
share an id are one document. Rows without an id refer to nothing and lose
nothing. Documents that were never inserted lose nothing. Repeated rows are
cleaned alike. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import blocks, column, materialise, texts_of
from .cuckoo import CuckooFilter, digest_words
from .files import new_file, read_file

MIN_CHARS = 20
MIN_DOCS = 3
SPACE = " \t\n\x0b\x0c\r"
KINDS = ("seen", "repeated")
REFS_DDL = "shard int, digest binary, doc_id bigint, row bigint"
_REFS = pa.schema([("shard", pa.int32()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int64())])


def line_keys(lines: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.utf8_trim(lines, characters=SPACE))


def key_digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    return ((words[:, 0] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _with_row(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, row, text): row is a hash of the text, so that no join gathers
    the rows of an id; what is dropped goes by id and key alone."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("row"), body.alias("text"))


def references(docs: DataFrame, shards: int, min_chars: int = MIN_CHARS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(shard, digest, doc_id, row): the distinct keys of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            lists = pc.split_pattern(column(b, "text"), "\n")
            keys, owner = line_keys(lists.flatten()), pc.list_parent_indices(lists)
            long = pc.greater_equal(pc.utf8_length(keys), min_chars)
            digests = [key_digest(k) for k in keys.filter(long).cast(pa.binary()).to_pylist()]
            if not digests:
                continue
            words, owner = digest_words(digests), owner.filter(long).to_numpy()
            order = np.lexsort((words[:, 0], words[:, 1], owner))
            same = (np.diff(owner[order]) == 0) & (np.diff(words[order], axis=0) == 0).all(axis=1)
            own = np.sort(order[np.append(True, ~same)])
            at = pa.array(owner[own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard_of(words[own], shards)), pa.array([digests[i] for i in own], pa.binary()), column(b, "doc_id").take(at), column(b, "row").take(at)], schema=_REFS)

    return _with_row(docs, key, text).where("doc_id is not null").mapInArrow(run, REFS_DDL)


def _filter_file(folder: str, version: int, kind: str, shard: int) -> str:
    return f"{folder}/filters/v{version:06d}/{kind}-{shard:07d}.cf"


def _asked(rows: DataFrame, folder: str, version: int, kind: str) -> DataFrame:
    """The rows (shard, digest, ...) that the filters do not rule out. A task
    holds one filter at a time; its rows come by shard."""
    ddl, names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, -1
        for b in batches:
            if not b.num_rows:
                continue
            shard, words = column(b, "shard").to_numpy(), digest_words(column(b, "digest").to_pylist())
            keep = np.zeros(len(shard), dtype=bool)
            for s in np.unique(shard):
                if s != own:
                    held, own = CuckooFilter.from_bytes(read_file(_filter_file(folder, version, kind, int(s)))), s
                at = np.flatnonzero(shard == s)
                keep[at] = held.holds(words[at])
            yield b.select(names).filter(pa.array(keep))

    return rows.mapInArrow(run, ddl)


class LineIndex:
    """An index in ``folder`` (shared by all executors); opened if it is there.

    ``shards``: how many filters; a task holds one at a time, and the keys of
    one when it builds it. By default the session's number of shuffle
    partitions, which is chosen by the size of the input."""

    def __init__(self, spark: SparkSession, folder: str | None = None, shards: int | None = None, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS):
        self.spark, self.folder = spark, (folder or scratch_path(spark, "lines")).rstrip("/")
        self.shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.min_docs, self.min_chars, self.version, self.batches = min_docs, min_chars, 0, []
        jvm = spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/done")
        if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            last = spark.read.parquet(f"{self.folder}/done").orderBy(F.desc("version")).first()
            self.version, self.batches, self.shards, self.min_docs, self.min_chars = last.version, list(last.batches), last.shards, last.min_docs, last.min_chars

    # ------------------------------------------------------------ stored tables

    def _refs(self) -> DataFrame:
        """All signed references so far."""
        return self.spark.read.schema(REFS_DDL + ", sign bigint").parquet(*[f"{self.folder}/refs/{b}" for b in self.batches])

    def repeated(self) -> DataFrame:
        """(shard, digest, n_docs, keeper) of the keys of ``min_docs`` documents."""
        return self.spark.read.parquet(f"{self.folder}/repeated/v{self.version:06d}")

    # ------------------------------------------------------------ changes

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> LineIndex:
        """Add documents."""
        return self._apply(references(docs, self.shards, self.min_chars, key, text).withColumn("sign", F.lit(1).cast("bigint")))

    def delete(self, ids: DataFrame, key: str = "doc_id") -> LineIndex:
        """Take documents out again, all rows of each id."""
        if not self.version:
            return self
        gone = ids.select(F.col(key).cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
        live = self._refs().join(gone, "doc_id", "left_semi").groupBy("shard", "digest", "doc_id", "row").agg(F.sum("sign").alias("sign"))
        return self._apply(live.where("sign > 0").withColumn("sign", -F.col("sign")))

    def _apply(self, refs: DataFrame) -> LineIndex:
        new, name = self.version + 1, f"batch={self.version + 1:06d}"
        path = f"{self.folder}/refs/{name}"
        (refs.select("shard", "digest", "doc_id", "row", "sign").hint("rebalance", "shard").sortWithinPartitions("shard", "digest")
         .write.mode("overwrite").parquet(path))
        batch = self.spark.read.schema(REFS_DDL + ", sign bigint").parquet(path)
        both = batch.withColumn("old", F.lit(0).cast("bigint"))
        if self.version:
            known = _asked(batch.select("shard", "digest").distinct().sortWithinPartitions("shard"), self.folder, self.version, "seen")
            before = self._refs().join(known.select("digest"), "digest", "left_semi").withColumn("old", F.col("sign"))
            both = both.unionByName(before)
        pairs = both.groupBy("shard", "digest", "doc_id").agg(F.sum("sign").alias("now"), F.sum("old").alias("was"))
        keys = pairs.groupBy("shard", "digest").agg(
            F.count_if(F.col("now") > 0).alias("n_docs"), F.max(F.when(F.col("now") > 0, F.col("doc_id"))).alias("keeper"), F.count_if(F.col("was") > 0).alias("n_before"))
        keys = materialise(keys, "line-keys")
        more = keys.where(F.col("n_docs") >= self.min_docs).select("shard", "digest", "n_docs", "keeper")
        if self.version:
            more = self.repeated().join(keys.select("digest"), "digest", "left_anti").select("shard", "digest", "n_docs", "keeper").unionByName(more)
        more.write.mode("overwrite").parquet(f"{self.folder}/repeated/v{new:06d}")
        self._write_filters(keys, new)
        done = [(new, [*self.batches, name], self.shards, self.min_docs, self.min_chars)]
        record = self.spark.createDataFrame(done, "version bigint, batches array<string>, shards int, min_docs int, min_chars int")
        record.coalesce(1).write.mode("append").parquet(f"{self.folder}/done")
        self.version, self.batches = new, done[0][1]
        return self

    def _write_filters(self, keys: DataFrame, new: int) -> None:
        """Every shard's filters after the changes of ``keys``."""
        least = {"seen": 1, "repeated": self.min_docs}
        step = {k: F.when((F.col("n_docs") >= n) & (F.col("n_before") < n), 1).when((F.col("n_docs") < n) & (F.col("n_before") >= n), -1).otherwise(0).cast("int") for k, n in least.items()}
        changes = keys.select("shard", "digest", *[c.alias(k) for k, c in step.items()]).where("seen <> 0 or repeated <> 0")
        every = self.spark.range(self.shards).select(F.col("id").cast("int").alias("shard"), F.lit(None).cast("binary").alias("digest"), *[F.lit(0).alias(k) for k in KINDS])
        folder, old = self.folder, self.version

        def run(key: tuple, rows: pa.Table) -> pa.Table:
            shard = key[0].as_py()
            rows = rows.filter(pc.is_valid(rows.column("digest")))
            words = digest_words(rows.column("digest").to_pylist())
            sizes = []
            for kind in KINDS:
                by = rows.column(kind).to_numpy()
                plus, minus = words[by > 0], words[by < 0]
                own = CuckooFilter.from_bytes(read_file(_filter_file(folder, old, kind, shard))) if old else CuckooFilter(2 * len(plus))
                own.remove(minus)
                own.add(plus)
                with new_file(_filter_file(folder, new, kind, shard)) as f:
                    f.write(data := own.to_bytes())
                sizes.append(len(data))
            return pa.table({"shard": pa.array([shard], pa.int32()), "bytes": pa.array([sum(sizes)], pa.int64())})

        materialise(changes.unionByName(every).groupBy("shard").applyInArrow(run, "shard int, bytes bigint"), "filters")

    def compact(self) -> LineIndex:
        """The same index in a new folder: one batch of what still counts,
        filters as large as their keys need."""
        out = LineIndex(self.spark, None, self.shards, self.min_docs, self.min_chars)
        if self.version:
            live = self._refs().groupBy("shard", "digest", "doc_id", "row").agg(F.sum("sign").alias("sign")).where("sign > 0")
            out._apply(live)
        return out

    # ------------------------------------------------------------ cleaning

    def dropped(self) -> DataFrame:
        """(doc_id, row, digests): the keys whose lines each text loses."""
        maybe = _asked(self._refs().where("sign > 0").select("shard", "digest", "doc_id", "row"), self.folder, self.version, "repeated")
        found = maybe.join(self.repeated().select("digest", "keeper"), "digest").where("doc_id <> keeper")
        return found.groupBy("doc_id", "row").agg(F.collect_set("digest").alias("digests"))  # at most the lines of one text

    def clean(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, kept, n_lines, n_dropped) of every row: the lines left,
        joined by line ends, and how many there were and went."""
        rows = _with_row(docs, key, text)
        if self.version:
            rows = rows.join(self.dropped(), ["doc_id", "row"], "left")
        else:
            rows = rows.withColumn("digests", F.lit(None).cast("array<binary>"))
        schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches, "text"):
                kept, total, gone = [], [], []
                for own, digests in zip(texts_of(b), column(b, "digests").to_pylist()):
                    n = own.count("\n") + 1
                    left = n
                    if digests:
                        lines, out = pa.array(own.split("\n"), pa.string()), set(digests)
                        own_keys = line_keys(lines).cast(pa.binary()).to_pylist()
                        stay = [key_digest(k) not in out for k in own_keys]
                        own, left = "\n".join(x for x, s in zip(lines.to_pylist(), stay) if s), sum(stay)
                    kept.append(own)
                    total.append(n)
                    gone.append(n - left)
                yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], schema=schema)

        return rows.select("doc_id", "text", "digests").mapInArrow(run, "doc_id bigint, kept string, n_lines bigint, n_dropped bigint")


def text_sha256(col: str) -> Column:
    return F.sha2(F.col(col).cast("binary"), 256)
