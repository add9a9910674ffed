"""Corpus preparation: rename/drop, clean, shuffle, remap, missing and blank
rows, splits and first-n (the preparation job, fused into one lazy plan)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import text as T
from ..functions.labels import label_remap
from .common import bind_once, stored  # noqa: F401  part of the preparation job's interface
from .indexing import global_rank

# Strings a pandas CSV scan reads back as missing by default.
NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Columns dropped from the labelled corpus.
DROPPED = ["id", "date", "query", "user"]

# Fixed value: the 70/30 split trains on ids whose md5 (of the id as text) is
# below this prefix: 0.7 of the range of four hexadecimal digits.
SPLIT_BELOW = "b333"

# Seed of the reproducible row shuffle.
SHUFFLE_SEED = 42


def rename_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def missing_as_null(df: DataFrame, cols: list[str], na_values: list[str] = NA_VALUES) -> DataFrame:
    """The CSV round-trip null rule: listed strings become NULL."""
    return df.select(*[
        (F.when(F.col(c).isin(*na_values), F.lit(None)).otherwise(F.col(c)).alias(c)
         if c in cols else F.col(c))
        for c in df.columns
    ])


def drop_missing(df: DataFrame, string_cols: list[str], na_values: list[str] = NA_VALUES) -> DataFrame:
    """Rows with any missing value (after the null rule) are removed."""
    return missing_as_null(df, string_cols, na_values).na.drop("any")


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Whitespace-only values become missing and the row is dropped."""
    return df.filter(F.col(col).isNotNull() & ~T.is_blank(col))


def shuffle_key(key: str, seed: int = SHUFFLE_SEED) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))


def shuffle_rows(df: DataFrame, key: str, seed: int = SHUFFLE_SEED) -> DataFrame:
    """Reproducible shuffle: a global sort on a seeded hash of the key (the
    same order under any partitioning)."""
    return df.orderBy(shuffle_key(key, seed), F.col(key))


def shuffled_positions(df: DataFrame, key: str, seed: int = SHUFFLE_SEED) -> DataFrame:
    """Every row with its position (from 1) in the shuffled order, without a
    sort in one task."""
    return global_rank(df.withColumn("_key", shuffle_key(key, seed)), [F.col("_key"), F.col(key)], out="pos").drop("_key")


def is_train(id_col: Column | str) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(c.cast("string").cast("binary")) < F.lit(SPLIT_BELOW)


def split(df: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Stable 70/30 split on the id (independent of partitioning and runs)."""
    flag = is_train(id_col)
    return df.filter(flag), df.filter(~flag)


def preview(df: DataFrame, n: int = 5, key: str | None = None) -> DataFrame:
    """A few rows to look at: the first by ``key``, else any."""
    return head_n(df, n, key) if key else df.limit(n)


def head_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """First ``n`` rows by ``key`` (a top-k, not a full sort)."""
    return df.orderBy(F.col(key)).limit(n)


def valid_text(c: Column, na_values: list[str] = NA_VALUES) -> Column:
    """Survives the missing rule (C9) and the blank rule (C10)."""
    return c.isNotNull() & ~c.isin(*na_values) & ~T.is_blank(c)


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled corpus through the preparation rules, all rows: id, label, text.

    Same rows as ``drop_blank(drop_missing(…))`` of the cleaned corpus with
    the cleaner evaluated once per row."""
    raw = rename_columns(schema.labelled_raw(spark, sf_dir), schema.LABELLED_COLUMNS)
    labelled = raw.select("id", label_remap("sentiment").alias("label"), "tweet").filter(F.col("label").isNotNull())
    return bind_once(labelled, "text", T.clean_full("tweet"), keep=valid_text).select("id", "label", "text")


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preparation job: the whole prepared corpus with its shuffled position."""
    return shuffled_positions(examples(spark, sf_dir), "id")


# The subsets that the preparation job cuts from the head of the
# shuffled corpus, one from the other.
SUBSETS = (100_000, 1_000)


def shuffled_head(df: DataFrame, n: int, key: str, seed: int = SHUFFLE_SEED) -> DataFrame:
    """The rows at positions 1 to ``n`` of the shuffle (a top-k, no full sort)."""
    return shuffle_rows(df, key, seed).limit(n)


def first_prepared(spark: SparkSession, sf_dir: str, subsets: tuple[int, ...] = SUBSETS) -> DataFrame:
    """The step after it: the head of the shuffled corpus, cut again and again."""
    return shuffled_head(examples(spark, sf_dir), min(subsets), "id")
