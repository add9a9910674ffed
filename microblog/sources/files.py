"""File readers: labelled CSV corpus, tabular examples, vocabulary artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prep import missing_as_null
from ..schema import EXAMPLE_DDL, LABELLED_COLUMNS, LABELLED_DDL
from ..sinks import folders
from ..sinks.files import ESCAPED

VOCAB_DDL = "token STRING, idx BIGINT"


def _unescaped(df: DataFrame) -> DataFrame:
    """Line ends and backslashes as they were before ``sinks.files.write_csv``."""
    def plain(c: str) -> Column:
        parts = F.transform(F.split(F.col(c), r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.array_join(parts, "\\").alias(c)

    return df.select(*[plain(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def _read(spark: SparkSession, path: str, ddl: str, header: bool, escaped: bool | None, multiline: bool, **options) -> DataFrame:
    """CSV with a declared schema (no inference); quotes inside a field are
    doubled. Line ends are unescaped where the folder is marked so
    (``sinks.files.write_csv``), or as ``escaped`` says."""
    df = (spark.read.schema(ddl).option("header", header).option("mode", "PERMISSIVE")
          .option("quote", '"').option("escape", '"').option("multiLine", multiline)
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).options(**options).csv(path))
    if escaped is None:
        escaped = not set("*?[{") & set(path) and folders.marked(spark, f"{path}/{ESCAPED}")
    return _unescaped(df) if escaped else df


def read_labelled_csv(spark: SparkSession, path: str, header: bool = False, escaped: bool | None = None,
                      multiline: bool = False) -> DataFrame:
    """The raw corpus, the six columns named by position. ``header=False`` keeps
    the first row. Files are split among tasks; ``multiline`` is for files whose
    fields hold line ends (one task reads a whole file then)."""
    return _read(spark, path, LABELLED_DDL, header, escaped, multiline).toDF(*LABELLED_COLUMNS)


def read_examples_csv(spark: SparkSession, path: str, escaped: bool | None = None, multiline: bool = False) -> DataFrame:
    """Processed examples: header row skipped, fields label, text in order.
    Empty fields are missing."""
    return _read(spark, path, EXAMPLE_DDL, True, escaped, multiline, nullValue="")


def rescan_csv(spark: SparkSession, path: str, ddl: str, escaped: bool | None = None, multiline: bool = False) -> DataFrame:
    """Any CSV with a header, read as between two steps of the preparation job:
    empty fields and the strings that pandas takes for missing are null."""
    df = _read(spark, path, ddl, True, escaped, multiline, nullValue="")
    return missing_as_null(df, [c for c, t in df.dtypes if t == "string"])


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """token → index rows written by ``sinks.files.write_vocab``."""
    return spark.read.schema(VOCAB_DDL).json(path)
