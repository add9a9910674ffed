"""A directory of post files as a live source.

Files that appear in the directory are read once each; the checkpoint of the
query remembers which. Writers move whole files in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import TWEET_DDL

# Options by format, so that no row is lost silently: a JSON line that does not
# parse becomes a row of nulls, which ``functions.json.route`` style checks find.
FORMATS = ("json", "parquet")


def read_posts(spark: SparkSession, path: str, fmt: str = "json", ddl: str = TWEET_DDL, max_files_per_trigger: int | None = None,
               archive: str | None = None, delete: bool = False) -> DataFrame:
    """Posts of the files in ``path`` (any Hadoop path, a pattern allowed), as
    they come, oldest first. ``max_files_per_trigger``: files in a micro-batch
    (all there are, if not given). Files whose batch is done stay, or move to
    ``archive`` (not below ``path``), or are deleted."""
    if fmt not in FORMATS:
        raise ValueError(f"the format must be one of {FORMATS}")
    if archive and delete:
        raise ValueError("files are archived or deleted, not both")
    reader = spark.readStream.schema(ddl).format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    elif delete:
        reader = reader.option("cleanSource", "delete")
    return reader.load(path)
