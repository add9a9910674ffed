"""CSV and JSON artifact writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import folders

# Name of the marker of folders whose texts have their line ends escaped.
ESCAPED = "_escaped"


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", escaped: bool = True) -> None:
    """Header row, no index column; no trimming. A text's line ends become
    backslash sequences (and its backslashes double), so that a row is a line and
    readers can split the files; a marker in the folder tells the readers.
    ``escaped=False`` writes texts as they are."""
    def line(c: str) -> Column:
        out = F.col(c)
        for a, b in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            out = F.replace(out, F.lit(a), F.lit(b))
        return out.alias(c)

    if escaped:
        df = df.select(*[line(c) if t == "string" else F.col(c) for c, t in df.dtypes])
    (df.write.mode(mode).option("header", header).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    if escaped:
        folders.mark(df.sparkSession, f"{path}/{ESCAPED}")


def write_vocab(vocab: DataFrame, path: str, mode: str = "overwrite") -> None:
    """token → index as JSON lines (stoi); index order gives itos."""
    vocab.select("token", "idx").write.mode(mode).json(path)
