"""Delimited text export and import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the field separator of the exchanged files.
SEPARATOR = "$%#@~"

_BLANK = "\u0000"  # what the parser reports for a blank field; never a field's own text


# How a line break is written in an escaped exchange; the mark itself comes first when writing and last when reading.
_ESCAPES = {"^": "^c", "\n": "^n", "\r": "^r"}


def _escaped(col: Column) -> Column:
    for plain, written in _ESCAPES.items():
        col = F.replace(col, F.lit(plain), F.lit(written))
    return col


def _unescaped(col: Column) -> Column:
    for plain, written in reversed(_ESCAPES.items()):
        col = F.replace(col, F.lit(written), F.lit(plain))
    return col


def write_delimited(df: DataFrame, path: str, sep: str = SEPARATOR, encoding: str = "UTF-8", escaped: bool = False, rows_per_file: int = 1_000_000) -> None:
    """Text files without header, of at most ``rows_per_file`` rows; NULL is written as a blank field, '' as a quoted one.

    Files are cut at line breaks, so that they can be read by many tasks. A line break inside a text fails the export, unless ``escaped``
    writes it as a mark (with the mark itself marked too), which a reader with ``escaped`` turns back.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    checked = {
        c: F.when(F.col(f"`{c}`").rlike(r"[\r\n]"), F.raise_error(F.lit(f"line break in {c}"))).otherwise(F.col(f"`{c}`")) for c in texts
    }
    if escaped:
        checked = {c: _escaped(F.col(f"`{c}`")) for c in texts}
    df.withColumns(checked).write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).csv(
        path, sep=sep, encoding=encoding, nullValue="", emptyValue='""', header=False,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = SEPARATOR,
                   encoding: str = "UTF-8", escaped: bool = False) -> DataFrame:
    """Text files by a declared schema; a blank field is NULL, a quoted empty one is ''. ``escaped`` as in ``write_delimited``.

    UTF-8 files are split between tasks. Two-byte encodings need whole-file parsing: each file is one task, of bounded size by
    the writer's ``rows_per_file``.
    """
    whole = encoding.upper().startswith("UTF-16")
    table = spark.read.schema(schema).csv(
        path, sep=sep, encoding=encoding, nullValue=_BLANK, emptyValue="", multiLine=whole, header=False, mode="FAILFAST",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    if not escaped:
        return table
    return table.withColumns({f.name: _unescaped(F.col(f"`{f.name}`")) for f in table.schema.fields if isinstance(f.dataType, T.StringType)})
