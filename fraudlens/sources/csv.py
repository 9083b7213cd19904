"""Header CSV files (RFC 4180), every value read as text (no inference pass).

A quote inside a quoted field is doubled; a backslash is an ordinary
character.  An empty field is null, a quoted empty one the empty text.  Fields
with line breaks need ``multi_line``, which reads a file as one split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

_NOTHING = "\u0000"     # what an unquoted empty field is parsed to, and then read as null


def read_csv(spark: SparkSession, path: str, columns=None, multi_line: bool = False) -> DataFrame:
    """All-string read.  Names come from the header, or from ``columns``.
    Every file's own header is checked against them: a folder of files with
    other or reordered headers is refused, not read with shifted columns."""
    r = (spark.read.option("header", True).option("inferSchema", False).option("quote", '"')
         .option("escape", '"').option("multiLine", multi_line).option("nullValue", _NOTHING))
    names = columns or r.csv(path).columns
    schema = StructType([StructField(c, StringType(), True) for c in names])
    return r.schema(schema).option("enforceSchema", False).csv(path)
