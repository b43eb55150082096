"""Lossless text options shared by CSV writers and readers.

Defaults lose information: timestamps are cut to milliseconds, ``''`` reads
back as null, and a line break inside a field splits the row unless each file
is read in one task. These options keep microseconds and tell empty from
null; :func:`escape_breaks` writes line breaks as ``\\n`` and ``\\r`` (and a
backslash as two), so that files stay splittable, and
:func:`unescape_breaks` undoes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.timefn import TEXT_TIMESTAMP_FORMAT

# Fixed value: the token written for SQL NULL in text files.
NULL_TOKEN = "\\N"


def csv_options(header: bool = True) -> dict[str, str]:
    return {
        "header": str(header).lower(),
        "timestampFormat": TEXT_TIMESTAMP_FORMAT,
        "timestampNTZFormat": TEXT_TIMESTAMP_FORMAT,
        "nullValue": NULL_TOKEN,
        "escape": '"',
    }


def _on_text(df: DataFrame, change) -> DataFrame:  # noqa: ANN001 - Column -> Column
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def escape_breaks(df: DataFrame) -> DataFrame:
    """Text columns without line breaks, for line-based files."""
    def change(c: Column) -> Column:
        c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        return F.replace(F.replace(c, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))

    return _on_text(df, change)


def unescape_breaks(df: DataFrame) -> DataFrame:
    """The text columns as they were before :func:`escape_breaks`."""
    def change(c: Column) -> Column:
        # Pairs of backslashes, taken from the left, part the text; what is left of them are breaks.
        parts = F.transform(F.split(c, r"\\\\", -1), lambda x: F.replace(
            F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.array_join(parts, "\\")

    return _on_text(df, change)
