"""Delimited record dumps: read, keep data lines, split, bind a schema,
and quarantine what does not fit (S1-S4).

The dump is plain text, one record per line, fields separated by a tab,
and a trailing field that is dropped.  The text reader and ``split`` are
used instead of the CSV reader because the CSV reader turns empty fields
into NULL and pads short lines with NULL, where a field-count check is
wanted.  Everything is a projection or a filter: the scan splits into as
many tasks as the files allow and nothing shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The record layout of the population dump (17 tab-separated
# fields, the last one dropped) and its data-line test (six digits first).
DUMP_COLUMNS = (
    "uid", "national_identifier", "first", "last", "mother_first", "father_first", "gender",
    "birth_city", "date_of_birth", "id_registration_city", "id_registration_district",
    "address_city", "address_district", "address_neighborhood", "street_address",
    "door_or_entrance_number",
)
UID_PATTERN = "^[0-9]{6}"
SEPARATOR = "\t"
TRAILER = "<NULL>"


def read_dump(spark: SparkSession, path: str | Sequence[str], *, file_column: str | None = None) -> DataFrame:
    """The dump's lines as a DataFrame ``value``, with the file that each came from in ``file_column`` if named."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    return lines if file_column is None else lines.select("value", F.col("_metadata.file_path").alias(file_column))


def write_dump(lines: DataFrame, path: str, *, column: str = "value", compression: str | None = None) -> None:
    """Write one text line per row under ``path`` (a line break inside a line would split it and is an error)."""
    whole = F.when(F.col(column).rlike("[\\r\\n]"), F.raise_error(F.lit("a dump line holds a line break"))).otherwise(F.col(column))
    lines.select(whole.cast("string").alias("value")).write.text(path, compression=compression)


def dump_lines(lines: DataFrame, *, pattern: str = UID_PATTERN, column: str = "value") -> DataFrame:
    """Data lines only (header, footer and notes fail the pattern)."""
    return lines.filter(F.col(column).rlike(pattern))


def _parts(value: Column, sep: str) -> Column:
    return F.split(value, re.escape(sep), -1)


def field_count(value: Column, sep: str = SEPARATOR) -> Column:
    """Number of fields of a line; NULL for a NULL line."""
    gone = F.length(value) - F.length(F.replace(value, F.lit(sep), F.lit("")))
    return (gone / len(sep)).cast("int") + 1


def dump_parse(lines: DataFrame, *, columns: Sequence[str] = DUMP_COLUMNS, sep: str = SEPARATOR,
               drop_last: int = 1, pattern: str | None = UID_PATTERN, column: str = "value") -> DataFrame:
    """S3: split each data line and bind the schema (all STRING, empty fields kept).

    Lines with a field count other than ``len(columns) + drop_last`` are
    not returned here; ``dump_rejects`` returns them with a reason.
    """
    n_fields = len(columns) + drop_last
    src = dump_lines(lines, pattern=pattern, column=column) if pattern else lines
    # fields are counted by their separators, so that a line is split only once
    parts = src.filter(field_count(F.col(column), sep) == n_fields).select(_parts(F.col(column), sep).alias("_p"))
    return (parts
            .select(*[F.col("_p").getItem(i).alias(c) for i, c in enumerate(columns)]))


def dump_rejects(lines: DataFrame, *, columns: Sequence[str] = DUMP_COLUMNS, sep: str = SEPARATOR,
                 drop_last: int = 1, pattern: str | None = UID_PATTERN, column: str = "value") -> DataFrame:
    """The lines ``dump_parse`` leaves out: ``value, n_parts, reason``.

    ``reason`` is ``no_uid`` for lines failing the data-line pattern and
    ``field_count`` for data lines with the wrong number of fields.
    """
    n_fields = len(columns) + drop_last
    v = F.col(column)
    n_parts = field_count(v, sep)
    reason = F.when(n_parts != n_fields, F.lit("field_count"))
    if pattern:
        reason = F.when(~v.rlike(pattern), F.lit("no_uid")).otherwise(reason)
    return (lines.select(v.alias("value"), n_parts.alias("n_parts"), reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


def format_dump(df: DataFrame, columns: Sequence[str], *, sep: str = SEPARATOR,
                trailer: str | None = TRAILER) -> DataFrame:
    """Write-side counterpart: one dump line per row (NULL fields become empty)."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    if trailer is not None:
        fields.append(F.lit(trailer))
    # generated, so that filters on the line do not repeat the expression that makes it
    return df.select(F.explode(F.array(F.concat_ws(sep, *fields))).alias("value"))
