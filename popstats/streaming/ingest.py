"""Incremental dump ingest with Structured Streaming.

The reference has no streaming.  What carries over unchanged is the
ingest path: ``dump_lines`` / ``dump_parse`` / ``dump_rejects`` /
``clean_dates`` are projections and filters, so they apply as they are to
a streaming text source.  New dump files dropped into a folder are parsed
once each, and the file sink with a checkpoint gives exactly-once output
that survives a restart or a lost executor.  No stateful operator is
involved, so no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from popstats.functions.dates import clean_dates
from popstats.session import ensure_checkpoint_dir
from popstats.sources.dump import DUMP_COLUMNS, SEPARATOR, UID_PATTERN, dump_parse, dump_rejects


def read_dump_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files under ``path`` as a streaming DataFrame ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def parsed_stream(lines: DataFrame, *, columns: Sequence[str] = DUMP_COLUMNS, date_column: str | None = None,
                  sep: str = SEPARATOR, pattern: str = UID_PATTERN) -> DataFrame:
    """Parsed records of a streaming (or static) line frame.

    When ``date_column`` names the text date field, its parsed date and
    ``date_status`` are added; rows with a malformed date stay, marked.
    """
    parsed = dump_parse(lines, columns=columns, sep=sep, pattern=pattern)
    return clean_dates(parsed, date_column, drop_malformed=False) if date_column else parsed


def rejects_stream(lines: DataFrame, *, columns: Sequence[str] = DUMP_COLUMNS, sep: str = SEPARATOR,
                   pattern: str = UID_PATTERN) -> DataFrame:
    return dump_rejects(lines, columns=columns, sep=sep, pattern=pattern)


def start_ingest(spark: SparkSession, source: str, target: str, *, columns: Sequence[str] = DUMP_COLUMNS,
                 date_column: str | None = None, checkpoint: str | None = None,
                 trigger_once: bool = False, query_name: str | None = None):
    """Start a query that appends parsed records from ``source`` to parquet at
    ``target``.  The checkpoint defaults to a folder under the session's
    shared checkpoint directory.  Lines that do not parse go to no parsed
    record: start ``start_rejects`` beside it to keep them."""
    out = parsed_stream(read_dump_stream(spark, source), columns=columns, date_column=date_column)
    return _append(spark, out, target, checkpoint, trigger_once, query_name, "ingest")


def start_rejects(spark: SparkSession, source: str, target: str, *, columns: Sequence[str] = DUMP_COLUMNS,
                  checkpoint: str | None = None, trigger_once: bool = False, query_name: str | None = None):
    """Start a query that appends the lines ``start_ingest`` leaves out, with the reason, to parquet."""
    out = rejects_stream(read_dump_stream(spark, source), columns=columns)
    return _append(spark, out, target, checkpoint, trigger_once, query_name, "rejects")


def _append(spark, out: DataFrame, target: str, checkpoint: str | None, trigger_once: bool,
            query_name: str | None, kind: str):
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{query_name or 'dump'}"
    writer = (out.writeStream.format("parquet").option("path", target)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if query_name:
        writer = writer.queryName(query_name)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
