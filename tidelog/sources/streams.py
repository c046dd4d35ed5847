"""Streams over landed frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog import schemas
from tidelog.sources.lines import accepted, parse_lines


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Raw lines as a stream, from files in any folder below ``path``."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value")


def parsed_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Every line with its parsed ``row`` or its ``reject_reason``, as in ``parse_lines``.

    A stream has one sink: write it by batch with ``ingest.ingest_lines``, which
    stores frames and dead letters, or take ``accepted`` or ``rejected`` of it.
    """
    return parse_lines(text_stream(spark, path, max_files), schema)


def _frames(spark: SparkSession, path: str, schema: str, max_files: int | None) -> DataFrame:
    # Text and from_json read nested frames faster than the JSON source does.
    return accepted(parsed_stream(spark, path, schema, max_files))


def commit_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Decoded commit frames as a stream; the position is in the checkpoint.

    Lines that are no frame are not in it; :func:`parsed_stream` has them with a
    reason, and ``ingest_commits`` takes the raw lines of ``text_stream`` and sets those aside.
    """
    return _frames(spark, path, schemas.COMMIT, max_files)


def label_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Label frames of all endpoints as one stream.

    Frames may land in any folder below ``path``; the endpoint travels in the frame.
    """
    return _frames(spark, path, schemas.LABEL, max_files)
