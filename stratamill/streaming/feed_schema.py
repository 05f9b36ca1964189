"""The schema of a growing feed: stored with the table, widened by what new files bring."""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.operators.combine import union_sources
from stratamill.sources.files import read_files


def _common(known: T.DataType, fresh: T.DataType, name: str) -> T.DataType:
    if known == fresh:
        return known
    if isinstance(known, T.StructType) and isinstance(fresh, T.StructType):
        return widened(known, fresh)
    if isinstance(known, T.ArrayType) and isinstance(fresh, T.ArrayType):
        return T.ArrayType(_common(known.elementType, fresh.elementType, name))
    raise ValueError(f"column {name} changed from {known.simpleString()} to {fresh.simpleString()}")


def widened(known: T.StructType, fresh: T.StructType) -> T.StructType:
    """All columns of both, those of ``known`` first; a column that changed its type is an error."""
    new = {field.name: field for field in fresh.fields}
    fields = [
        T.StructField(f.name, _common(f.dataType, new[f.name].dataType, f.name)) if f.name in new else f
        for f in known.fields
    ]
    names = {f.name for f in known.fields}
    return T.StructType([*fields, *[f for f in fresh.fields if f.name not in names]])


def as_text(kind: T.DataType) -> T.DataType:
    """The same shape with text for every single value: JSON gives the same column numbers one day and text the next."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    return T.ArrayType(as_text(kind.elementType)) if isinstance(kind, T.ArrayType) else T.StringType()


def stored_schema(spark: SparkSession, store: str) -> T.StructType | None:
    """The schema kept at ``store``, if there is one."""
    return _stored(spark, store)[0]


def _rows(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("value string").text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _stored(spark: SparkSession, store: str) -> tuple[T.StructType | None, int]:
    """The schema and its version."""
    lines = _rows(spark, store)
    found = [json.loads(row.value) for row in lines.collect()] if lines is not None else []
    # Stores of an earlier form have no version; there, columns and time tell what is newest.
    newest = max(found, key=lambda x: (x.get("version", 0), x["number"], x.get("until", "")), default=None)
    return (T.StructType.fromJson(newest["schema"]), newest.get("version", 0)) if newest else (None, 0)


def _keep(spark: SparkSession, lines: list[str], path: str) -> None:
    frame = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    frame.write.mode("error").text(f"{path}/version={uuid.uuid4().hex}")


def literal(path: str) -> str:
    """The path as a pattern that only it matches."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def base_of(raw_path: str) -> str | None:
    """The folder below which folder names are columns; a path with patterns has none."""
    return None if re.search(r"[{}\[\]*?\\]", raw_path) else raw_path


def _schema_of(spark: SparkSession, raw_path: str, paths: list[str], fmt: str) -> T.StructType | None:
    """All columns of the files, with those that the folders below ``raw_path`` stand for."""
    options = {"merge": fmt == "parquet", "base": base_of(raw_path)}
    try:
        fresh = read_files(spark, [literal(path) for path in paths], fmt, **options).schema
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return as_text(fresh) if fmt == "json" else fresh


def keep_wider(spark: SparkSession, store: str, fresh: T.StructType | None) -> T.StructType | None:
    """The schema kept at ``store``, widened by ``fresh`` and kept again if that changed it."""
    schema, version = _stored(spark, store)
    wider = widened(schema, fresh) if schema and fresh else schema or fresh
    if wider is not None and wider != schema:
        line = {"version": version + 1, "number": len(wider.fields), "schema": wider.jsonValue()}
        _keep(spark, [json.dumps(line)], store)
    return wider


def header_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """CSV files by their header line; files without any line are left out.

    Only first lines leave the tasks: one for each of the files, of which a batch has a
    bounded number.
    """
    lines = spark.read.text([literal(path) for path in paths]).where("trim(value) <> ''")
    lines = lines.select("_metadata.file_path", "_metadata.file_block_start", "value", F.monotonically_increasing_id().alias("at"))
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first.collect():
        groups.setdefault(row.header.strip("\ufeff\r"), []).append(unquote(row.file_path))
    return [sorted(found) for _, found in sorted(groups.items())]


def _csv_group(spark: SparkSession, raw_path: str, paths: list[str], known: T.StructType | None) -> DataFrame:
    """Files of one header, by its names. Known columns keep their spelling; columns from folder names are text."""
    base = base_of(raw_path)
    names = read_files(spark, [literal(paths[0])], "csv", base=base).columns
    spelled = {f.name.lower(): f for f in known.fields} if known else {}
    fields = [spelled.get(name.lower(), T.StructField(name, T.StringType())) for name in names]
    # All these files have the same header, so reading by position reads by name.
    reader = spark.read.format("csv").schema(T.StructType(fields)).option("header", True).option("enforceSchema", True)
    reader = reader.option("basePath", base) if base is not None else reader
    return reader.load([literal(path) for path in paths])


def read_feed_files(
    spark: SparkSession, raw_path: str, paths: list[str], fmt: str, store: str | None, schema: str | None = None
) -> DataFrame | None:
    """The rows of some of a feed's files, by column names; None if they hold nothing.

    Without ``schema`` they have all columns that the feed has had so far, kept at ``store``,
    which the columns of these files widen first: footers of Parquet files, merged; the
    rows of JSON files, single values as text; the headers of CSV files, of which every one may
    have its own. Columns that a file lacks are NULL.
    """
    if fmt != "csv":
        wanted = schema or keep_wider(spark, store, _schema_of(spark, raw_path, paths, fmt))
        if wanted is None:
            return None
        return read_files(spark, [literal(path) for path in paths], fmt, schema=wanted, base=base_of(raw_path))
    known = T.StructType.fromDDL(schema) if schema else stored_schema(spark, store)
    groups = [_csv_group(spark, raw_path, group, known) for group in header_groups(spark, paths)]
    if not groups:
        return None
    if schema is None:
        fresh = groups[0].schema
        for frame in groups[1:]:
            fresh = widened(fresh, frame.schema)
        known = keep_wider(spark, store, fresh)
    every = union_sources(groups)
    return every.select([F.col(f.name) if f.name in every.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in known.fields])
