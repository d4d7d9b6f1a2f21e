"""Readers for matrices, named sets, mapping tables and metadata."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tessella.frame import col

# extension of the path (without .gz) -> format and separator (fixed values)
EXTENSIONS = {
    "csv": ("csv", ","),
    "tsv": ("csv", "\t"),
    "tab": ("csv", "\t"),
    "txt": ("csv", "\t"),
    "parquet": ("parquet", None),
    "feather": ("feather", None),
}


def detect_format(path: str) -> tuple[str, str | None]:
    """Format and separator by file extension."""
    plain = re.sub(r"\.gz$", "", path.rstrip("/").lower())
    extension = plain.rsplit("/", 1)[-1].rsplit(".", 1)[-1]
    if extension not in EXTENSIONS:
        raise ValueError(f"unknown file type: {path}")
    return EXTENSIONS[extension]


def require_path(spark: SparkSession, path: str) -> str:
    """The path itself, or FileNotFoundError, on any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.globStatus(target):
        raise FileNotFoundError(path)
    return path


def id_first(df: DataFrame, index: int | str = 0) -> DataFrame:
    """Move the id column (by position or name) to the front, as text."""
    name = df.columns[index] if isinstance(index, int) else index
    rest = [col(c) for c in df.columns if c != name]
    return df.select(col(name).cast("string").alias(name), *rest)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing cells are NULL throughout: Spark's NaN equals itself and exceeds every number."""
    kinds = (T.DoubleType, T.FloatType)
    return df.select(*[
        F.when(~F.isnan(col(f.name)), col(f.name)).alias(f.name)
        if isinstance(f.dataType, kinds) else col(f.name) for f in df.schema.fields])


def load_csv(spark: SparkSession, path: str, sep: str = ",", index_col: int | str = 0,
             encoding: str = "utf-8", schema=None, multiline: bool = False,
             mode: str = "FAILFAST", partitions: int | None = None) -> DataFrame:
    """Delimited text with a header. ``NA`` and empty fields are missing.

    Give a schema for large inputs: inference reads the data twice. A ``.gz`` file cannot be
    split, so ``partitions`` spreads it after reading. Ragged lines fail unless ``mode`` says
    otherwise; ``rejected_lines`` counts them.
    """
    reader = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
              .option("nullValue", "NA").option("multiLine", multiline).option("mode", mode))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(require_path(spark, path))
    if partitions:
        df = df.repartition(partitions)
    blank = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    df = df.select(*[F.when(~col(c).isin("", "NA"), col(c)).alias(c) if c in blank else col(c)
                     for c in df.columns])
    return nan_to_null(id_first(df, index_col))


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   multiline: bool = False) -> DataFrame:
    """Lines that do not fit the schema, as ``line``."""
    field = T.StructField("_bad", T.StringType())
    read = (spark.read.option("header", True).option("sep", sep).option("nullValue", "NA")
            .option("multiLine", multiline).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_bad")
            .option("enforceSchema", True).schema(T.StructType([*schema.fields, field])).csv(path))
    return read.where(F.col("_bad").isNotNull()).select(F.col("_bad").alias("line"), *[
        col(f.name) for f in schema.fields])


def load_parquet(spark: SparkSession, path: str, index_col: int | str = 0) -> DataFrame:
    return nan_to_null(id_first(spark.read.parquet(path), index_col))


def _arrow_tables(data: bytes) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_file(io.BytesIO(data)) as reader:
        for i in range(reader.num_record_batches):
            yield reader.get_batch(i)


def load_feather(spark: SparkSession, path: str, index_col: int | str = 0,
                 schema: T.StructType | str | None = None) -> DataFrame:
    """Arrow files (one or a folder): each file is read by one task, batch by batch.

    The schema is taken from the first file unless given.
    """
    require_path(spark, path)
    folder = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if not re.search(r"\.(feather|arrow)$", urlparse(path).path):
        folder = folder.option("pathGlobFilter", "*.{feather,arrow}")
    files = folder.load(path).select("path", "content")
    if schema is None:
        from pyspark.sql.pandas.types import from_arrow_schema
        first = files.agg(F.min("path")).first()[0]  # paths only; then one file is read
        content = spark.read.format("binaryFile").load(first).select("content").first()[0]
        schema = from_arrow_schema(next(_arrow_tables(bytes(content))).schema)
    names = (schema if isinstance(schema, T.StructType)
             else T.StructType.fromDDL(schema)).fieldNames()

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                for table in _arrow_tables(content.as_py()):
                    yield table.select(names)

    return nan_to_null(id_first(files.select("content").mapInArrow(read, schema), index_col))


def load_matrix(spark: SparkSession, path: str, file_format: str | None = None,
                index_col: int | str = 0, **options) -> DataFrame:
    """Load by extension: csv, tsv/tab/txt (also gzipped), parquet or feather."""
    detected, sep = detect_format(path) if file_format is None else (file_format, None)
    require_path(spark, path)
    if detected == "csv":
        options.setdefault("sep", sep or ",")
        return load_csv(spark, path, index_col=index_col, **options)
    if detected == "tsv":
        return load_csv(spark, path, index_col=index_col, **{"sep": "\t", **options})
    if detected == "parquet":
        return load_parquet(spark, path, index_col)
    if detected == "feather":
        return load_feather(spark, path, index_col, **options)
    raise ValueError(f"unknown format: {detected}")


def line_position() -> Column:
    """Where a line stands in its files; the same in every run, unlike a plain row number."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start",
                    F.monotonically_increasing_id().alias("line"))


def load_gmt(spark: SparkSession, path: str, min_size: int = 5) -> DataFrame:
    """Named sets, one per line: name, description, members. Plain or gzipped.

    Sets need more than ``min_size`` members. ``position`` tells which of two sets of one name
    comes last.
    """
    fields = F.split(F.rtrim(F.col("value"), F.lit("\r")), "\t")
    return (spark.read.text(require_path(spark, path))
            .select(fields.alias("f"), line_position().alias("position"))
            .where(F.size("f") - 2 > min_size)
            .select(F.col("f")[0].alias("set_name"), F.col("f")[1].alias("description"),
                    F.slice("f", 3, F.greatest(F.size("f") - 2, F.lit(0))).alias("members"),
                    "position"))


def load_mapping(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Id mapping table, all text, with the line order kept in ``position``.

    The order decides which of several targets of an id counts.
    """
    raw = (spark.read.option("header", True).option("sep", sep).option("nullValue", "NA")
           .option("inferSchema", False).csv(require_path(spark, path)))
    return raw.withColumn("position", line_position())


# text that starts as a plain number (fixed value)
NUMERIC_TEXT = r"^[0-9]+\.?[0-9]*"


def load_metadata(df: DataFrame, id_col: str | None = None, max_levels: int = 25) -> DataFrame:
    """Type a metadata table: one job looks at every column.

    Columns with a single level go. Up to ``max_levels`` levels that repeat make a category (text); text that
    is all numbers becomes double; text that differs in every row is an id and goes; other text
    stays. A missing cell is a level of its own.
    """
    key = id_col or df.columns[0]
    cols = [c for c in df.columns if c != key]
    if not cols:
        return df.select(col(key))
    text = {c: col(c).cast("string") for c in cols}
    # levels are counted per column and value first, so that no row is expanded more than once
    counts = (df.select(*[text[c].alias(c) for c in cols])
              .unpivot([], [col(c) for c in cols], "_column", "_value")
              .groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_rows")))
    found = {r["_column"]: r for r in counts.groupBy("_column").agg(
        F.count(F.lit(1)).alias("levels"), F.sum("_rows").alias("rows"),
        F.bool_and(F.coalesce(F.col("_value").rlike(NUMERIC_TEXT), F.lit(False))).alias("numeric")).collect()}
    out = [col(key)]
    for c in cols:
        levels, rows, numeric = ((found[c][n] for n in ("levels", "rows", "numeric")) if c in found
                                 else (0, 0, False))
        if levels <= 1:
            continue
        if levels < rows and levels <= max_levels:
            out.append(text[c].alias(c))
        elif numeric:
            out.append(text[c].try_cast("double").alias(c))
        elif levels < rows:
            out.append(text[c].alias(c))
    return df.select(*out)
