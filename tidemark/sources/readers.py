"""Readers: listings, CSV registries, content flags, file bytes, and a paged listing as a Python data source."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from ..functions.text import as_bool, normalize_name, split_extension
from ..session import ship

NATIVE = "application/vnd.google-apps."
FOLDER, SHEET = NATIVE + "folder", NATIVE + "spreadsheet"

PERSON = T.StructType([T.StructField("displayName", T.StringType()), T.StructField("emailAddress", T.StringType())])
LISTING = T.StructType(
    [
        *(T.StructField(c, T.StringType()) for c in ("id", "name", "mimeType", "size", "md5Checksum", "createdTime", "modifiedTime", "viewedByMeTime", "driveId", "webViewLink")),
        T.StructField("owners", T.ArrayType(PERSON)),
        T.StructField("lastModifyingUser", PERSON),
        T.StructField("parents", T.ArrayType(T.StringType())),
        *(T.StructField(c, T.BooleanType()) for c in ("trashed", "starred", "shared")),
        T.StructField("capabilities", T.StructType([T.StructField(c, T.BooleanType()) for c in ("canEdit", "canShare", "canDelete")])),
    ]
)


def read_listing(spark: SparkSession, path: str, include_trashed: bool = False) -> DataFrame:
    """Nested listing objects from JSON lines or parquet; trashed ones are left out unless asked for."""
    df = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.schema(LISTING).json(path)
    return df if include_trashed else df.where(~F.coalesce(F.col("trashed"), F.lit(False)))


def _person(p):
    return F.coalesce(F.nullif(p["displayName"], F.lit("")), F.nullif(p["emailAddress"], F.lit("")), F.lit(""))


def to_items(listing: DataFrame) -> DataFrame:
    """Flat, typed inventory rows of listing objects. Texts are never null; a size that is no number is."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    mime = text("mimeType")
    return listing.select(
        text("id").alias("file_id"), text("name").alias("name"), normalize_name(text("name")).alias("normalized_name"), mime.alias("mime_type"),
        F.when(mime == FOLDER, "folder").when(mime == SHEET, "skipped_sheet").otherwise("file").alias("object_kind"),
        split_extension("name", mime).alias("extension"),
        F.when(F.col("size").rlike(r"^\d+$"), F.col("size")).try_cast("bigint").alias("size"),
        text("md5Checksum").alias("md5_checksum"), text("createdTime").alias("created_time"), text("modifiedTime").alias("modified_time"),
        F.array_join(F.filter(F.transform(F.coalesce("owners", F.array().cast(T.ArrayType(PERSON))), _person), lambda x: x != ""), ";").alias("owners"),
        F.coalesce(_person(F.col("lastModifyingUser")), F.lit("")).alias("last_modifying_user"),
        F.array_join(F.coalesce("parents", F.array().cast("array<string>")), ";").alias("parents"),
        text("driveId").alias("drive_id"), text("webViewLink").alias("web_view_link"),
        *(F.coalesce(c, F.lit(False)).alias(c) for c in ("trashed", "starred", "shared")),
        F.array_join(F.array_compact(F.array(*(F.when(F.col(f"capabilities.{c}"), F.lit(c)) for c in ("canEdit", "canShare", "canDelete")))), ";").alias("permissions"),
        F.startswith(mime, F.lit(NATIVE)).alias("is_native"),
    )


def read_registry(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """CSV with a header, all texts, no nulls; a byte order mark is skipped.

    Quoted fields may span lines, for which each file is read by one task;
    without `multiline` large files are split.
    """
    df = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("inferSchema", False).csv(path)
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c.lstrip("﻿")) for c in df.columns))


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder of any file system Spark knows."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in store.listStatus(path))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: that of the greatest `order`, then the greatest values."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in (order, *rest)))


def with_flags(items: DataFrame, flags: DataFrame, key: str = "file_id", order: str = "seq") -> DataFrame:
    """Left join of the last flag row of each key; items without one get ''. Flag columns with names of `items` are prefixed."""
    f = last_per_key(flags, key, order).drop(order)
    f = f.withColumnsRenamed({c: f"flag_{c}" for c in f.columns if c != key and c in items.columns})
    extra = [c for c in f.columns if c != key]
    return items.join(f, key, "left").select(*items.columns, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in extra))


def read_bytes(spark: SparkSession, path: str, most: int) -> DataFrame:
    """(path, length, content, status) of files; larger ones than `most` keep no content and say file_too_large."""
    df = spark.read.format("binaryFile").load(path)
    fits = F.col("length") <= most
    return df.select("path", "length", "modificationTime", F.when(fits, F.col("content")).alias("content"), F.when(fits, "ok").otherwise("file_too_large").alias("status"))


def content_hashes(files: DataFrame, most: int | None = None) -> DataFrame:
    """`files` (content, and mime_type if there is one) with `content_hash` and `export_hash`, sha256 or ''.

    The bytes of native documents are an export and have only an export hash;
    native kinds that are not exported, content above `most` bytes and null
    content have neither.
    """
    mime = F.coalesce(F.col("mime_type"), F.lit("")) if "mime_type" in files.columns else F.lit("")
    native = F.startswith(mime, F.lit(NATIVE))
    fits = F.col("content").isNotNull() if most is None else F.coalesce(F.length("content") <= most, F.lit(False))
    hashed = F.sha2("content", 256)
    return files.withColumns({"content_hash": F.when(~native & fits, hashed).otherwise(""), "export_hash": F.when((mime == NATIVE + "document") & fits, hashed).otherwise("")})


def get_object(listing: DataFrame, object_id: str) -> DataFrame:
    """One object of a listing by its id; the filter reaches the source."""
    return listing.where(F.col("id") == object_id)


def typed_registry(registry: DataFrame, numbers: tuple[str, ...] = ("size",), flags: tuple[str, ...] = ()) -> DataFrame:
    """A registry of texts with some columns typed: numbers that are none are 0 (fractions are cut), flags as as_bool() has them."""
    number = lambda c: F.coalesce(F.trim(c).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint")).alias(c)
    return registry.select(*(number(c) if c in numbers else as_bool(c).alias(c) if c in flags else F.col(c) for c in registry.columns))


class _Page(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


def _open(path: str):
    """(file system, path in it) of a location: local, or any store that pyarrow knows by its scheme (hdfs, s3, gs)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _ListingReader(DataSourceReader):
    """Pages of a JSON-lines listing, each a partition; tests of `trashed`, `driveId` and `id` are done at the source, as is the option `parent`."""

    def __init__(self, options: dict):
        self.path, self.page, self.parent = options["path"], int(options.get("pagesize", 1 << 20)), options.get("parent")
        self.where: dict[str, object] = {}

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute in (("trashed",), ("driveId",), ("id",)):
                self.where[f.attribute[0]] = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, path = _open(self.path)
        size = store.get_file_info(path).size
        return [_Page(self.path, at, min(at + self.page, size)) for at in range(0, size, self.page)] or [_Page(self.path, 0, 0)]

    def _wanted(self, x: dict) -> bool:
        if self.parent is not None and self.parent not in (x.get("parents") or ()):
            return False
        return all((bool(x.get(k)) if k == "trashed" else x.get(k)) == v for k, v in self.where.items())

    def read(self, partition: _Page) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        store, path = _open(partition.path)
        rows, schema = [], to_arrow_schema(LISTING)
        with store.open_input_file(path) as raw:
            f = io.BufferedReader(raw, 1 << 20)
            if partition.start:
                f.seek(partition.start - 1)
                f.readline()  # the line that began on the page before belongs to it
            while f.tell() < partition.stop and (line := f.readline()):
                if line.strip() and self._wanted(x := json.loads(line)):
                    x["trashed"] = bool(x.get("trashed"))
                    rows.append({k: x.get(k) for k in schema.names})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class ListingSource(DataSource):
    """A JSON-lines listing, read by pages: spark.read.format("paged_listing").option("path", ...).load() after register_listing."""

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> T.StructType:
        return LISTING

    def reader(self, schema) -> DataSourceReader:
        return _ListingReader(self.options)


def register_listing(spark: SparkSession) -> None:
    """Make the format known, with filters pushed down to it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ListingSource)
