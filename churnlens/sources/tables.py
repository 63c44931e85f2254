"""Table targets (read, replace, append) and JSON reports."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.session import freed_shuffles

_MODES = ("replace", "append")
_VERSION = "_v="  # read as a partition column where a table spans versions
_POINTER = "_CURRENT"
_FIELDS = "_FIELDS"
_PARTS = "_PARTS"
SYNTHETIC_KEY = "_id"


class TableTarget:
    """A persisted table at a path: read whole, write replace or append.

    ``replace`` writes a version folder beside the versions before it and then
    switches a small pointer file to it, so a reader sees one whole table or
    the other, also when a writer dies half-way; nothing is copied. The
    version before is kept for frames that still read it, older ones are
    deleted. An empty input leaves an empty table that keeps its schema.
    ``replace_parts`` replaces some folders of a table laid out by one column in the same way: the new version holds
    them alone and refers to the versions before for all others, which are neither read nor copied.
    ``append`` adds rows and keeps history; rows may gain fields, which are noted in a small file beside the data, so
    every field of every append is read back (null where an append had none). A field that comes back with another type, or in
    another case, is an error, and nothing is written. Appends that add fields must not run at the same time. Spark tasks write their
    partitions in parallel; there is no driver-side batching.
    """

    def __init__(self, path: str, mode: str = "replace", fmt: str = "parquet",
                 schema: T.StructType | None = None, partition_by: list[str] | None = None,
                 files_per_partition: int | None = None, empty_schema: T.StructType | None = None,
                 sort_by: list[str] | None = None, options: Mapping[str, str] | None = None):
        """``partition_by`` lays the table out in folders by those columns;
        declare ``schema`` with it, so partition values are typed from the
        schema (an inferred timestamp would be read as a zone-aware one).
        ``files_per_partition`` spreads each partition value over that many
        hash buckets before writing: a bounded number of files per folder,
        without sending a whole partition value through one task. Without it the files
        follow the size: rows are rebalanced by the partition columns, so adaptive execution splits a large
        partition value over tasks of the session's advisory size and joins small ones.
        ``sort_by`` sorts the rows of each file and gives it a Bloom filter on those columns, so a reader of a few of
        their values skips the rest of the files. ``options`` go to the writer.
        ``empty_schema`` is what a table never written reads as, where the
        written one keeps the types of its source."""
        if mode not in _MODES:
            raise ValueError(f"a table is written with mode {' or '.join(map(repr, _MODES))}; {mode!r} is neither")
        self.path = path
        self.mode = mode
        self.fmt = fmt
        self.schema = schema
        self.partition_by = partition_by or []
        self.files_per_partition = files_per_partition
        self.empty_schema = empty_schema or schema
        self.sort_by = sort_by or []
        self.options = dict(options or {})

    @classmethod
    def from_config(cls, config: Mapping) -> "TableTarget":
        try:
            path = config["path"]
        except KeyError as exc:
            raise KeyError(f"no 'path' among the table's settings {sorted(config)}") from exc
        return cls(path, mode=config.get("mode", "replace"), fmt=config.get("format", "parquet"))

    def describe(self) -> dict:
        return {"path": self.path, "mode": self.mode, "format": self.fmt}

    def write(self, df: DataFrame) -> None:
        if not isinstance(df, DataFrame):
            raise TypeError(f"only a pyspark DataFrame can be written as a table, this is a {type(df).__name__}")
        spark = df.sparkSession
        if self.schema is not None and (odd := [c for c in df.columns if c not in self.schema.names]):
            raise ValueError(f"columns {odd} are not in the table's declared schema")
        if self.mode == "append":
            location = self._location(spark)
            if self.schema is None:
                known = self._fields(spark, location)
                merged = merged_fields(known, df.schema)
                if merged != known:
                    self._put(spark, location, _FIELDS, merged.json())  # first: a field without rows yet reads as null
            with freed_shuffles(spark):
                self._writer(df).mode("append").save(location)
            return
        self._publish(spark, self._write_version(df))

    def _write_version(self, df: DataFrame) -> str:
        version = f"{_VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        with freed_shuffles(df.sparkSession):
            self._writer(df).mode("errorifexists").save(f"{self.path.rstrip('/')}/{version}")
        return version

    def replace_parts(self, df: DataFrame) -> None:
        """Replace the partition values that ``df`` holds; all others stay as they are, by reference. A reader sees
        the table before or after, never a mix. Only for a replaced table with a declared schema that is laid out by
        one column; such writes must not run at the same time. An empty frame changes nothing."""
        if self.mode != "replace" or self.schema is None or len(self.partition_by) != 1:
            raise ValueError("parts are replaced in a table of mode 'replace' with a declared schema and one partition column")
        spark = df.sparkSession
        before = self._current(spark)
        if before is None and self.exists(spark):
            raise ValueError(f"the table at {self.path} was not written by versions")
        version = self._write_version(df)
        parts = {**self._parts(spark, before), **{folder: version for folder in self._folders(spark, version)}}
        self._put(spark, f"{self.path.rstrip('/')}/{version}", _PARTS, json.dumps(parts))
        self._publish(spark, version)

    def _folders(self, spark: SparkSession, version: str) -> list[str]:
        """Names of a version's partition folders."""
        fs, root = hadoop_path(spark, f"{self.path.rstrip('/')}/{version}")
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        return [n for n in names if n.startswith(f"{self.partition_by[0]}=")]

    def _parts(self, spark: SparkSession, version: str | None) -> dict[str, str]:
        """The version that holds each partition folder of ``version``."""
        if version is None:
            return {}
        text = self._get(spark, f"{self.path.rstrip('/')}/{version}", _PARTS)
        return json.loads(text) if text else {folder: version for folder in self._folders(spark, version)}

    def _held(self, spark: SparkSession, version: str | None) -> set[str]:
        """The versions whose files ``version`` reads."""
        text = None if version is None else self._get(spark, f"{self.path.rstrip('/')}/{version}", _PARTS)
        return {version} | (set(json.loads(text).values()) if text else set())

    def _put(self, spark: SparkSession, folder: str, name: str, text: str) -> None:
        """Replace a small file in one rename."""
        fs, root = hadoop_path(spark, folder)
        jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
        fs.mkdirs(root)
        draft = jvm.Path(root, f".{name}-{uuid.uuid4().hex[:8]}")
        stream = fs.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        jvm.FileContext.getFileContext(fs.makeQualified(root).toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
            draft, jvm.Path(root, name), _overwrite(spark, jvm))

    def _get(self, spark: SparkSession, folder: str, name: str) -> str | None:
        """Text of a small file, if it is there."""
        fs, root = hadoop_path(spark, folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def _fields(self, spark: SparkSession, location: str) -> T.StructType | None:
        """The fields of all appends so far; those of a table written without the file are merged from its data files."""
        text = self._get(spark, location, _FIELDS)
        if text:
            return T.StructType.fromJson(json.loads(text))
        fs, root = hadoop_path(spark, location)
        if not fs.exists(root) or not any(not s.getPath().getName().startswith((".", "_")) for s in fs.listStatus(root)):
            return None
        reader = spark.read.format(self.fmt)
        return (reader.option("mergeSchema", "true") if self.fmt in ("parquet", "orc") else reader).load(location).schema

    def _publish(self, spark: SparkSession, version: str) -> None:
        """Make ``version`` the table: the pointer is replaced in one rename."""
        fs, root = hadoop_path(spark, self.path)
        before = self._current(spark)
        keep = self._held(spark, version) | self._held(spark, before)
        self._put(spark, self.path, _POINTER, version)
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(_VERSION) and name not in keep:
                fs.delete(status.getPath(), True)

    def _current(self, spark: SparkSession) -> str | None:
        """Name of the version that the pointer shows, if there is one."""
        return self._get(spark, self.path, _POINTER)

    def _location(self, spark: SparkSession) -> str:
        """The folder of the data files: the current version, or the path itself."""
        version = self._current(spark)
        return f"{self.path.rstrip('/')}/{version}" if version else self.path

    def _writer(self, df: DataFrame):
        if self.partition_by and self.files_per_partition:
            others = [F.col(f"`{c}`") for c in df.columns if c not in self.partition_by]
            bucket = F.pmod(F.xxhash64(*others), F.lit(int(self.files_per_partition)))
            df = df.repartition(*[F.col(c) for c in self.partition_by], bucket)
        elif self.partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in self.partition_by])
        if self.sort_by:
            df = df.sortWithinPartitions(*self.partition_by, *self.sort_by)
        writer = df.write.format(self.fmt)
        for c in self.sort_by if self.fmt == "parquet" else ():
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer = writer.options(**self.options)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        return writer

    def exists(self, spark: SparkSession) -> bool:
        fs, jpath = hadoop_path(spark, self.path)
        return bool(fs.exists(jpath))

    def read(self, spark: SparkSession) -> DataFrame:
        """Whole table. A table never written reads as empty when its schema
        is declared (the schema is kept), else it is an error."""
        if self.empty_schema is not None and not self.exists(spark):
            return spark.createDataFrame([], self.empty_schema)
        reader = spark.read.format(self.fmt)
        location = self._location(spark)
        schema = self.schema
        if schema is None and self.mode == "append":
            schema = self._fields(spark, location)
        if schema is not None:
            reader = reader.schema(schema)
        parts = self._get(spark, location, _PARTS) if self.schema is not None and self.partition_by else None
        if parts is not None:  # folders of several versions, in one scan
            root = self.path.rstrip("/")
            found = [f"{root}/{version}/{folder}" for folder, version in sorted(json.loads(parts).items())]
            if not found:
                return spark.createDataFrame([], self.schema)
            reader = (spark.read.format(self.fmt).option("basePath", root)
                      .schema(T.StructType([*self.schema.fields, T.StructField(_VERSION[:-1], T.StringType())])))
            df = reader.load(found)
        else:
            df = reader.load(location)
        if schema is not None:  # partition columns come last from the reader
            return df.select(*[F.col(f"`{c}`") for c in schema.names if self.schema is not None or c != SYNTHETIC_KEY])
        # a store-assigned synthetic key is never part of the table
        return df.drop(SYNTHETIC_KEY) if SYNTHETIC_KEY in df.columns else df


def merged_fields(known: T.StructType | None, new: T.StructType) -> T.StructType:
    """The fields of both, the known ones first. A field with another type or in another case raises ``ValueError``."""
    fields = list(known.fields) if known is not None else []
    by_name = {f.name.lower(): f for f in fields}
    for f in new.fields:
        have = by_name.get(f.name.lower())
        if have is None:
            fields.append(T.StructField(f.name, f.dataType))
        elif have.name != f.name or have.dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"field {f.name!r} ({f.dataType.simpleString()}) clashes with {have.name!r} ({have.dataType.simpleString()}) of the table")
    return T.StructType(fields)


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) for a table location, through the session's Hadoop
    configuration, so the same code works on local disk, HDFS or object stores."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def file_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files in a folder, from its listing."""
    fs, jpath = hadoop_path(spark, path)
    return int(fs.getContentSummary(jpath).getLength())


def _overwrite(spark: SparkSession, jvm):
    """The one-element array of rename options that replaces a file."""
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 1)
    options[0] = getattr(jvm, "Options$Rename").OVERWRITE
    return options


def write_report_json(report: DataFrame, path: str) -> None:
    """A report is a one-row frame (structs and arrays of structs)."""
    with freed_shuffles(report.sparkSession):
        report.coalesce(1).write.mode("overwrite").json(path)


def read_report_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
