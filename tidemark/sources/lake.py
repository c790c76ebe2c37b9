"""Folder layout, versioned tables, reading and writing."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables, under the shared folder of the session.

    The cluster names that folder in ``spark.checkpoint.dir``.  A local session
    without it uses its scratch folder; any other must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        root = f"{spark.conf.get('spark.local.dir', '/tmp')}/tidemark-work"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table and read it back: it is computed once, whoever reads it."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder and when they were last changed (ms); none if it is not there."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(jpath)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_parts(spark: SparkSession, folder: str, ending: str, target: str) -> int:
    """Move the files with this ending out of a folder to ``target`` followed by _0, _1, ... and the ending."""
    names = sorted(n for n, _ in children(spark, folder) if n.endswith(ending) and not n.startswith((".", "_")))
    for k, name in enumerate(names):
        fs, path = _fs(spark, f"{folder}/{name}")
        goal = spark._jvm.org.apache.hadoop.fs.Path(f"{target}_{k}{ending}")
        fs.mkdirs(goal.getParent())
        fs.rename(path, goal)
    return len(names)


LOAD = "_load"


class Lake:
    """Tables at ``root/layer[_env]/schema/table``.

    Every write fills a folder of its own (``_load=<id>``) that never changes.  A version is a small file that names
    the folders its rows lie in, and their schema; it appears by a rename once the rows are there, so a lost job leaves
    nothing half written and a job may read the table it replaces.  An append names one more folder; replaced
    periods stay out of the new list while the others keep their files.  Reading a version is one scan of its list.
    """

    def __init__(self, spark: SparkSession, root: str, env: str = "prod"):
        self.spark, self.root, self.env = spark, root.rstrip("/"), env

    def path(self, layer: str, schema: str, table: str) -> str:
        suffix = "" if self.env == "prod" else f"_{self.env}"
        return f"{self.root}/{layer}{suffix}/{schema}/{table}"

    def landing_path(self, source_type: str, source: str, schema: str, table: str) -> str:
        return f"{self.root}/landing/{source_type}/{source}/{schema}/{table}/"

    def versions(self, layer: str, schema: str, table: str) -> list[int]:
        return sorted(self._version_files(self.path(layer, schema, table)))

    def _version_files(self, base: str) -> dict[int, int]:
        """Version to the time it appeared (ms)."""
        found = ((re.fullmatch(r"v(\d+)\.json", n), at) for n, at in children(self.spark, f"{base}/_versions"))
        return {int(m[1]): at for m, at in found if m}

    def exists(self, layer: str, schema: str, table: str) -> bool:
        return bool(self.versions(layer, schema, table))

    def folders(self, layer: str, schema: str, table: str, version: int | None = None) -> list[str]:
        """The folders that hold the rows of a version, below the table's path."""
        return self._listed(self.path(layer, schema, table), version)["folders"]

    def _listed(self, base: str, version: int | None = None) -> dict:
        known = sorted(self._version_files(base))
        wanted = version if version is not None else (known[-1] if known else None)
        if wanted not in known:
            raise FileNotFoundError(f"{base} version {wanted}")
        return json.loads(read_text(self.spark, f"{base}/_versions/v{wanted}.json"))

    def read(
        self, layer: str, schema: str, table: str, version: int | None = None, as_type: StructType | None = None
    ) -> DataFrame:
        """The newest version, or the one asked for.  Columns that came later are NULL in earlier rows."""
        base = self.path(layer, schema, table)
        listed = self._listed(base, version)
        kind = as_type or StructType.fromJson(listed["schema"])
        if not listed["folders"]:
            return self.spark.createDataFrame([], kind)
        whole = StructType([*kind.fields, StructField(LOAD, StringType())])
        reader = self.spark.read.schema(whole).option("basePath", base)
        return reader.parquet(*[f"{base}/{f}" for f in listed["folders"]]).select(*kind.names)

    def _publish(self, base: str, change: Callable[[dict | None], dict]) -> int:
        """The next version: what ``change`` makes of the newest one's list, made anew if another writer was faster."""
        while True:
            known = sorted(self._version_files(base))
            listed = change(self._listed(base, known[-1]) if known else None)
            number = (known[-1] if known else 0) + 1
            fs, draft = _fs(self.spark, f"{base}/_versions/.{uuid.uuid4().hex}.draft")
            goal = self.spark._jvm.org.apache.hadoop.fs.Path(f"{base}/_versions/v{number}.json")
            out = fs.create(draft)
            out.write(bytearray(json.dumps(listed).encode()))
            out.close()
            if not fs.exists(goal) and fs.rename(draft, goal):
                return number
            fs.delete(draft, False)

    def write(
        self,
        df: DataFrame,
        layer: str,
        schema: str,
        table: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
    ) -> int:
        """Writes the next version: a new table, or with ``append`` rows that go on from the newest one.

        An append is partitioned as the table is; its new columns are added, other types are refused.
        """
        base = self.path(layer, schema, table)
        append = mode == "append" and self.exists(layer, schema, table)
        parts = list(partition_by)
        if append:
            before = self._listed(base)
            _merged(before["schema"], df.schema)
            if parts and parts != before["partitions"]:
                raise ValueError(f"{table} is partitioned by {before['partitions']}, not {parts}")
            parts = before["partitions"]
        if cluster_by:
            # the row hash at the end lets a very frequent value span several files
            spread = F.xxhash64(*df.columns)
            df = df.repartitionByRange(*cluster_by, spread).sortWithinPartitions(*cluster_by)
        load = self._load(df, base, parts)

        def change(newest: dict | None) -> dict:
            if append and newest:
                return {**newest, "schema": _merged(newest["schema"], df.schema), "folders": [*newest["folders"], load]}
            return {"schema": df.schema.jsonValue(), "partitions": parts, "folders": [load]}

        return self._publish(base, change)

    def _load(self, df: DataFrame, base: str, parts: Sequence[str]) -> str:
        load = f"{LOAD}={uuid.uuid4().hex}"
        writer = df.write.partitionBy(*parts) if parts else df.write
        writer.parquet(f"{base}/{load}")
        return load

    def append_extraction(self, df: DataFrame, schema: str, table: str, extracted: str) -> int:
        """Append-only bronze log with the extraction date as partition."""
        stamped = df.withColumn("_extraction_date", F.lit(extracted).cast("date"))
        return self.write(stamped, "bronze", schema, table, "append", ["_extraction_date"])

    def replace_periods(
        self, df: DataFrame, layer: str, schema: str, table: str, period: str, gone: DataFrame | None = None
    ) -> int:
        """The next version: the periods present in ``df`` (and those in ``gone``, a column of values) instead of the
        newest version's, all others from there, in the files they have.

        Only the new periods are written.  The rebalance groups rows by period but splits a period that is too big
        for one task, which the current month usually is.  A table that is not partitioned by the period yet
        is laid out anew, once.
        """
        base = self.path(layer, schema, table)
        before = self._listed(base) if self.exists(layer, schema, table) else None
        left = []
        if before and before["partitions"][:1] != [period]:
            _merged(before["schema"], df.schema)
            rest = self.read(layer, schema, table).join(df.select(period).distinct(), period, "left_anti")
            if gone is not None:
                rest = rest.join(gone.select(period).distinct(), period, "left_anti")
            left = [self._load(rest.hint("rebalance", period), base, [period])]
        load = self._load(df.hint("rebalance", period), base, [period])
        names = {n for n, _ in children(self.spark, f"{base}/{load}") if n.startswith(f"{period}=")}
        if gone is not None:
            path_of = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
            texts = gone.select(F.col(period).cast(df.schema[period].dataType).cast("string").alias("v")).distinct().collect()
            names |= {path_of(period, r["v"]) for r in texts}

        def change(newest: dict | None) -> dict:
            kept = left
            if newest and not left:
                kept = [f for old in newest["folders"] for f in self._without(base, old, names)]
            kind = _merged(newest["schema"], df.schema) if newest else df.schema.jsonValue()
            return {"schema": kind, "partitions": [period], "folders": [*kept, load]}

        return self._publish(base, change)

    def _without(self, base: str, folder: str, names: set[str]) -> list[str]:
        """What is left of a folder without its partitions of these names; the folder itself where it has none."""
        if "/" in folder:
            return [] if folder.split("/", 1)[1] in names else [folder]
        own = [n for n, _ in children(self.spark, f"{base}/{folder}") if "=" in n]
        return [f"{folder}/{n}" for n in own if n not in names] if names.intersection(own) else [folder]

    def compact(self, layer: str, schema: str, table: str) -> int:
        """The next version with the same rows in one folder, after very many small appends."""
        base = self.path(layer, schema, table)
        listed = self._listed(base)
        df = self.read(layer, schema, table)
        parts = listed["partitions"]
        load = self._load(df.hint("rebalance", *parts) if parts else df.hint("rebalance"), base, parts)
        seen = set(listed["folders"])
        # what others appended meanwhile stays
        return self._publish(base, lambda newest: {**newest, "folders": [load, *[f for f in newest["folders"] if f not in seen]]})

    def purge_versions(self, layer: str, schema: str, table: str, keep_hours: int, now_ms: int) -> list[int]:
        """Delete versions older than ``keep_hours`` at ``now_ms`` but the newest, and folders as old that no kept one names."""
        base, oldest = self.path(layer, schema, table), now_ms - keep_hours * 3_600_000
        ages = self._version_files(base)
        known = sorted(ages)
        old = [v for v in known[:-1] if ages[v] < oldest]
        named = {f.split("/")[0] for v in known if v not in old for f in self._listed(base, v)["folders"]}
        for version in old:
            self._delete(f"{base}/_versions/v{version}.json")
        for name, at in children(self.spark, base):
            # a folder that no version names may be one that a job is still writing
            if name.startswith(f"{LOAD}=") and name not in named and at < oldest:
                self._delete(f"{base}/{name}")
        return old

    def _delete(self, path: str) -> None:
        fs, jpath = _fs(self.spark, path)
        fs.delete(jpath, True)

    def materialize(self, name: str, df: DataFrame, how: str = "view", layer="gold", schema="main", **options) -> DataFrame:
        """``view`` registers a temp view, ``table`` overwrites, ``append`` adds; returns what to read."""
        if how == "view":
            df.createOrReplaceTempView(name)
            return self.spark.table(name)
        self.write(df, layer, schema, name, "append" if how == "append" else "overwrite", **options)
        return self.read(layer, schema, name)


def load_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A small CSV with header; a byte-order mark before the first column name is ignored."""
    return spark.read.csv(path, header=True, schema=schema, encoding="UTF-8", enforceSchema=True)


def _merged(before: dict, now: StructType) -> dict:
    """The stored schema with the new columns behind; a column keeps its type."""
    fields = {f.name: f for f in StructType.fromJson(before).fields}
    for field in now.fields:
        known = fields.setdefault(field.name, field)
        if known.dataType != field.dataType:
            raise ValueError(f"{field.name} is {known.dataType.simpleString()}, not {field.dataType.simpleString()}")
    return StructType([StructField(f.name, f.dataType, True) for f in fields.values()]).jsonValue()
