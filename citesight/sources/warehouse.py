"""Tables by name, replaced as a whole or not at all.

A new version of a table is written to a folder of its own.  Only when it is
complete, a small file that names the current version is replaced by a rename,
and readers follow that file: a write that is killed leaves the old version in
place.  The file also keeps what the version was made from (a digest), so that a
run can be taken up again, and how the table is clustered, so that any session
can read it with its buckets.

A table clustered by a key is bucketed and sorted on it: aggregates and joins
on the key need no exchange.  One bucket is one task, so a table in which a key
holds far more than its share is left unclustered.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import check_schema

#: A key may hold so many times the rows of an even bucket.
MAX_SKEW = 4
CURRENT = "_CURRENT"


class Warehouse:
    """Tables under ``root``, a folder that driver and executors share; with
    ``database`` they are also views of that catalog database."""

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database

    # -- the file that names the current version --------------------------------
    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def current(self, name: str) -> dict | None:
        """What is known of the current version; None if there is none."""
        path, fs = self._fs(f"{self.root}/{name}/{CURRENT}")
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, name: str, entry: dict) -> None:
        jvm = self.spark._jvm
        staged, fs = self._fs(f"{self.root}/{name}/.{uuid.uuid4().hex}")
        target, _ = self._fs(f"{self.root}/{name}/{CURRENT}")
        stream = fs.create(staged, True)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(staged, target, how)

    # -- writing -----------------------------------------------------------------
    def replace(self, name: str, df: DataFrame, key: str | None = None, buckets: int | None = None,
                schema: T.StructType | None = None, **facts) -> DataFrame:
        """Create or replace a table, and read it.  ``key`` clusters it (see the
        module); ``schema`` must be met; ``facts`` are kept with the version, a
        callable being asked once the rows are written."""
        if schema is not None:
            df = check_schema(df, schema)
        version = uuid.uuid4().hex
        path, table = f"{self.root}/{name}/{version}", f"{name}__{version}"
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if key is not None and not self._even(df, key, buckets):
            key = None
        if key is None:
            df.write.parquet(path)
        else:  # rows dealt as the buckets are: one file each
            (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
             .option("path", path).saveAsTable(table))
        entry = {"version": version, "key": key, "buckets": buckets if key else None, "schema": df.schema.json()}
        self._commit(name, entry | {k: v() if callable(v) else v for k, v in facts.items()})
        return self.table(name)

    @staticmethod
    def _even(df: DataFrame, key: str, buckets: int) -> bool:
        most, rows = df.groupBy(key).count().agg(F.max("count"), F.sum("count")).first()
        return not rows or most * buckets <= MAX_SKEW * rows

    # -- reading -----------------------------------------------------------------
    def table(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The current version; ``schema``, if given, must be its own."""
        entry = self.current(name)
        if entry is None:
            raise ValueError(f"no table {name} in {self.root}")
        df = self._read(name, entry)
        if self.database is not None:
            self._name(name, entry)
        return df if schema is None else check_schema(df, schema)

    def _read(self, name: str, entry: dict) -> DataFrame:
        path, kind = f"{self.root}/{name}/{entry['version']}", T.StructType.fromJson(json.loads(entry["schema"]))
        if entry["key"] is None:
            return self.spark.read.schema(kind).parquet(path)
        return self.spark.table(self._register(name, entry, path, kind))

    def _register(self, name: str, entry: dict, path: str, kind: T.StructType) -> str:
        """The catalog's entry for a version; made again in a session whose catalog lacks it."""
        table = f"{name}__{entry['version']}"
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)
            clustered = (f"CLUSTERED BY (`{entry['key']}`) SORTED BY (`{entry['key']}`) INTO {entry['buckets']} BUCKETS"
                         if entry["key"] else "")
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {clustered} LOCATION '{path}'")
        return table

    def _name(self, name: str, entry: dict) -> None:
        """The view by which SQL finds the current version."""
        path, kind = f"{self.root}/{name}/{entry['version']}", T.StructType.fromJson(json.loads(entry["schema"]))
        current = self.spark.catalog.currentDatabase()
        table = self._register(name, entry, path, kind)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS SELECT * FROM {current}.{table}")

    def vacuum(self, name: str) -> int:
        """Delete all versions but the current one (also unfinished ones);
        returns how many.  Not while the table is being written."""
        entry, gone = self.current(name), 0
        folder, fs = self._fs(f"{self.root}/{name}")
        for f in fs.listStatus(folder):
            version = f.getPath().getName()
            if version in (CURRENT, entry and entry["version"]):
                continue
            if f.isDirectory():
                self.spark.sql(f"DROP TABLE IF EXISTS {name}__{version}")
                gone += 1
            fs.delete(f.getPath(), True)
        return gone


def content_digest(df: DataFrame) -> str:
    """A digest of the rows, whatever their order and files: count, sum and
    exclusive or of row hashes."""
    row = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if isinstance(df.schema[c].dataType, (T.MapType, T.StructType))
                       else F.col(f"`{c}`") for c in df.columns])
    r = df.select(row.alias("h")).agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor("h")).first()
    return f"{','.join(df.columns)}:{r[0]}:{r[1]}:{r[2]}"
