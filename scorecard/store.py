"""Output tables: versioned Parquet folders under one root.

A version counts once its write has committed, which Spark marks with a
``_SUCCESS`` file, so a failed or half-written run is never read. ``full-N``
replaces what came before it; ``delta-N`` adds rows to it.

A table that loads change in part is dealt into buckets by a hash of one column.
Its version ``list-N`` is a short table that names the folders of each bucket. A
load writes the buckets it changes into a new folder and lists the others as they
were, so what it reads and writes grows with what changed. The list is written last:
without it the new folders belong to nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FULL = "full"
DELTA = "delta"
LIST = "list"
DATA = "data"

# Buckets of a dealt table; choose so many that one holds some 100 MB to 1 GB, for
# small rewrites. A list has at most ``FOLDERS`` rows for each: a bucket with more is
# put together again.
BUCKETS = 16
FOLDERS = 8
# Memory of a task for the row groups of all buckets it writes.
WRITE_BYTES = 256 << 20
LIST_SCHEMA = "bucket int, buckets int, folder string, label string, schema string"
# The row of a list that has the schema, in place of a folder.
NO_BUCKET = -1


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def _folders(self, path: str) -> list:
        """Status of the folders in a folder."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []

    def _has(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        file = jvm.org.apache.hadoop.fs.Path(path)
        return file.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(file)

    def _versions(self, name: str, kinds: tuple[str, ...] = (FULL, DELTA, LIST), committed: bool = True) -> list[str]:
        """Version folders of a table, oldest first."""
        folder = f"{self.root}/{name}"
        found = [s.getPath().getName() for s in self._folders(folder)]
        found = [v for v in found if v.split("-")[0] in kinds]
        if committed:
            found = [v for v in found if self._has(f"{folder}/{v}/_SUCCESS")]
        return sorted(found, key=lambda v: int(v.split("-")[1]))

    def _current(self, name: str) -> list[str]:
        versions = self._versions(name)
        starts = [i for i, v in enumerate(versions) if not v.startswith(DELTA)]
        return versions[starts[-1] :] if starts else []

    def _next(self, name: str) -> str:
        used = [int(v.split("-")[1]) for v in self._versions(name, (FULL, DELTA, LIST, DATA), committed=False)]
        return f"{max(used, default=0) + 1:06d}"

    def version(self, name: str) -> str:
        """The name of what is read now."""
        return self._current(name)[-1]

    def path(self, name: str) -> str:
        """The folder of a table that is one full version."""
        current = self._current(name)
        if len(current) != 1 or not current[0].startswith(FULL):
            raise ValueError(f"{name} is not one folder")
        return f"{self.root}/{name}/{current[0]}"

    def exists(self, name: str) -> bool:
        return bool(self._current(name))

    def read(self, name: str) -> DataFrame:
        current = self._current(name)
        if not current:
            raise FileNotFoundError(f"no committed version of {name} under {self.root}")
        if current[0].startswith(LIST):
            return self._read_buckets(name, self._listed(name))
        return self.spark.read.parquet(*[f"{self.root}/{name}/{v}" for v in current])

    def _write(self, name: str, df: DataFrame, kind: str) -> DataFrame:
        path = f"{self.root}/{name}/{kind}-{self._next(name)}"
        df.write.parquet(path)
        return self.read(name)

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Write a new full version and return it; ``df`` may read the old one."""
        return self._write(name, df, FULL)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows to the current version without rewriting it."""
        if not self.exists(name):
            return self.replace(name, df)
        return self._write(name, df, DELTA)

    # ------------------------------------------------------------- dealt tables

    def _listed(self, name: str) -> list:
        """Rows of the newest list: at most ``FOLDERS`` a bucket."""
        return self.spark.read.schema(LIST_SCHEMA).parquet(f"{self.root}/{name}/{self._current(name)[0]}").collect()

    def _read_buckets(self, name: str, listed: list) -> DataFrame:
        schema = StructType.fromJson(json.loads(next(r["schema"] for r in listed if r["bucket"] == NO_BUCKET)))
        paths = [f"{self.root}/{name}/{r['folder']}" for r in listed if r["bucket"] != NO_BUCKET]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    @staticmethod
    def _bucket(key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def _write_buckets(
        self, name: str, df: DataFrame, key: str, buckets: int, gather: bool = False
    ) -> dict[int, str]:
        """Write rows into the folders of their buckets; the folder of each bucket.

        Every task writes a file into each bucket it has rows of, so rows are not
        shuffled by bucket, and a bucket that one key has grown is in no single task.
        ``gather`` puts the few rows of a merge together first, for few files;
        rebalancing splits a bucket that one key has grown.
        Row groups share ``WRITE_BYTES`` of a task's memory.
        """
        data = f"{DATA}-{self._next(name)}"
        dealt = df.withColumn("bucket", self._bucket(F.col(key), buckets))
        if gather:
            dealt = dealt.hint("rebalance", F.col("bucket"))
        writer = dealt.write.partitionBy("bucket").option("compression", "zstd")
        group = max(1 << 20, WRITE_BYTES // buckets)
        writer.option("parquet.block.size", group).parquet(f"{self.root}/{name}/{data}")
        names = [s.getPath().getName() for s in self._folders(f"{self.root}/{name}/{data}")]
        return {
            int(n.split("=")[1]): f"{data}/{n}" for n in names if n.startswith("bucket=")
        }

    def _commit(
        self, name: str, folders: dict[int, list[str]], schema: StructType, buckets: int, label: str
    ) -> DataFrame:
        rows = [(NO_BUCKET, buckets, "", label, schema.json())]
        rows += [(b, buckets, f, label, None) for b, listed in sorted(folders.items()) for f in listed]
        listed = self.spark.createDataFrame(rows, LIST_SCHEMA).coalesce(1)
        listed.write.parquet(f"{self.root}/{name}/{LIST}-{self._next(name)}")
        return self.read(name)

    def deal(self, name: str, df: DataFrame, key: str, label: str = "") -> DataFrame:
        """Write a new version of all rows, dealt by ``key`` (nested names too)."""
        folders = {b: [f] for b, f in self._write_buckets(name, df, key, self.buckets).items()}
        return self._commit(name, folders, df.schema, self.buckets, label)

    def merge(
        self, name: str, delta: DataFrame, key: str, replaced: DataFrame | None = None, label: str = ""
    ) -> DataFrame:
        """The next version: stored rows whose ``key`` is not in ``replaced``, and ``delta``.

        Only buckets of replaced keys are read and rewritten; rows for other buckets
        are put into one more folder of theirs. ``replaced`` has one column; None stands
        for the keys of ``delta``.
        """
        if not self._current(name)[0].startswith(LIST):
            raise ValueError(f"{name} is not dealt into buckets")
        listed = self._listed(name)
        buckets = listed[0]["buckets"]
        folders: dict[int, list[str]] = {}
        for r in listed:
            if r["bucket"] != NO_BUCKET:
                folders.setdefault(r["bucket"], []).append(r["folder"])
        keys = delta.select(F.col(key).alias("k")) if replaced is None else replaced.toDF("k")
        numbers = lambda df, k: {
            r["b"] for r in df.select(self._bucket(F.col(k), buckets).alias("b")).distinct().collect()
        }  # at most ``buckets`` rows
        given, rewritten = numbers(delta, key), numbers(keys, "k")
        rewritten |= {b for b in given if len(folders.get(b, ())) >= FOLDERS}
        if not given and not rewritten & folders.keys():
            return self.read(name)
        old = [r for r in listed if r["bucket"] in rewritten | {NO_BUCKET}]
        rows = delta
        if len(old) > 1:
            stored = self._read_buckets(name, old).withColumn("_key", F.col(key))
            rows = stored.join(keys.distinct().toDF("_key"), "_key", "left_anti").drop("_key").unionByName(delta)
        written = self._write_buckets(name, rows, key, buckets, gather=True)
        for b in rewritten:
            folders.pop(b, None)
        for b, folder in written.items():
            folders.setdefault(b, []).append(folder)
        return self._commit(name, folders, delta.schema, buckets, label)

    def label(self, name: str) -> str | None:
        """The label of the newest list."""
        return next((r["label"] for r in self._listed(name)), None) if self.exists(name) else None

    # ---------------------------------------------------------------- old versions

    def remove_old(self, name: str, keep: int = 1) -> list[str]:
        """Delete what only versions before the newest ``keep`` use; the paths removed.

        Readers of an older version lose its files, so this is asked for, never done
        by a load. Folders that a kept list names stay, as do unfinished ones newer
        than every committed version.
        """
        versions = self._versions(name)
        starts = [i for i, v in enumerate(versions) if not v.startswith(DELTA)]
        if len(starts) <= max(1, keep):
            return []
        kept = versions[starts[-max(1, keep)] :]
        used = set(kept)
        for v in kept:
            if v.startswith(LIST):
                rows = self.spark.read.schema(LIST_SCHEMA).parquet(f"{self.root}/{name}/{v}").collect()
                used |= {r["folder"].split("/")[0] for r in rows}
        newest = int(versions[-1].split("-")[1])
        jvm = self.spark.sparkContext._jvm
        removed = []
        for v in self._versions(name, (FULL, DELTA, LIST, DATA), committed=False):
            if v not in used and int(v.split("-")[1]) < newest:
                path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/{v}")
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
                removed.append(v)
        return removed
