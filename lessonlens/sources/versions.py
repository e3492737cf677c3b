"""Versioned tables: keyed replacement that rewrites only what it touches, switched in one step.

A version is a Parquet table over folders that are written once and never changed.  A keyed
table is laid out by a hash of its key (``bucket``, a partition column that readers do not see).
A replacement writes the touched buckets into a new folder and makes a new version whose
other buckets are the former version's folders; nothing of them is read or copied.  The name that
readers use is a view on the current version: redefining it is one catalogue operation, so a
reader finds the former version or the new one, never none.  Folders of a version stay for
readers that have begun with it until ``vacuum`` drops versions beyond those to keep.

A write that stops on its way leaves the view where it was; what it wrote is a version that
no view names, which ``vacuum`` removes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lessonlens.session import ensure_checkpoint_dir
from lessonlens.sources.sinks import table_exists

BUCKET = "bucket"


class VersionedTable:
    """``name``: the view that readers use.  ``key``: the column whose hash lays out the table (None: one
    folder for each version).  ``buckets``: their number; about the table's size over 128 MB, and at
    least some hundreds where few keys are replaced at a time.  ``root``: a shared folder
    (default: beside the checkpoints).  An existing table keeps the key and number it was made with."""

    def __init__(self, spark: SparkSession, name: str, key: str | None = None, buckets: int = 64,
                 root: str | None = None):
        self.spark, self.name = spark, name
        made = self._properties()
        self.key = made.get("key", key) or None
        self.buckets = int(made.get("buckets", buckets if key else 1))
        self.root = made.get("root") or f"{root or ensure_checkpoint_dir(spark).rstrip('/') + '/tables'}/{name}"

    # -- what is there ---------------------------------------------------------------
    def exists(self) -> bool:
        return table_exists(self.spark, self.name)

    def _properties(self) -> dict[str, str]:
        if not self.exists():
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        return {r[0].removeprefix("lessonlens."): r[1] for r in rows if r[0].startswith("lessonlens.")}

    def version(self) -> int:
        """Number of the current version, 0 before the first."""
        return int(self._properties().get("version", 0))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def rows(self, buckets: list[int]) -> DataFrame:
        """The rows of some buckets; the partition filter keeps the scan to their folders."""
        return (self.spark.table(self._properties()["table"]).where(F.col(BUCKET).isin(buckets))
                .select(*self.table().columns))

    def locations(self) -> dict[int | None, str]:
        """Folder of each bucket with rows in the current version (None: of the whole table)."""
        return self._locations(self._properties()["table"]) if self.exists() else {}

    def _locations(self, table: str) -> dict[int | None, str]:
        folders = {f.rsplit("/", 1)[0] for f in self.spark.table(table).inputFiles()}     # listed, not read
        return {int(at.rsplit(f"/{BUCKET}=", 1)[1]) if self.key else None: at for at in folders}

    def bucket(self, column: str | None = None) -> F.Column:
        return F.pmod(F.hash(F.col(column or self.key)), F.lit(self.buckets))

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets (a bounded number) of the key column of ``keys``."""
        return sorted(r[0] for r in keys.select(self.bucket().alias(BUCKET)).distinct().collect())

    # -- writing ---------------------------------------------------------------------
    def publish(self, df: DataFrame, allow_empty: bool = True) -> bool:
        """A whole new version; with ``allow_empty=False`` an empty result leaves the table as it is."""
        base = self.version()
        folder, written = self._write(df)
        if not allow_empty and self.spark.read.schema(df.schema).parquet(folder).isEmpty():
            self._remove(folder)
            return False
        self._switch(df, written, base)
        return True

    def replace(self, scope: DataFrame, fresh: DataFrame, by: str | None = None, also: str | None = None) -> list[int]:
        """Keyed replacement: all rows whose ``by`` (default: the key) is in ``scope`` go, also where
        ``fresh`` has none for it, and the rows of ``fresh`` come.  ``also``: rows whose value in this
        column appears in ``fresh`` go too.  Returns the buckets that were rewritten.

        The keys of ``fresh`` must be in ``scope``, if both go by the key.  ``scope`` is read more than
        once and should be stored; ``fresh`` is computed once."""
        by = by or self.key
        base = self.version()
        columns = self.table().columns
        if by == self.key and also in (None, self.key):
            buckets = self.touched(scope)
            fresh = fresh.select(*columns)
            staged = None
        else:                       # the fresh rows' own buckets are known once they are written
            staged = f"{self.root}/staged-{uuid.uuid4().hex}"
            fresh.select(*columns).write.parquet(staged)
            fresh = self.spark.read.schema(self.table().schema).parquet(staged)
            leaving = self.table().join(scope.select(by).distinct(), by, "left_semi")
            buckets = self.touched(fresh.select(self.key).unionByName(leaving.select(self.key)))
        if buckets:
            kept = self.rows(buckets).join(scope.select(by).distinct(), by, "left_anti")
            if also is not None and also != by:
                kept = kept.join(fresh.select(also).distinct(), also, "left_anti")
            folder, written = self._write(kept.unionByName(fresh))
            if not set(written) <= set(buckets):
                self._remove(folder)
                raise ValueError("fresh holds keys that are not in scope")
            stay = {b: at for b, at in self.locations().items() if b not in set(buckets)}
            self._switch(self.table(), stay | written, base)
        if staged:
            self._remove(staged)
        return buckets

    def _write(self, df: DataFrame) -> tuple[str, dict[int | None, str]]:
        """``df`` in a new folder; the folder and where each bucket of it lies."""
        folder = f"{self.root}/{uuid.uuid4().hex}"
        if self.key is None:
            df.write.parquet(folder)
            return folder, {None: folder}
        # large buckets may be split over files, small ones share a task
        laid = df.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)
        laid.write.partitionBy(BUCKET).parquet(folder)
        fs, path = self._files(folder)
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        found = [int(n.split("=")[1]) for n in names if n.startswith(BUCKET + "=")]
        return folder, {b: f"{folder}/{BUCKET}={b}" for b in found}

    def _switch(self, like: DataFrame, places: dict[int | None, str], base: int) -> None:
        """Makes the version that lies at ``places`` and then names it in the view."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
        table = f"{self.name}__v{base + 1}_{uuid.uuid4().hex[:12]}"
        if self.key is None:
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{places[None]}'")
        else:
            self.spark.sql(f"CREATE TABLE {table} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                           f"LOCATION '{self.root}/empty'")
            if places:
                parts = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{at}'" for b, at in sorted(places.items()))
                self.spark.sql(f"ALTER TABLE {table} ADD {parts}")
        if self.version() != base:
            self.spark.sql(f"DROP TABLE {table}")
            raise RuntimeError(f"{self.name} was replaced meanwhile: version {self.version()}, read {base}")
        said = {"version": base + 1, "table": table, "key": self.key or "", "buckets": self.buckets, "root": self.root}
        properties = ", ".join(f"'lessonlens.{k}'='{v}'" for k, v in said.items())
        names = ", ".join(f"`{c}`" for c in like.columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ({properties}) AS SELECT {names} FROM {table}")

    # -- clearing up ------------------------------------------------------------------
    def vacuum(self, keep: int = 2) -> int:
        """Drops all versions but the ``keep`` latest (and any that no view ever named) with the folders
        that only they use; returns the number of versions dropped.  Not while a write is under way."""
        current = self._properties()
        if not current:
            return 0
        prefix = f"{self.name.split('.')[-1]}__v"
        tables = [t.name for t in self.spark.catalog.listTables() if t.name.startswith(prefix)]
        number = {t: int(t.removeprefix(prefix).split("_")[0]) for t in tables}
        newest = current["table"].split(".")[-1]
        live = [t for t in tables if number[t] < int(current["version"])] + [newest]
        live = sorted(live, key=number.__getitem__)[-keep:]
        used = {self._files(at)[1].toUri().getPath() for t in live for at in self._locations(t).values()}
        gone = [t for t in tables if t not in live]
        for t in gone:
            self.spark.sql(f"DROP TABLE {t}")
        fs, root = self._files(self.root)
        for status in fs.listStatus(root) if fs.exists(root) else []:
            at = status.getPath().toUri().getPath()
            if not any(u == at or u.startswith(at + "/") for u in used):
                fs.delete(status.getPath(), True)
        return len(gone)

    def drop(self) -> None:
        """The view, its versions and their files."""
        prefix = f"{self.name.split('.')[-1]}__v"
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        for t in [t.name for t in self.spark.catalog.listTables() if t.name.startswith(prefix)]:
            self.spark.sql(f"DROP TABLE {t}")
        self._remove(self.root)

    def _files(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _remove(self, folder: str) -> None:
        fs, path = self._files(folder)
        fs.delete(path, True)
