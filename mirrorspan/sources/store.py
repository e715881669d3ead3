"""Versioned parquet tables: stage, verify, switch.

A table is a folder of immutable ``vN-id`` folders. A small JSON file per
version lists the folders that make up the table and how they are partitioned, so

* a failed or half-finished write is never seen by readers,
* a version may reuse partitions of older ones, so replacing a three-day
  window of a huge table writes three days, not the table,
* nothing is ever overwritten while it is being read.

A write names the version it started from; if another one was written
meanwhile it fails instead of dropping that one's rows. The switch is a rename
that must not replace a file: HDFS and local file systems give that, plain
object stores don't, so there one writer per table has to be arranged.

Folder names never become columns: a partition's value is taken from the
manifest or, per row, from the file's path.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from mirrorspan.functions.types import all_nullable
from mirrorspan.operators.joins import KeySet
from mirrorspan.sources import skipping

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_VERSION_DIR = re.compile(r"v\d+-[0-9a-f]+")
# Versions whose folders are read as one scan each; a table of more is read as one, and
# each row's path says where it lies.
MOST_SCANS = 32


class VerificationError(RuntimeError):
    """The staged files do not hold the rows that were sent to them."""


class StaleVersionError(RuntimeError):
    """Another writer changed the table since this write began."""


@dataclass(frozen=True)
class Snapshot:
    """One version: its schema and (partition value, folder) pairs."""

    version: int
    schema: T.StructType
    partition_by: str | None
    dirs: tuple[tuple[str | None, str], ...]
    batches: dict[str, int]
    spec: dict | None = None
    index: tuple[str, ...] = ()  # key columns of the skipping index

    @property
    def partitions(self) -> list[str]:
        return sorted({v for v, _ in self.dirs if v is not None})


@dataclass(frozen=True)
class Changes:
    """Rows of the folders that differ between two versions of a table."""

    removed: DataFrame
    added: DataFrame
    partitions: frozenset[str]
    whole: bool  # a version has no partitions


class TableStore:
    """Tables under one root folder of a Hadoop-compatible file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- reading ---------------------------------------------------------

    def tables(self) -> list[str]:
        return sorted(n for n in self._children(self.root) if self.exists(n))

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def snapshot(self, table: str, version: int | None = None) -> Snapshot:
        """The current version, or an older one that is still there."""
        versions = self._versions(table)
        if not versions or (version is not None and version not in versions):
            raise FileNotFoundError(f"no table {table!r} (version {version}) under {self.root}")
        chosen = versions[-1] if version is None else version
        raw = json.loads(self._read_text(f"{self.root}/{table}/_versions/{chosen:010d}.json"))
        return Snapshot(
            raw["version"],
            T.StructType.fromJson(raw["schema"]),
            raw["partition_by"],
            tuple((v, d) for v, d in raw["dirs"]),
            raw["batches"],
            raw.get("spec"),
            tuple(raw.get("index") or ()),
        )

    def applied_batch(self, table: str, stream: str) -> int:
        """Last micro-batch of ``stream`` in the table; -1 if there is none."""
        return self.snapshot(table).batches.get(stream, -1) if self.exists(table) else -1

    def read(
        self,
        table: str,
        only: Callable[[str], bool] | None = None,
        keep_partition: bool = False,
        version: int | None = None,
    ) -> DataFrame:
        """A version's rows; ``only`` picks partitions before any listing."""
        snap = self.snapshot(table, version)
        dirs = [d for v, d in snap.dirs if only is None or v is None or only(v)]
        part = snap.partition_by if keep_partition else None
        versions = {d.split("/")[0] for d in dirs}
        if part and dirs and len(versions) <= MOST_SCANS and all(v is not None for v, _ in snap.dirs):
            frames = [
                self._read_parts(f"{self.root}/{table}/{v}", snap.schema, part,
                                 [d for d in dirs if d.startswith(f"{v}/")])
                for v in sorted(versions)
            ]
            return reduce(DataFrame.unionByName, frames)
        if not dirs:
            fields = [T.StructField(part, T.StringType())] if part else []
            return self.spark.createDataFrame([], T.StructType(snap.schema.fields + fields))
        df = self._read_dirs(table, dirs, snap.schema)
        names = [F.col(f"`{n}`") for n in snap.schema.names]
        return df.select(*names, *([_partition_value(part).alias(part)] if part else []))

    def changes(self, table: str, since: int) -> Changes:
        """What replaced folders held before and what they hold now, and which they are.

        Folders that both versions have in common are not read.
        """
        old, new = self.snapshot(table, since), self.snapshot(table)
        gone = [d for d in old.dirs if d not in set(new.dirs)]
        come = [d for d in new.dirs if d not in set(old.dirs)]
        return Changes(
            self._read_dirs(table, [d for _, d in gone], old.schema),
            self._read_dirs(table, [d for _, d in come], new.schema),
            frozenset(v for v, _ in (*gone, *come) if v is not None),
            old.partition_by is None or new.partition_by is None,
        )

    def _read_dirs(self, table: str, dirs: Sequence[str], schema: T.StructType) -> DataFrame:
        if not dirs:
            return self.spark.createDataFrame([], schema)
        # Each folder is its own base path, so that none of its name is data.
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/{d}" for d in dirs])

    def _read_parts(
        self, base: str, schema: T.StructType, part: str, dirs: Sequence[str] = ()
    ) -> DataFrame:
        """Rows of folders of one version, with the folder's value as ``part``. Spark takes
        it from the folder once a file; by :func:`_partition_value` each row would pay for it."""
        wide = T.StructType([*schema.fields, T.StructField(part, T.StringType())])
        reader = self.spark.read.schema(wide).option("basePath", base)
        df = reader.parquet(*([f"{base}/{d.split('/', 1)[1]}" for d in dirs] or [base]))
        return df.select(*(F.col(f"`{n}`") for n in wide.names))

    def parts_with_keys(
        self, table: str, keys: KeySet, columns: Sequence[str], version: int | None = None
    ) -> set[str] | None:
        """Partitions that may hold one of the keys, by the skipping index alone.

        None if the table has no index of these columns: then any may. Folders that were
        written before there was an index always may.
        """
        snap = self.snapshot(table, version)
        if list(snap.index) != list(columns) or snap.partition_by is None:
            return None
        base = f"{self.root}/{table}"
        versions = {d.split("/")[0] for _, d in snap.dirs}
        known = {
            v for v in versions if skipping.FOLDER in self._children(f"{base}/{v}")
        }
        may = {v for v, d in snap.dirs if d.split("/")[0] not in known}
        if known:
            index = self.spark.read.parquet(*[f"{base}/{v}/{skipping.FOLDER}" for v in sorted(known)])
            types = [snap.schema[c].dataType for c in columns]
            found = {NULL_PARTITION if v is None else v for v in skipping.parts(index, keys, types)}
            # Partitions of older versions that have been replaced since are still in there.
            may |= found & set(snap.partitions)
        return may

    # -- writing ---------------------------------------------------------

    def overwrite(
        self,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
        expect_rows: int | None = None,
        batch: dict[str, int] | None = None,
        spec: dict | None = None,
        index: Sequence[str] = (),
    ) -> int:
        """Replace the table; returns the rows written.

        ``partition_by`` is a text column of ``df`` that only forms folders;
        it is not part of the table's own schema. ``spec`` says how its values
        were made and is kept with the version and those that follow. ``index`` names
        key columns whose values are summed up for each folder (``sources.skipping``),
        in this version and those that follow.
        """
        base = self._latest(table)
        dirs, rows = self._stage(table, df, partition_by, cluster_by, expect_rows, index)
        schema = self._payload(df, partition_by)
        self._commit(table, schema, partition_by, dirs, base, spec, batch, index)
        return rows

    def append(
        self,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        batch: dict[str, int] | None = None,
        cluster_by: Sequence[str] = (),
        spec: dict | None = None,
        index: Sequence[str] = (),
    ) -> int:
        """Add rows, creating the table when absent. Types must already agree
        with the table (see ``operators.evolve``). ``batch`` maps
        the stream the rows come from to its micro-batch."""
        if not self.exists(table):
            return self.overwrite(
                table, df, partition_by, cluster_by, batch=batch, spec=spec, index=index
            )
        snap = self.snapshot(table)
        dirs, rows = self._stage(table, df, snap.partition_by, cluster_by, index=snap.index)
        schema = self._payload(df, snap.partition_by)
        dirs = [*snap.dirs, *dirs]
        self._commit(
            table, schema, snap.partition_by, dirs, snap.version, snap.spec, batch, snap.index
        )
        return rows

    def replace(
        self,
        table: str,
        frames: Sequence[DataFrame],
        replaced: Callable[[str], bool] | None = None,
        batch: dict[str, int] | None = None,
        cluster_by: Sequence[str] = (),
    ) -> list[int]:
        """Put the rows of ``frames`` in place of the chosen partitions.

        Without ``replaced`` the whole table is exchanged. Partitions left
        without rows disappear; folders of all others are carried over
        untouched. The frames become one version; returns the rows of each.
        """
        snap = self.snapshot(table)
        dirs = [] if replaced is None else [(v, d) for v, d in snap.dirs if not replaced(v)]
        counts = []
        for df in frames:
            staged, rows = self._stage(table, df, snap.partition_by, cluster_by, index=snap.index)
            dirs += staged
            counts.append(rows)
        schema = self._payload(frames[-1], snap.partition_by)
        self._commit(
            table, schema, snap.partition_by, dirs, snap.version, snap.spec, batch, snap.index
        )
        return counts

    def rebuild(self, table: str) -> tuple[int, int]:
        """Write the table anew with every column nullable; (rows before, after).

        The new version becomes current only if both counts agree.
        """
        snap = self.snapshot(table)
        df = self.read(table, keep_partition=True)
        before = df.count()
        after = self.overwrite(
            table, df, snap.partition_by, expect_rows=before, spec=snap.spec, index=snap.index
        )
        return before, after

    def rebuild_all(self, tables: Sequence[str] | None = None) -> list[tuple]:
        """(table, rows before, rows after, error) of every rebuild; one that fails
        keeps its version and doesn't stop the others."""
        out = []
        for table in self.tables() if tables is None else tables:
            try:
                out.append((table, *self.rebuild(table), None))
            except Exception as exc:
                out.append((table, None, None, f"{type(exc).__name__}: {exc}"))
        return out

    def compact(self, table: str) -> int:
        """Writes partitions that many appends have scattered anew, each into one
        folder; returns how many folders that saves."""
        snap = self.snapshot(table)
        counts = Counter(v for v, _ in snap.dirs)
        many = {v for v, n in counts.items() if n > 1}
        if not many:
            return 0
        chosen = many.__contains__
        whole = snap.partition_by is None
        df = self.read(table, None if whole else chosen, keep_partition=not whole)
        self.replace(table, [df], None if whole else chosen)
        return len(snap.dirs) - len(self.snapshot(table).dirs)

    def truncate(self, table: str) -> None:
        """No rows, same schema."""
        snap = self.snapshot(table)
        self._commit(
            table, snap.schema, snap.partition_by, [], snap.version, snap.spec, index=snap.index
        )

    def drop_partitions(self, table: str, dropped: Callable[[str], bool]) -> int:
        """Forget partitions (retention) without reading or writing data."""
        snap = self.snapshot(table)
        kept = [(v, d) for v, d in snap.dirs if v is None or not dropped(v)]
        if len(kept) < len(snap.dirs):
            self._commit(
                table, snap.schema, snap.partition_by, kept, snap.version, snap.spec,
                index=snap.index,
            )
        return len(snap.dirs) - len(kept)

    def drop_old_versions(self, table: str, keep: int = 2) -> int:
        """Delete folders that none of the last ``keep`` versions uses."""
        versions = self._versions(table)
        used = set()
        for v in versions[-keep:]:
            raw = json.loads(self._read_text(f"{self.root}/{table}/_versions/{v:010d}.json"))
            used |= {d.split("/")[0] for _, d in raw["dirs"]}
        removed = 0
        for name in self._children(f"{self.root}/{table}"):
            if _VERSION_DIR.fullmatch(name) and name not in used:
                fs, path = self._fs(f"{self.root}/{table}/{name}")
                fs.delete(path, True)
                removed += 1
        for v in versions[:-keep]:
            fs, path = self._fs(f"{self.root}/{table}/_versions/{v:010d}.json")
            fs.delete(path, False)
        return removed

    # -- internals -------------------------------------------------------

    def _stage(self, table, df, partition_by, cluster_by=(), expect_rows=None, index=()):
        if partition_by and [c.lower() for c in df.columns].count(partition_by.lower()) > 1:
            raise ValueError(f"{table}: {partition_by} is a column of the table itself")
        name = f"v{(self._latest(table) or 0) + 1}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{table}/{name}"
        out = df
        if partition_by:
            # Rebalancing gathers a day into few files and still splits a day
            # that holds a large share of the rows over many tasks.
            out = out.hint("rebalance", F.col(partition_by))
        if cluster_by:
            order = [partition_by] if partition_by else []
            out = out.sortWithinPartitions(*order, *cluster_by)
        sent = Observation()
        writer = out.observe(sent, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        rows = sent.get.get("rows", 0)
        found = sorted(c for c in self._children(path) if "=" in c) if partition_by else []
        staged = 0
        if found or not partition_by:
            # A count without columns is answered from the file footers.
            staged = self.spark.read.schema(self._payload(df, partition_by)).parquet(path).count()
        wanted = rows if expect_rows is None else expect_rows
        if staged != rows or staged != wanted:
            raise VerificationError(f"{table}: staged {staged} rows, sent {rows}, expected {wanted}")
        if index and rows:
            payload = self._payload(df, partition_by)
            if partition_by:
                stored = self._read_parts(path, payload, partition_by)
                folder = F.col(f"`{partition_by}`")
            else:
                stored = self.spark.read.schema(payload).parquet(path)
                folder = F.lit(None).cast("string")
            keys = stored.select(folder.alias(skipping.PART), *(F.col(f"`{c}`") for c in index))
            skipping.build(keys, index).write.parquet(f"{path}/{skipping.FOLDER}")
        if not partition_by:
            return [(None, name)], rows
        return [(_unescaped(c.split("=", 1)[1]), f"{name}/{c}") for c in found], rows

    @staticmethod
    def _payload(df: DataFrame, partition_by: str | None) -> T.StructType:
        return T.StructType([f for f in df.schema.fields if f.name != partition_by])

    def _latest(self, table: str) -> int | None:
        versions = self._versions(table)
        return versions[-1] if versions else None

    def _commit(
        self, table, schema, partition_by, dirs, base, spec, batch=None, index=()
    ) -> None:
        """Switch to ``dirs``, unless ``base`` is no longer the current version."""
        if self._latest(table) != base:
            raise StaleVersionError(f"{table} was written by someone else after version {base}")
        version = (base or 0) + 1
        batches = dict(self.snapshot(table).batches) if base else {}
        batches.update(batch or {})
        body = json.dumps(
            {
                "version": version,
                "schema": all_nullable(schema).jsonValue(),
                "partition_by": partition_by,
                "dirs": [list(d) for d in dirs],
                "batches": batches,
                "spec": spec,
                "index": list(index),
            }
        )
        folder = f"{self.root}/{table}/_versions"
        fs, draft = self._fs(f"{folder}/.{version:010d}-{uuid.uuid4().hex[:8]}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(body, "utf-8"))
        finally:
            stream.close()
        _, final = self._fs(f"{folder}/{version:010d}.json")
        if fs.exists(final) or not fs.rename(draft, final):
            raise StaleVersionError(f"version {version} of {table} was written by someone else")

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _versions(self, table: str) -> list[int]:
        names = self._children(f"{self.root}/{table}/_versions")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read_text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _unescaped(value: str) -> str:
    return value if value == NULL_PARTITION else unquote(value)


def _partition_value(column: str) -> Column:
    """The value of the partition folder that a row's file lies in."""
    found = F.regexp_extract(F.col("_metadata.file_path"), f"/{re.escape(column)}=([^/]+)/[^/]+$", 1)
    # A file address escapes what the folder name had escaped; "+" stands for itself.
    return F.when(found != NULL_PARTITION, _decoded(_decoded(found)))


def _decoded(address: Column) -> Column:
    return F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B")))
