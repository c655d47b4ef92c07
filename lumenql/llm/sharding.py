"""Immutable shards under a versioned manifest, with size-tiered compaction.

Arrivals are appended as runs of small Parquet files that never change. Runs of similar
size form a tier; when a tier holds ``fanout`` runs they are merged into one run of files
of about ``target_bytes``. Every append and every merge commits a new manifest: a draft
is renamed to the next version's name, and the rename fails where that name is taken, so
readers always see one whole state and of two writers one fails. An append that fails so
is tried again on the newer version; a merge is given up. Replaced files stay until
``vacuum``.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import scratch


@dataclass(frozen=True)
class Run:
    """Files that were committed together, and the merges in a row that made them (0: an arrival)."""

    path: str
    bytes: int
    files: int
    merges: int = 0


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


class ShardStore:
    """A table of shards in a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str, *, target_bytes: int = 512 << 20, fanout: int = 4, base_bytes: int = 1 << 20):
        self.spark, self.root = spark, root.rstrip("/")
        self.target_bytes, self.fanout, self.base_bytes = target_bytes, fanout, base_bytes
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def version(self) -> int:
        """The newest committed version; 0 is the empty table."""
        folder = self._path("manifests")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)

    def _load(self, version: int | None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"runs": [], "schema": None}
        stream = self._fs.open(self._path(f"manifests/v{version:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def manifest(self, version: int | None = None) -> list[Run]:
        return [Run(**r) for r in self._load(version)["runs"]]

    def schema(self, version: int | None = None) -> StructType | None:
        """The table's columns as of a version; None before anything was committed."""
        told = self._load(version)["schema"]
        return told and StructType.fromJson(told)

    def commit(self, base: int, runs: list[Run], schema: StructType | None = None) -> int:
        """Publish ``runs`` as the version after ``base``; raises ``CommitConflict`` if that exists."""
        final = self._path(f"manifests/v{base + 1:012d}.json")
        draft = self._path(f"manifests/.{uuid.uuid4().hex}.tmp")
        schema = schema or self.schema(base)
        self._fs.mkdirs(final.getParent())
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps({"version": base + 1, "schema": schema and schema.jsonValue(), "runs": [asdict(r) for r in runs]}).encode()))
        stream.close()
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration()) if final.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, final, none)  # fails where the name is taken
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise CommitConflict(f"version {base + 1} exists") from e
            raise
        return base + 1

    def _measure(self, name: str, merges: int = 0) -> Run:
        found = [s for s in self._fs.listStatus(self._path(name)) if s.getPath().getName().endswith(".parquet")]
        return Run(name, sum(s.getLen() for s in found), len(found), merges)

    def _publish(self, run: Run, schema: StructType) -> int:
        """Commit an appended run on whatever version is newest."""
        while True:
            base = self.version()
            known = self.schema(base)
            if known is not None and [(f.name, f.dataType) for f in known] != [(f.name, f.dataType) for f in schema]:
                raise ValueError(f"the store's columns are {known.simpleString()}")
            try:
                return self.commit(base, [*self.manifest(base), run], schema)
            except CommitConflict:
                continue  # another writer was first; its version is the base now

    def append(self, arrivals: DataFrame) -> int:
        """Commit a table as one run of small shards. A table without rows is a run too, and tells the columns."""
        name = f"runs/{uuid.uuid4().hex}"
        arrivals.write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        return self._publish(self._measure(name), arrivals.schema)

    def append_batches(self, arrivals: DataFrame, batch: str, compact: bool = False) -> int:
        """Write all batches in one pass, then commit them in order, each as a run and a version.

        ``batch`` is an integer column that numbers the arrivals; it is stored in the rows too,
        and rows without a number arrive first. With ``compact``, due tiers are merged after
        each arrival. A table without rows commits one empty run.
        """
        name, folder = f"runs/{uuid.uuid4().hex}", "arrival"
        while folder in (c.lower() for c in arrivals.columns):
            folder += "_"
        arrivals.withColumn(folder, F.coalesce(F.col(batch), F.lit(-1))).write.partitionBy(folder).option("compression", "zstd").parquet(f"{self.root}/{name}")
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(name)) if s.isDirectory()]
        found = sorted((f for f in found if f.startswith(f"{folder}=")), key=lambda f: int(f.partition("=")[2]))
        for f in found:
            self._publish(self._measure(f"{name}/{f}"), arrivals.schema)
            if compact:
                self.compact()
        return self.version() if found else self._publish(Run(name, 0, 0), arrivals.schema)

    def tier(self, run: Run) -> int:
        """Tier of a run: the power of ``fanout`` that its size reaches over ``base_bytes``."""
        return max(0, math.floor(math.log(max(run.bytes, 1) / self.base_bytes, self.fanout)) + 1) if run.bytes > self.base_bytes else 0

    def due(self, runs: list[Run]) -> list[Run]:
        """The runs of the lowest tier that holds ``fanout`` or more; a run of full files is done."""
        tiers: dict[int, list[Run]] = {}
        for run in runs:
            if run.files and run.bytes < self.target_bytes * run.files:
                tiers.setdefault(self.tier(run), []).append(run)
        return next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= self.fanout), [])

    def compact_once(self) -> bool:
        """Merge one tier into files of the target size; False if no tier is due.

        The scan itself packs whole small files into tasks of ``target_bytes``, so nothing
        is shuffled, and each task writes one file.
        """
        base = self.version()
        runs = self.manifest(base)
        merging = self.due(runs)
        if not merging:
            return False
        session = self.spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", str(self.target_bytes))
        session.conf.set("spark.sql.files.openCostInBytes", "0")
        session.conf.set("spark.sql.files.minPartitionNum", "1")
        name = f"runs/{uuid.uuid4().hex}"
        session.read.schema(self.schema(base)).parquet(*(f"{self.root}/{r.path}" for r in merging)).write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        gone = {r.path for r in merging}
        self.commit(base, [*(r for r in runs if r.path not in gone), self._measure(name, 1 + max(r.merges for r in merging))])
        return True

    def compact(self) -> int:
        """Merge until no tier is due; returns the number of merges."""
        merges = 0
        while self.compact_once():
            merges += 1
        return merges

    def vacuum(self) -> None:
        """Delete run folders that the newest version does not name, and older manifests. Older readers fail then."""
        live = {r.path for r in self.manifest()}
        newest = f"v{self.version():012d}.json"
        for status in self._fs.listStatus(self._path("runs")):
            name = f"runs/{status.getPath().getName()}"
            if name in live:
                continue
            inside = [f"{name}/{s.getPath().getName()}" for s in self._fs.listStatus(status.getPath()) if s.isDirectory()]
            if not live & set(inside):
                self._fs.delete(status.getPath(), True)
            else:
                for folder in set(inside) - live:
                    self._fs.delete(self._path(folder), True)
        for status in self._fs.listStatus(self._path("manifests")):
            if status.getPath().getName() != newest:
                self._fs.delete(status.getPath(), False)

    def read(self, version: int | None = None, shard: str | None = "shard", merges: str | None = None) -> DataFrame:
        """The rows of a committed version. A store without any version raises.

        ``shard`` and ``merges`` name columns for the file that holds a row and for its run's
        merges; None leaves one out, and a name that the table has itself raises.
        """
        schema, runs = self.schema(version), [r for r in self.manifest(version) if r.files]
        if schema is None:
            raise ValueError("the store has no version yet")
        told = [c for c in (shard, merges) if c]
        if clash := {c.lower() for c in told} & {c.lower() for c in schema.names}:
            raise ValueError(f"the table has columns of these names: {', '.join(sorted(clash))}")
        out = None
        for n in sorted({r.merges for r in runs}):
            part = self.spark.read.schema(schema).parquet(*(f"{self.root}/{r.path}" for r in runs if r.merges == n))
            if shard:
                part = part.withColumn(shard, F.input_file_name())
            if merges:
                part = part.withColumn(merges, F.lit(n))
            out = part if out is None else out.union(part)
        if out is None:
            out = self.spark.createDataFrame([], schema).withColumns({c: F.lit(None).cast("int" if c == merges else "string") for c in told})
        return out


def shard_table(table: DataFrame, batch: str, root: str | None = None, **options) -> ShardStore:
    """Append a table's batches as arrivals, and merge what is due after each.

    Nulls, empty and very long values, repeated rows and all columns are stored as they
    are; rows without a batch number arrive first. An empty table is one empty version.
    """
    store = ShardStore(table.sparkSession, root or scratch(table.sparkSession, "shards"), **options)
    store.append_batches(table, batch, compact=True)
    return store
