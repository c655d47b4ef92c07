"""Helpers that the operators share: shared storage, materialised tables, text rules."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..storage import discard, shared_dir  # noqa: F401  used by the operators

#: ASCII white space, as regular-expression class content (space, tab to carriage return).
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Paths that ``scratch`` gave out inside the innermost ``scratch_scope``.
_scopes: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends or, earlier, by ``scratch_scope``."""
    path = storage.scratch(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete what operators keep in the shared folder within the block, when it ends.

    For a caller who writes the result inside the block; a lazy result must not outlive it.
    The value of the block is a function that excepts a path.
    """
    _scopes.append([])
    try:
        yield _scopes[-1].remove
    finally:
        for path in _scopes.pop():
            discard(spark, path)


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage, survives the loss of any executor, and gives later joins
    true sizes. Returns the table and its path, which ``discard`` removes.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


#: Rows of a file of a few narrow columns, and of one with texts.
FILE_ROWS, TEXT_ROWS = 1 << 18, 1 << 12


def in_few(df: DataFrame, rows: int, each: int = 1, file_rows: int = FILE_ROWS) -> DataFrame:
    """``df`` in about as many partitions as ``rows`` rows need, and at least ``each`` for every core.

    For what is written next: every file costs a commit, and on a local file system the
    executor starts a process for it. A small table may come in as many partitions as a
    shuffle has.
    """
    return df.coalesce(max(each * df.sparkSession.sparkContext.defaultParallelism, -(-rows // file_rows)))


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text; null counts as empty. Together they name it."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole), F.xxhash64(F.lit(7), whole)]


def released(use):
    """``use`` for ``mapInArrow``, with Arrow's unused memory handed back at its end.

    Arrow keeps what it frees, so a worker that waits for its next task would go on holding
    its largest batches, while the executor needs the memory.
    """

    def run(batches):
        yield from use(batches)
        pa.default_memory_pool().release_unused()

    return run


def in_groups(df: DataFrame, keys: list[str], use, schema: str, order: Column | None = None, together: bool = False) -> DataFrame:
    """``use(table)`` for the rows of each group of ``keys``, as batches.

    Groups must be bounded: one is in memory at a time, or with ``together`` the whole
    groups that end in a batch, for a ``use`` that tells them apart itself. Rows are
    exchanged and sorted by the keys, which are long columns without nulls, and by
    ``order`` within them.
    """
    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *([] if order is None else [order]))

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
            cuts = (np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1).tolist()
            if held and tuple(c[0] for c in columns) != last:
                cuts = [0, *cuts]
            if together:
                cuts = cuts[-1:]
            begin = 0
            for cut in cuts:
                if cut > begin:
                    held.append(batch.slice(begin, cut - begin))
                yield from use(pa.Table.from_batches(held))
                held, begin = [], cut
            held.append(batch.slice(begin))
            last = tuple(c[-1] for c in columns)
        if held:
            yield from use(pa.Table.from_batches(held))

    return ordered.mapInArrow(released(run), schema)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.

    An expression that a lambda captures would be evaluated for every element; a
    lambda's own variable is not.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def running(items: Column, start: Column, kind: str, step, block: int = 512) -> Column:
    """The values that ``step(at, item) -> (next at, value, whether to keep it)`` yields over an array.

    An array that grows by appending is copied each time; blocks keep the copies small,
    so a text with very many matches stays near linear.
    """

    def fold(part: Column, at: Column) -> Column:
        def one(acc: Column, item: Column) -> Column:
            following, value, keep = step(acc["at"], item)
            return F.struct(following.alias("at"), F.when(keep, F.array_append(acc["out"], value)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(part, F.struct(at.alias("at"), F.array().cast(f"array<{kind}>").alias("out")), one)

    def outer(acc: Column, part: Column) -> Column:
        return bind(fold(part, acc["at"]), lambda f: F.struct(f["at"].alias("at"), F.array_append(acc["out"], f["out"]).alias("out")))

    def blocks(all_items: Column) -> Column:
        count = F.ceil(F.size(all_items) / block).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda k: F.slice(all_items, k * block + 1, block))

    zero = F.struct(start.alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.flatten(F.aggregate(bind(items, blocks), zero, outer, lambda acc: acc["out"]))


#: Bytes for each core below which a table may be one or two row groups, and is dealt out to all cores.
LEAST_SHARE = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder. A small one, whose few row groups would keep most cores idle, is dealt out as it is read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < LEAST_SHARE * cores else df
