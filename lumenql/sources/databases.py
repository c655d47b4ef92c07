"""Relational databases: JDBC where a driver is configured, else a Python source for SQLite files."""

from __future__ import annotations

import sqlite3

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual

from .registry import Registry, TableFunction

_TYPES = {"integer": T.LongType(), "int": T.LongType(), "bigint": T.LongType(), "real": T.DoubleType(), "double": T.DoubleType(), "numeric": T.DoubleType(), "blob": T.BinaryType()}
_COMPARE = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class RowRange(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    """Reads a table by ranges of its row ids; filters that SQLite understands run there, with bound parameters."""

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.names = options["path"], options["dbtable"], schema.names
        self.parts = int(options.get("partitions", "4"))
        self.where: list[tuple[str, list]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) else None
            quoted = None if name is None else '"' + name.replace('"', '""') + '"'
            if type(f) in _COMPARE and isinstance(f.value, (int, float, str)) and not isinstance(f.value, bool):
                self.where.append((f"{quoted} {_COMPARE[type(f)]} ?", [f.value]))
            elif isinstance(f, In) and all(isinstance(v, (int, float, str)) for v in f.value):
                self.where.append((f"{quoted} in ({', '.join('?' * len(f.value))})", list(f.value)))
            elif isinstance(f, IsNull):
                self.where.append((f"{quoted} is null", []))
            elif isinstance(f, IsNotNull):
                self.where.append((f"{quoted} is not null", []))
            else:
                yield f

    def _quoted(self) -> str:
        return '"' + self.table.replace('"', '""') + '"'

    def partitions(self):
        with sqlite3.connect(self.path) as db:
            low, high = db.execute(f"select min(rowid), max(rowid) from {self._quoted()}").fetchone()
        if low is None:
            return [RowRange(0, 0)]
        step = max(1, (high - low + self.parts) // self.parts)
        return [RowRange(at, min(at + step, high + 1)) for at in range(low, high + 1, step)]

    def read(self, part):
        where = " and ".join(["rowid >= ? and rowid < ?", *(w for w, _ in self.where)])
        values = [part.low, part.high, *(v for _, vs in self.where for v in vs)]
        columns = ", ".join('"' + n.replace('"', '""') + '"' for n in self.names)
        with sqlite3.connect(self.path) as db:
            yield from db.execute(f"select {columns} from {self._quoted()} where {where}", values)


class SqliteSource(DataSource):
    @classmethod
    def name(cls):
        return "lumenql_sqlite"

    def schema(self):
        with sqlite3.connect(self.options["path"]) as db:
            table = self.options["dbtable"].replace('"', '""')
            rows = db.execute(f'pragma table_info("{table}")').fetchall()
        if not rows:
            raise ValueError(f"no table {self.options['dbtable']}")
        return T.StructType([T.StructField(r[1], _TYPES.get((r[2] or "text").split("(")[0].lower(), T.StringType())) for r in rows])

    def reader(self, schema):
        return SqliteReader(self.options, schema)


def sqlite(engine, table: str) -> DataFrame:
    path = engine.options.get("sqlite")
    if not path:
        raise ValueError("the option 'sqlite' names the database file")
    engine.spark.dataSource.register(SqliteSource)
    return engine.spark.read.format("lumenql_sqlite").option("path", str(path)).option("dbtable", table).load()


def postgres(engine, table: str, schema: str = "public") -> DataFrame:
    """Projection, filters and limits are pushed down by the JDBC source itself."""
    options = engine.options.get("jdbc")
    if not options:
        raise ValueError("the option 'jdbc' holds the connection options, at least 'url'")
    quote = lambda n: '"' + n.replace('"', '""') + '"'
    return engine.spark.read.format("jdbc").options(**options).option("dbtable", f"{quote(schema)}.{quote(table)}").load()


def register(registry: Registry) -> None:
    registry.add(TableFunction("sqlite", "*", (), sqlite))
    registry.add(TableFunction("postgres", "*", ("schemaName: string",), postgres))
