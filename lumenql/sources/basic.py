"""Generated rows, calendars, flat and delimited files, JSON files, and the engine's own tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import Registry, TableFunction

#: Type words of declared tables, and the Spark type that holds each.
TYPES = {
    "bool": "boolean", "boolean": "boolean", "byte": "smallint", "sbyte": "tinyint", "short": "smallint", "int16": "smallint", "ushort": "int", "uint16": "int",
    "int": "int", "int32": "int", "uint": "bigint", "uint32": "bigint", "long": "bigint", "int64": "bigint", "ulong": "decimal(20,0)", "uint64": "decimal(20,0)",
    "float": "float", "single": "float", "double": "double", "decimal": "decimal(38,18)", "char": "string", "string": "string", "datetime": "timestamp",
    "datetimeoffset": "timestamp", "guid": "string",
}
_BOUNDS = {"byte": (0, 255), "ushort": (0, 65535), "uint16": (0, 65535), "uint": (0, 2**32 - 1), "uint32": (0, 2**32 - 1), "ulong": (0, 2**64 - 1), "uint64": (0, 2**64 - 1)}


def spark_type(word: str) -> str:
    word = word.rstrip("?").split(".")[-1].lower()
    if word not in TYPES:
        raise ValueError(f"unknown column type {word!r}")
    return TYPES[word]


def typed(text: Column, word: str) -> Column:
    """A declared column of a text: null where it cannot be read, and of an empty string."""
    word = word.rstrip("?").split(".")[-1].lower()
    kind = spark_type(word)
    if kind == "string":
        return F.when(text != "", F.substring(text, 1, 1) if word == "char" else text)
    if kind == "timestamp":
        out = F.coalesce(text.try_cast("timestamp"), *(F.try_to_timestamp(text, F.lit(f)) for f in ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy")))
        return F.when(text != "", out)
    out = F.trim(text).try_cast(kind)
    if word in _BOUNDS:
        low, high = _BOUNDS[word]
        out = F.when((out >= F.lit(low)) & (out <= F.lit(high).cast("decimal(20,0)")), out)
    return out


def exists(engine, path: str) -> bool:
    jvm_path = engine.spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(engine.spark._jsc.hadoopConfiguration()).exists(jvm_path)


def empty(engine, ddl: str) -> DataFrame:
    return engine.spark.createDataFrame([], ddl)


#: Splits whose numbers are broadcast; more are joined by a shuffle.
MOST_SPLITS = 50_000


def _splits(engine, paths: list[str]) -> int:
    """An upper bound of the splits that a read of these paths makes."""
    size = files = 0
    per = int(engine.spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    for path in paths:
        jvm_path = engine.spark._jvm.org.apache.hadoop.fs.Path(path)
        summary = jvm_path.getFileSystem(engine.spark._jsc.hadoopConfiguration()).getContentSummary(jvm_path)
        size += summary.getLength()
        files += summary.getFileCount()
    return files + 8 * (size // max(1, per) + 1)


def numbered_lines(engine, paths: list[str]) -> DataFrame:
    """Lines with their number in the file, from 1; files may be of any size.

    Files are read in splits. A first pass counts the lines of each split, which gives its
    first number; within a split a line's place is its distance from the split's first
    row. Only one row for each split is shuffled, never the lines.
    """
    meta = F.col("_metadata")
    lines = engine.spark.read.text(paths).select(meta["file_path"].alias("File"), meta["file_block_start"].alias("__block"), F.monotonically_increasing_id().alias("__id"), F.col("value").alias("Line"))
    splits = lines.groupBy("File", "__block").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("File").orderBy("__block")) - F.col("__n")
    splits = splits.select(F.col("File").alias("__file"), F.col("__block").alias("__at"), "__first", before.alias("__before"))
    if _splits(engine, paths) <= MOST_SPLITS:
        splits = F.broadcast(splits)  # a few numbers for each split, and lines keep their order
    found = lines.join(splits, (F.col("File") == F.col("__file")) & (F.col("__block") == F.col("__at")))
    number = (F.col("__id") - F.col("__first") + F.col("__before") + 1).cast("int")
    text = F.when(number == 1, F.regexp_replace("Line", "^\ufeff", "")).otherwise(F.col("Line"))
    return found.select("File", number.alias("LineNumber"), text.alias("Line"))


def flat_file(engine, path: str) -> DataFrame:
    if not exists(engine, path):
        return empty(engine, "LineNumber int, Line string")
    return numbered_lines(engine, [path]).select("LineNumber", "Line")


def column_name(header: str) -> str:
    """A header as a column name: words run together, letters after a blank or underscore upper-cased, other signs gone."""
    joined = re.sub(r"_([a-z])", lambda m: "_" + m[1].upper(), header.replace(" ", "_"))
    return re.sub(r"[^a-zA-Z0-9 -]", "", joined)


def _first_line(engine, path: str, skip: int) -> str | None:
    rows = engine.spark.read.text(path).limit(skip + 1).collect()
    return rows[skip][0] if len(rows) > skip else None


def delimited(separator: str):
    """A reader of delimited files; declared columns are typed, others are text."""

    def make(engine, path, has_header: bool, skip_lines: int, declared: list[tuple[str, str]] | None = None) -> DataFrame:
        paths = [path] if isinstance(path, str) else list(path)
        paths = [p for p in paths if exists(engine, p)]
        if not paths:
            return empty(engine, ", ".join(f"`{n}` {spark_type(t)}" for n, t in declared or [("Column1", "string")]))
        out = None
        for p in paths:  # each file's own header says where a column is
            part = _one(engine, p, has_header, skip_lines, declared, separator)
            out = part if out is None else out.unionByName(part)
        return out

    return make


def _one(engine, path, has_header, skip, declared, separator) -> DataFrame:
    import csv

    first = _first_line(engine, path, skip)
    if first is None:
        return empty(engine, ", ".join(f"`{n}` {spark_type(t)}" for n, t in declared or [("Column1", "string")]))
    cells = next(csv.reader([first], delimiter=separator))
    names = [column_name(c) for c in cells] if has_header else [f"Column{i + 1}" for i in range(len(cells))]
    if declared and not has_header:
        names = [n for n, _ in declared]
    spanning = engine.options.get("quoted_line_breaks", "find")
    spanning = _spans_lines(engine, path) if spanning == "find" else bool(spanning)
    if spanning and skip:
        return _typed(_records(engine, path, skip + int(has_header), names, separator), names, declared)
    if not skip:
        return _read(engine, [path], has_header, names, separator, declared, spanning)
    # Leading lines are dropped by number; the rest is parsed from text.
    lines = numbered_lines(engine, [path]).where(F.col("LineNumber") > skip + int(has_header)).select(F.col("Line").alias("value"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parsed = lines.where("value <> ''").select(F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"sep": separator}).alias("r")).select("r.*")
    return _typed(parsed, names, declared)


def _spans_lines(engine, path: str) -> bool:
    """Whether a quoted cell holds a line break: then some line has an odd number of quotes.

    Such a file cannot be split. The engine's option ``quoted_line_breaks`` (True or False)
    states it and spares this scan.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return not engine.spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def _records(engine, path: str, skip: int, names: list[str], separator: str) -> DataFrame:
    """Records of a file behind ``skip`` leading lines, where cells may hold line breaks; one task for each file."""
    width = len(names)

    def run(batches):
        import csv
        import io

        import pandas as pd

        for batch in batches:
            for data in batch["content"]:
                text = io.StringIO(data.decode("utf-8-sig", "replace"), newline="")
                for _ in range(skip):
                    text.readline()
                held = []
                for cells in csv.reader(text, delimiter=separator):
                    if cells:
                        held.append((cells + [None] * width)[:width])
                    if len(held) >= 10_000:
                        yield pd.DataFrame(held, columns=names, dtype=object)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=names, dtype=object)

    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return engine.spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def _read(engine, paths, has_header, names, separator, declared, spanning: bool = False) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = engine.spark.read.schema(schema).option("sep", separator).option("header", has_header).option("enforceSchema", True).option("mode", "PERMISSIVE").option("multiLine", spanning).option("escape", '"')
    return _typed(reader.csv(paths), names, declared)


def _typed(df: DataFrame, names: list[str], declared) -> DataFrame:
    if not declared:
        return df.select(*[F.when(F.col(f"`{n}`") != "", F.col(f"`{n}`")).alias(n) for n in names])
    have = {n.lower(): n for n in names}
    return df.select(*[(typed(F.col(f"`{have[n.lower()]}`"), t) if n.lower() in have else F.lit(None).cast(spark_type(t))).alias(n) for n, t in declared])


def delimited_bytes(separator: str):
    """The same over a binary value, for lateral use: an array of declared rows."""

    def lateral(data: Column, has_header, skip_lines, declared) -> Column:
        text = F.regexp_replace(F.decode(data, "UTF-8"), r"\r?\n\z", "")
        begin = int(skip_lines.value) + int(bool(has_header.value)) + 1
        lines = F.filter(F.slice(F.split(text, r"\r?\n", -1), begin, 1_000_000_000), lambda x: x != "")
        ddl = ", ".join(f"`{n}` string" for n, _ in declared)
        row = lambda x: F.from_csv(x, ddl, {"sep": separator})
        return F.transform(F.transform(lines, row), lambda r: F.struct(*[typed(r[n], t).alias(n) for n, t in declared]))

    return lateral


def json_file(engine, path: str, schema_path: str | None = None) -> DataFrame:
    """Rows of a JSON object or array; the side file declares them. Elements that are not objects are dropped."""
    import json

    if schema_path:
        text = engine.spark.read.text(schema_path, wholetext=True).first()[0]
        declared = json.loads(text)
        kind = json_type(declared[0] if isinstance(declared, list) and declared else declared)
        if isinstance(kind, T.StructType):
            # Elements are taken apart as text first: one that is not an object must not spoil its neighbours.
            text = F.trim(F.regexp_replace("value", "^\ufeff", ""))
            each = F.when(F.startswith(text, F.lit("{")), F.array(text)).otherwise(F.from_json(text, "array<string>"))
            objects = engine.spark.read.text(path, wholetext=True).select(F.explode(each).alias("e")).where(F.col("e").startswith("{"))
            return objects.select(F.from_json("e", kind).alias("r")).select("r.*")
        text = engine.spark.read.text(path, wholetext=True)
        return text.select(F.from_json("value", f"array<{'string' if kind is None else kind.simpleString()}>").alias("Array"))
    return engine.spark.read.option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def json_type(declared) -> T.DataType:
    """The type that a side schema states: words, objects and arrays."""
    words = {"string": T.StringType(), "int": T.LongType(), "long": T.LongType(), "float": T.DecimalType(38, 18), "decimal": T.DecimalType(38, 18), "double": T.DoubleType(), "bool": T.BooleanType(), "boolean": T.BooleanType()}
    if isinstance(declared, dict):
        return T.StructType([T.StructField(k, json_type(v)) for k, v in declared.items()])
    if isinstance(declared, list):
        return T.ArrayType(json_type(declared[0]) if declared else T.StringType())
    return words.get(str(declared).lower(), T.StringType())


STEPS = {"second": "1 second", "minute": "1 minute", "hour": "1 hour", "day": "1 day", "month": "1 month", "year": "1 year"}


def moments(start: Column, stop: Column, step: str) -> Column:
    """Moments from start to stop, both included. Months and years step from the previous moment, not from the start."""
    word = step.rstrip("s").lower()
    if word not in STEPS:
        raise ValueError(f"unknown interval {step!r}; there are: {', '.join(STEPS)}")
    interval = F.expr(f"interval {STEPS[word]}")
    if word not in ("month", "year"):
        return F.when(stop >= start, F.sequence(start, stop, interval)).otherwise(F.array().cast("array<timestamp>"))
    months = F.greatest(F.ceil(F.months_between(stop, start)).cast("int"), F.lit(0)) + 1
    count = months if word == "month" else F.floor(months / 12).cast("int") + 1
    walk = F.aggregate(F.sequence(F.lit(1), count), F.array(start), lambda a, _: F.array_append(a, F.element_at(a, -1) + interval))
    return F.filter(walk, lambda x: x <= stop)


def time_interval(engine, start: str, stop: str, step: str) -> DataFrame:
    from ..functions.library import Constant, to_date_time

    at = lambda t: to_date_time(Constant(t), Constant(engine.options.get("culture", "en-US")))
    t = F.col("DateTime")
    days = engine.spark.range(1).select(F.explode(moments(at(start), at(stop), step)).alias("DateTime"))
    clock = (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("bigint")
    return days.select(
        t, F.second(t).alias("Second"), F.minute(t).alias("Minute"), F.hour(t).alias("Hour"), F.dayofmonth(t).alias("Day"), F.month(t).alias("Month"), F.year(t).alias("Year"),
        (F.dayofweek(t) - 1).alias("DayOfWeek"), F.dayofyear(t).alias("DayOfYear"), F.make_dt_interval(secs=clock).alias("TimeOfDay"),
    )


def register(registry: Registry) -> None:
    add = lambda schema, name, params, make, lateral=None: registry.add(TableFunction(schema, name, tuple(params), make, lateral))
    one = lambda engine: engine.spark.range(1).select(F.lit("single").alias("Dummy"))
    add("system", "dual", (), one)
    add("os", "single", (), one)
    span = lambda low, high: F.when(high > low, F.sequence(low.cast("bigint"), high.cast("bigint") - 1)).otherwise(F.array().cast("array<bigint>"))
    add("system", "range", ("max: long",), lambda engine, high: engine.spark.range(0, int(high)).select(F.col("id").alias("Value")), lambda high: span(F.lit(0), high))
    add("system", "range", ("min: long", "max: long"), lambda engine, low, high: engine.spark.range(int(low), int(high)).select(F.col("id").alias("Value")), span)
    add("time", "interval", ("startDateTime: string", "stopDateTime: string", "interval: string"), time_interval)
    add("flat", "file", ("path: string",), flat_file)
    for name, separator in (("comma", ","), ("tab", "\t"), ("semicolon", ";")):
        add("separatedvalues", name, ("path: string", "hasHeader: bool", "skipLines: int"), delimited(separator), delimited_bytes(separator))
    add("json", "file", ("jsonFilePath: string", "jsonSchemaFilePath: string"), json_file)
    add("json", "file", ("jsonFilePath: string",), json_file)
    table = lambda engine, name: engine.spark.read.parquet(f"{engine.options['tables']}/{name}.parquet")
    registry.add(TableFunction("tables", "*", (), table))
