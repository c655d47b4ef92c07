"""Vehicle-bus logs and their dictionaries.

A dictionary is small text, parsed on the driver. Frames are decoded by bit expressions:
one nullable struct column for each message of the dictionary.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.library import bits, column, place
from .basic import empty, exists
from .registry import Registry, TableFunction

_MESSAGE = re.compile(r"^BO_ (\d+) (\w+)\s*: (\d+) (\S+)", re.M)
_SIGNAL = re.compile(r'^\s*SG_ (\w+)\s*(\w+)?\s*: (\d+)\|(\d+)@([01])([+-]) \(([^,]+),([^)]+)\) \[([^|]*)\|([^\]]*)\] "([^"]*)" (.*)$')
_COMMENT = re.compile(r'^CM_ (BO_|SG_) (\d+) (?:(\w+) )?"([^"]*)";', re.M)
_VALUES = re.compile(r'^VAL_ (\d+) (\w+) (.*);', re.M)
_START = re.compile(r'^BA_ "GenSigStartValue" SG_ (\d+) (\w+) ([^;]+);', re.M)
_CYCLE = re.compile(r'^BA_ "GenMsgCycleTime" BO_ (\d+) (\d+);', re.M)
SIGNAL = "Id bigint, Name string, StartBit int, Length int, ByteOrder smallint, InitialValue double, Factor double, IsInteger boolean, Offset double, Minimum double, Maximum double, Unit string, Receiver array<string>, Comment string, Multiplexing string, MessageName string, ValueMap array<struct<Value:int,Name:string>>, MessageOrder int"
MESSAGE = f"Id bigint, IsExtId boolean, Name string, DLC int, Transmitter string, Comment string, CycleTime int, Signals array<struct<{re.sub(r'(^|, )(\w+) ', r'\1\2:', SIGNAL)}>>"


@dataclass
class Signal:
    name: str
    start: int
    length: int
    little: bool
    signed: bool
    factor: float
    offset: float
    row: tuple = ()


@dataclass
class Message:
    id: int
    name: str
    length: int
    row: tuple = ()
    signals: list[Signal] = field(default_factory=list)


def parse_dbc(text: str) -> list[Message]:
    comments = {(m[2], m[3]): m[4] for m in _COMMENT.finditer(text)}
    initial = {(m[1], m[2]): float(m[3]) for m in _START.finditer(text)}
    cycles = {m[1]: int(m[2]) for m in _CYCLE.finditer(text)}
    values = {(m[1], m[2]): [(int(v), n) for v, n in re.findall(r'(-?\d+) "([^"]*)"', m[3])] for m in _VALUES.finditer(text)}
    out: list[Message] = []
    for order, m in enumerate(_MESSAGE.finditer(text)):
        raw = int(m[1])
        number, extended = raw & 0x1FFFFFFF, raw >= 1 << 31
        message = Message(number, m[2], int(m[3]))
        for line in text[m.end() :].split("\n")[1:]:
            s = _SIGNAL.match(line)
            if not s:
                break
            factor, offset = float(s[7]), float(s[8])
            signal = Signal(s[1], int(s[3]), int(s[4]), s[5] == "1", s[6] == "-", factor, offset)
            receivers = [r.strip() for r in s[12].split(",") if r.strip()]
            signal.row = (number, s[1], signal.start, signal.length, int(s[5]), initial.get((m[1], s[1]), 0.0), factor, factor.is_integer() and offset.is_integer(), offset, float(s[9] or 0), float(s[10] or 0), s[11], receivers, comments.get((m[1], s[1])), s[2] or "", m[2], values.get((m[1], s[1]), []), order)
            message.signals.append(signal)
        message.row = (number, extended, m[2], int(m[3]), m[4], comments.get((m[1], None)), cycles.get(m[1], 0), [s.row for s in message.signals])
        out.append(message)
    return out


def dictionary(engine, path: str) -> list[Message]:
    return parse_dbc(engine.spark.read.text(path, wholetext=True).first()[0].replace("\r\n", "\n"))


def messages(engine, path: str) -> DataFrame:
    return engine.spark.createDataFrame([m.row for m in dictionary(engine, path)], MESSAGE)


def signals(engine, path: str) -> DataFrame:
    return engine.spark.createDataFrame([s.row for m in dictionary(engine, path) for s in m.signals], SIGNAL)


def number(text: Column, kind: str) -> Column:
    """An identifier in decimal, hexadecimal or binary digits."""
    base = {"dec": 10, "hex": 16, "bin": 2}[kind]
    bare = F.regexp_replace(F.lower(F.trim(text)), "^0[xb]", "")
    return F.conv(bare, base, 10).try_cast("bigint")


def payload(text: Column) -> Column:
    """Bits of a payload: ``0x`` hexadecimal, ``0b`` binary, decimal, else bare hexadecimal; unsigned, kept in a long."""
    low = F.lower(F.trim(text))
    of = lambda c, base: F.conv(c, base, -10).try_cast("bigint")
    return F.when(low.startswith("0x"), of(F.substring(low, 3, 64), 16)).when(low.startswith("0b"), of(F.substring(low, 3, 64), 2)).when(low.rlike("^[0-9]+$"), of(low, 10)).otherwise(of(low, 16))


def decode(raw: Column, signal: Signal) -> Column:
    return bits(raw, signal.start, signal.length, signal.little, signal.signed).cast("double") * signal.factor + signal.offset


def encode(value: Column, signal: Signal) -> Column:
    return place(F.round((value.cast("double") - signal.offset) / signal.factor).cast("bigint"), signal.start, signal.length, signal.little)


def _swap(raw: Column) -> Column:
    """The eight bytes of a long, the other way round."""
    out = F.lit(0).cast("bigint")
    for k in range(8):
        byte = F.shiftrightunsigned(raw, 8 * k).bitwiseAND(F.lit(255))
        out = out.bitwiseOR(F.shiftleft(byte, 8 * (7 - k)))
    return out


def frames(engine, csv: str, dbc: str, kind: str = "dec", endianness: str = "little") -> DataFrame:
    """Logged frames with one struct for each message, null where the frame is of another."""
    known = dictionary(engine, dbc)
    if not exists(engine, csv):
        return empty(engine, "ID bigint, Timestamp decimal(20,0), IsWellKnown boolean, Data bigint")
    raw = engine.spark.read.option("header", True).csv(csv)
    named = {c.lower(): c for c in raw.columns}
    data = payload(F.col(named["data"]))
    if endianness == "big":
        # Bytes come in the order of transmission: the first digit pair is byte 0.
        digits = F.regexp_replace(F.lower(F.trim(F.col(named["data"]))), "^0x", "")
        data = _swap(F.conv(F.rpad(digits, 16, "0"), 16, -10).cast("bigint"))
    ids = [m.id for m in known]
    rows = raw.select(number(F.col(named["id"]), kind).alias("ID"), F.col(named["timestamp"]).try_cast("decimal(20,0)").alias("Timestamp"), data.alias("Data"))
    which = F.lit(None).cast("string")
    for m in known:
        which = F.when(F.col("ID") == m.id, m.name).otherwise(which)
    rows = rows.withColumns({"Message": which, "IsWellKnown": F.col("ID").isin(ids), "DataAsBytes": F.unhex(F.lpad(F.hex("Data"), 16, "0"))})
    of = {m.name: F.when(F.col("ID") == m.id, F.struct(*[decode(F.col("Data"), s).alias(s.name) for s in m.signals])) for m in known if m.signals}
    return rows.withColumns(of | {"UnknownMessage": F.when(~F.col("IsWellKnown"), F.struct(F.col("ID").alias("Id"), F.col("Data").alias("RawData")))})


def row_library(engine, args: list) -> dict:
    """Encoding and decoding for one dictionary's messages, named by the call's alias row."""
    paths = [a for a in args if isinstance(a, str) and a.lower().endswith(".dbc")]
    if not paths:
        return {}
    parsed = dictionary(engine, paths[0])
    known = {s.name.lower(): s for m in parsed for s in m.signals}

    def by_name(use):
        def run(name, value):
            out = F.lit(None)
            for key, signal in known.items():
                out = F.when(F.lower(name) == key, use(column(value), signal)).otherwise(out)
            return out

        return run

    def encode_message(first, second=None):
        """``(signal, value)``, or one text of JSON: signals of a message and their values, all placed in one payload."""
        if second is not None:
            return by_name(encode)(first, second)
        out = F.lit(0).cast("bigint")
        for m in parsed:
            for s in m.signals:
                value = F.get_json_object(first, f"$.{s.name}").cast("double")
                out = out.bitwiseOR(F.coalesce(encode(value, s), F.lit(0).cast("bigint")))
        return F.when(first.isNotNull(), out)

    return {"encodemessage": encode_message, "decodemessage": by_name(lambda v, s: decode(v.cast("bigint"), s))}


def register(registry: Registry) -> None:
    add = lambda name, params, make: registry.add(TableFunction("can", name, tuple(params), make))
    add("messages", ("dbc: string",), messages)
    add("signals", ("dbc: string",), signals)
    add("separatedvalues", ("csvData: string", "dbcData: string"), frames)
    add("separatedvalues", ("csvData: string", "dbcData: string", "idOfType: string"), frames)
    add("separatedvalues", ("csvData: string", "dbcData: string", "idOfType: string", "endianness: string"), frames)
