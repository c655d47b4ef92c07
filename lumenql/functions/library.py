"""The function library: every function maps Columns to a Column.

``FUNCTIONS`` holds functions of their arguments alone. ``ROW_FUNCTIONS`` also take the
row that the call's alias stands for (a struct of its columns), passed first. Functions
whose result is an array can be applied to rows by ``cross apply``. Names are looked up
without regard to case. Constant arguments that steer how an expression is built arrive
as ``lit`` Columns and are read back by ``constant``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

FUNCTIONS: dict[str, Callable[..., Column]] = {}
ROW_FUNCTIONS: dict[str, Callable[..., Column]] = {}
#: Library of each function, for introspection.
LIBRARY: dict[str, set[str]] = {}
DAY_MICROS = 86_400_000_000
DECIMAL = "decimal(38,18)"


class Constant:
    """A literal argument with its Python value."""

    def __init__(self, value: object):
        self.value = value


def constant(arg: object, default: object = None) -> object:
    if isinstance(arg, Constant):
        return arg.value
    if arg is None:
        return default
    raise ValueError("this argument has to be a constant")


def column(arg: object) -> Column:
    return F.lit(arg.value) if isinstance(arg, Constant) else arg


def _add(table: dict, library: str, names: tuple[str, ...], raw: bool):
    def wrap(f):
        g = f if raw else lambda *args: f(*map(column, args))
        for name in names or (f.__name__.strip("_").replace("_", ""),):
            table[name.lower()] = g
            LIBRARY.setdefault(library, set()).add(name)
        return f

    return wrap


def function(library: str, *names: str, raw: bool = False):
    return _add(FUNCTIONS, library, names, raw)


def row_function(library: str, *names: str, raw: bool = False):
    return _add(ROW_FUNCTIONS, library, names, raw)


# -- general


@function("base", "ToDecimal")
def to_decimal(x, culture=None):
    return x.try_cast(DECIMAL)


for _name, _kind in (("ToInt32", "int"), ("ToInt64", "bigint"), ("ToDouble", "double"), ("ToString", "string"), ("ToBoolean", "boolean"), ("ToFloat", "float")):
    FUNCTIONS[_name.lower()] = lambda x, kind=_kind: column(x).try_cast(kind)
    LIBRARY.setdefault("base", set()).add(_name)


@function("base", "ToDateTime", "ToDateTimeOffset", raw=True)
def to_date_time(text, culture=None):
    """Timestamp of a text; month before day, but for cultures that write the day first."""
    text, culture = column(text), constant(culture, "en-US")
    day_first = culture not in ("en-US", "")
    date = "dd/MM/yyyy" if day_first else "MM/dd/yyyy"
    dotted = F.try_to_timestamp(text, F.lit("dd.MM.yyyy[ HH:mm[:ss]]"))
    slashed = F.try_to_timestamp(text, F.lit(f"{date}[ HH:mm[:ss]]"))
    return F.coalesce(slashed, dotted, text.try_cast("timestamp"))


@function("base", "ExtractFromDate", raw=True)
def extract_from_date(text, *rest):
    """``(text, part)`` or ``(text, culture, part)``."""
    part, culture = constant(rest[-1]), rest[0] if len(rest) > 1 else None
    return F.extract(F.lit(str(part).upper()), to_date_time(text, culture)).cast("int")


@function("base", "ToHex", raw=True)
def to_hex(data, separator=None):
    separator = constant(separator, "")
    if separator:
        return F.regexp_replace(F.hex(column(data)), "(..)(?!$)", "$1" + re.sub(r"([\\$])", r"\\\1", separator))
    return F.hex(column(data))


@function("base", "Cast_Dec")
def cast_dec(x):
    """Money with four decimals, whose sums do not depend on order."""
    return x.cast("decimal(18,4)")


@function("base", "Cast_Seconds")
def cast_seconds(x):
    """Whole seconds of a duration."""
    return (F.extract(F.lit("DAY"), x) * 86400 + F.extract(F.lit("HOUR"), x) * 3600 + F.extract(F.lit("MINUTE"), x) * 60 + F.floor(F.extract(F.lit("SECOND"), x))).cast("bigint")


@function("base", "ToDecimal20")
def to_decimal20(x):
    """An unsigned 64-bit number."""
    return x.try_cast("decimal(20,0)")


@function("base", "Abs")
def _abs(x):
    return F.abs(x)


@function("base", "Round", raw=True)
def _round(x, places=None):
    """Half to even, as the reference's platform rounds."""
    return F.bround(column(x), int(constant(places, 0)))


@function("base", "PercentOf")
def percent_of(part, whole):
    return F.try_divide(part * 100, whole)


@function("base", "Contains")
def _contains(text, part):
    return F.contains(text, part)


@function("base", "StartsWith")
def _starts_with(text, part):
    return F.startswith(text, part)


@function("base", "EndsWith")
def _ends_with(text, part):
    return F.endswith(text, part)


@function("base", "ToLower", "ToLowerInvariant")
def _lower(x):
    return F.lower(x)


@function("base", "ToUpper", "ToUpperInvariant")
def _upper(x):
    return F.upper(x)


@function("base", "Skip", raw=True)
def _skip(x, n):
    return F.substring(column(x), int(constant(n)) + 1, 2**31 - 1)


@function("base", "Take", raw=True)
def _take(x, n):
    return F.substring(column(x), 1, int(constant(n)))


@function("base", "SkipAndTake", raw=True)
def _skip_and_take(x, skip, take):
    return F.substring(column(x), int(constant(skip)) + 1, int(constant(take)))


def part_of_array(name: str, items: Column, *numbers) -> Column:
    """``Skip``, ``Take`` and ``SkipAndTake`` of an array; numbers beyond its end give what is there."""
    n = [int(constant(x)) for x in numbers]
    skip, take = {"skip": (n[0], None), "take": (0, n[0]), "skipandtake": (n[0], n[-1])}[name]
    return F.slice(items, max(skip, 0) + 1, F.size(items) + 1 if take is None else F.lit(max(take, 0)))


@function("base", "EnumerableToArray")
def _to_array(x):
    return x


@function("base", "Coalesce")
def _coalesce(*xs):
    return F.coalesce(*xs)


@function("base", "Split")
def _split(text, separator):
    return F.split(text, F.concat(F.lit("\\Q"), separator, F.lit("\\E")))


@function("json", "Length")
def _length(x):
    return F.size(x)


@function("json", "MakeFlat")
def make_flat(x):
    return F.array_join(F.transform(x, lambda e: e.cast("string")), ", ")


# -- separated values


@function("separatedvalues", "ClusteredByContainsKey", raw=True)
def clustered_by(dictionary, value):
    """Category of the first dictionary word that the text contains, else ``other``.

    The dictionary is a path of ``category:`` lines with words below, or such text itself.
    """
    source = str(constant(dictionary))
    if "\n" not in source:
        with open(source, encoding="utf-8") as f:
            source = f.read()
    pairs, key, low = [], "", F.lower(column(value))
    for line in map(str.strip, source.lower().splitlines()):
        if line.endswith(":"):
            key = line[:-1]
        elif line:
            pairs.append((line, key))
    out = F.lit("other")
    for word, category in reversed(pairs):
        out = F.when(low.contains(word), F.lit(category)).otherwise(out)
    return F.when(low.isNotNull(), out)


# -- code hosting


def _items(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


@function("github", "ParseRepoFullName")
def parse_repo(name):
    parts = F.split(name, "/")
    empty = F.lit("")
    good = F.size(parts) == 2
    return F.struct(F.when(good, F.get(parts, 0)).otherwise(empty).alias("Owner"), F.when(good, F.get(parts, 1)).otherwise(empty).alias("Repo"))


@function("github", "HasLabel")
def has_label(labels, label):
    return F.coalesce(F.array_contains(_items(F.lower(labels)), F.lower(label)), F.lit(False))


@function("github", "LabelCount")
def label_count(labels):
    return F.coalesce(F.size(F.coalesce(_items(labels), F.array().cast("array<string>"))), F.lit(0))


def _days(start: Column, end: Column) -> Column:
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    return (micros(end) - micros(start)) / F.lit(DAY_MICROS)


@function("github", "DaysBetween")
def days_between(start, end=None):
    return _days(start, F.current_timestamp() if end is None else F.coalesce(end.cast("timestamp"), F.current_timestamp()))


@function("github", "AgeDays")
def age_days(created):
    return _days(created, F.current_timestamp())


@function("github", "IsStale")
def is_stale(updated, days=None, now=None):
    """Older than ``days`` (30); ``now`` replaces the clock where results must repeat."""
    age = _days(updated, F.current_timestamp() if now is None else now)
    return F.coalesce(age > (F.lit(30) if days is None else days), F.lit(False))


@function("github", "ShortSha")
def short_sha(sha, length=None):
    return F.coalesce(F.left(sha, F.lit(7) if length is None else length), F.lit(""))


# -- issue tracker


for _name, _field in (("HasLabel", "Labels"), ("HasComponent", "Components"), ("HasFixVersion", "FixVersions")):
    ROW_FUNCTIONS[_name.lower()] = lambda row, value, field=_field: has_label(row[field], column(value))
    LIBRARY.setdefault("jira", set()).add(_name)


@row_function("jira", "GetCustomField")
def custom_field(row, name):
    return F.try_element_at(row["CustomFields"], name)


@row_function("jira", "IsSubtask")
def is_subtask(row):
    return F.coalesce(row["ParentKey"], F.lit("")) != ""


@row_function("jira", "IsOverdue")
def is_overdue(row, today=None):
    day = F.current_date() if today is None else today.cast("date")
    return F.coalesce((row["DueDate"].cast("date") < day) & (F.coalesce(row["Resolution"], F.lit("")) == ""), F.lit(False))


@row_function("jira", "GetAgeInDays")
def age_in_days(row, now=None):
    return F.coalesce(F.floor(_days(row["CreatedAt"], F.current_timestamp() if now is None else now)).cast("int"), F.lit(0))


@row_function("jira", "GetTimeToResolutionDays")
def resolution_days(row):
    return F.expr("null").cast("int") if row is None else (_days(row["CreatedAt"], row["ResolvedAt"])).cast("int")


@function("jira", "FormatDuration")
def format_duration(seconds):
    s = seconds.cast("bigint")
    part = lambda size, of: F.floor(F.pmod(s, F.lit(of)) / size).cast("bigint")
    days, hours, minutes = F.floor(s / 86400).cast("bigint"), part(3600, 86400), part(60, 3600)
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(days > 0, F.format_string("%dd %dh %dm", days, hours, minutes))
        .when(hours > 0, F.format_string("%dh %dm", hours, minutes))
        .otherwise(F.format_string("%dm", minutes))
    )


@function("jira", "ExtractProjectKey")
def project_key(key):
    return F.when(F.instr(key, "-") > 1, F.substring_index(key, "-", 1))


@function("jira", "ExtractIssueNumber")
def issue_number(key):
    at = F.instr(key, "-")
    return F.when(at > 0, F.substring(key, at + 1, F.length(key)).try_cast("int"))


# -- clusters


@function("kubernetes", "EncodeSecret", raw=True)
def encode_secret(text, encoding=None):
    return F.base64(F.encode(column(text), str(constant(encoding, "UTF-8"))))


@function("kubernetes", "DecodeSecret")
def decode_secret(text):
    return F.decode(F.unbase64(text), "UTF-8")


@row_function("kubernetes", "GetLabelOrDefault")
def label_or_default(row, key):
    return F.try_element_at(row["Metadata"]["Labels"], key)


# -- files


for _name, _set in (("IsZipArchive", fixed.ZIP), ("IsArchive", fixed.ARCHIVE), ("IsAudio", fixed.AUDIO), ("IsBook", fixed.BOOK), ("IsDoc", fixed.DOC), ("IsImage", fixed.IMAGE), ("IsSource", fixed.SOURCE), ("IsVideo", fixed.VIDEO)):
    FUNCTIONS[_name.lower()] = lambda x, values=_set: column(x).isin(*values)
    ROW_FUNCTIONS[_name.lower()] = lambda row, values=_set: F.lower(row["Extension"]).isin(*values)
    LIBRARY.setdefault("os", set()).add(_name)


def content(row: Column) -> Column:
    return row["Content"]


def text_of(row: Column) -> Column:
    return F.decode(row["Content"], "UTF-8")


@row_function("os", "GetFileContent", "GetTextContent")
def file_content(row):
    return text_of(row)


@row_function("os", "GetContent", "GetStreamContent")
def raw_content(row):
    return content(row)


@row_function("os", "GetRelativePath")
def relative_path(row, base=None):
    path = row["FullPath"]
    root = row["Root"] if base is None else base
    return F.when(F.startswith(path, root), F.substring(path, F.length(root) + 1, F.length(path))).otherwise(path)


@row_function("os", "Head")
def head(row, length):
    return F.substring(content(row), F.lit(1), length)


def last_bytes(data: Column, length: Column) -> Column:
    """The last bytes, all of a shorter value."""
    n = F.least(length, F.octet_length(data))
    return F.substring(data, F.octet_length(data) - n + 1, n)


@row_function("os", "Tail")
def tail(row, length):
    return last_bytes(content(row), length)


@row_function("os", "GetFileBytes")
def file_bytes(row, count=None, offset=None):
    begin = F.lit(1) if offset is None else (offset + 1).cast("int")
    return F.substring(content(row), begin, F.lit(2**31 - 1) if count is None else F.least(count, F.lit(2**31 - 1)).cast("int"))


ROW_FUNCTIONS |= {
    "sha1file": lambda row: F.sha1(content(row)),
    "sha256file": lambda row: F.sha2(content(row), 256),
    "md5file": lambda row: F.md5(content(row)),
    "base64file": lambda row: F.base64(content(row)),
    "getextendedfileinfo": lambda row: row,
}
LIBRARY["os"] |= {"Sha1File", "Sha256File", "Md5File", "Base64File", "GetExtendedFileInfo"}


@row_function("os", "HasContent")
def has_content(row, pattern):
    return F.rlike(text_of(row), pattern)


@row_function("os", "HasAttribute")
def has_attribute(row, flags):
    return row["Attributes"].cast("bigint").bitwiseAND(flags) == flags


def file_lines(text: Column) -> Column:
    """Lines of a text; one line end at the close does not begin another line."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(text, r"\r?\n\z", ""), r"\r?\n", -1))


@row_function("os", "GetLinesContainingWord")
def lines_with_word(row, word):
    numbered = F.transform(file_lines(text_of(row)), lambda x, i: F.when(F.contains(x, word), (i + 1).cast("string")))
    return F.concat(F.lit("("), F.array_join(F.filter(numbered, lambda x: x.isNotNull()), ","), F.lit(")"))


@function("os", "GetFileInfo")
def file_info(path):
    """The file at a path, as the machine that processes the row sees it; null where there is none."""

    @F.pandas_udf("FullPath string, Name string, Extension string, DirectoryPath string, Length bigint, LastWriteTime timestamp, Exists boolean")
    def run(paths: pd.Series) -> pd.DataFrame:
        import os

        def one(p):
            if p is None or not os.path.isfile(p):
                return (None,) * 7
            s = os.stat(p)
            return (p, os.path.basename(p), os.path.splitext(p)[1], os.path.dirname(p), s.st_size, pd.Timestamp(s.st_mtime_ns // 1000, unit="us"), True)

        return pd.DataFrame([one(p) for p in paths], columns=["FullPath", "Name", "Extension", "DirectoryPath", "Length", "LastWriteTime", "Exists"])

    found = run(path)
    return F.when(found["Exists"], found)


@row_function("os", "CountOfLines")
def count_lines(row):
    return F.array_size(file_lines(text_of(row))).cast("bigint")


@row_function("os", "CountOfNotEmptyLines")
def count_filled_lines(row):
    return F.array_size(F.filter(file_lines(text_of(row)), lambda x: x != "")).cast("bigint")


@row_function("os", "Length", "GetFileLength", "GetLengthOfFile", raw=True)
def file_length(row, unit=None):
    power = {"b": 0, "kb": 1, "mb": 2, "gb": 3}[str(constant(unit, "b")).lower()]
    return F.bround(row["Length"].cast("double") / 1024**power).cast("bigint")


@function("os", "SubPath")
def sub_path(path, nesting):
    parts = F.array_join(F.slice(F.split(path, "/"), F.lit(1), F.greatest(nesting, F.lit(0)) + 1), "/")
    return F.when(path.isNull() | (path == ""), F.lit(None).cast("string")).when(nesting < 0, F.lit("")).otherwise(parts)


@row_function("os", "SubPath")
def row_sub_path(row, nesting):
    return sub_path(row["DirectoryPath"], nesting)


@row_function("os", "RelativeSubPath")
def relative_sub_path(row, nesting):
    return sub_path(F.ltrim(relative_path(row), F.lit("/")), nesting)


@function("os", "Combine")
def combine(*paths):
    out = paths[0]
    for p in paths[1:]:
        joined = F.when((out == "") | F.endswith(out, F.lit("/")), F.concat(out, p)).otherwise(F.concat(out, F.lit("/"), p))
        out = F.when(F.startswith(p, F.lit("/")), p).when(p == "", out).otherwise(joined)
    return out


@function("os", "GetDirectoryName")
def directory_name(path):
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


@function("os", "GetFileName")
def file_name(path):
    return F.substring_index(path, "/", -1)


@function("os", "GetFileNameWithoutExtension")
def bare_file_name(path):
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


@function("os", "GetExtension")
def extension(path):
    return F.regexp_extract(path, r"(\.[^./]*)$", 1)


@row_function("os", "GetMetadata")
def metadata(row, *names):
    """Description of the first tag of that name, within a directory if two names are given."""
    tag, directory = names[-1], names[0] if len(names) > 1 else None
    hit = F.filter(row["Metadata"], lambda m: (m["TagName"] == tag) & (F.lit(True) if directory is None else m["DirectoryName"] == directory))
    return F.get(hit, 0)["Description"]


@row_function("os", "HasMetadataDirectory")
def has_metadata_directory(row, name):
    return F.coalesce(F.exists(row["Metadata"], lambda m: m["DirectoryName"] == name), F.lit(False))


@row_function("os", "HasMetadataTag")
def has_metadata_tag(row, *names):
    return F.coalesce(F.exists(row["Metadata"], lambda m: (m["TagName"] == names[-1]) & (F.lit(True) if len(names) == 1 else m["DirectoryName"] == names[0])), F.lit(False))


@row_function("os", "AllMetadataJson")
def all_metadata(row):
    tags = row["Metadata"]
    names = F.array_distinct(F.transform(tags, lambda m: m["DirectoryName"]))
    of = lambda d: F.transform(F.filter(tags, lambda m: m["DirectoryName"] == d), lambda m: F.struct(m["TagName"].alias("Tag"), m["Description"].alias("Description")))
    return F.to_json(F.transform(names, lambda d: F.struct(d.alias("Directory"), of(d).alias("Tags"))))


# -- vehicle bus


@function("can", "FromTimestamp", raw=True)
def from_timestamp(value, resolution):
    value, resolution = column(value).cast("bigint"), constant(resolution)
    per = {"s": 1_000_000, "ms": 1000, "us": 1}
    return F.timestamp_micros(F.floor(value / 1000).cast("bigint") if resolution == "ns" else value * per[str(resolution)])


def bits(raw: Column, start: int, length: int, little: bool, signed: bool) -> Column:
    """A bit field of a 64-bit payload; byte 0 is the lowest byte of ``raw``."""
    if little:
        out = F.shiftrightunsigned(raw, start)
        out = out if length >= 64 else out.bitwiseAND(F.lit((1 << length) - 1))
    else:
        out, at = F.lit(0).cast("bigint"), start
        for _ in range(length):  # most significant bit first; after bit 0 of a byte comes bit 7 of the next
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftrightunsigned(raw, at).bitwiseAND(F.lit(1)))
            at = at + 15 if at % 8 == 0 else at - 1
    if signed and length < 64:
        out = F.when(F.shiftrightunsigned(out, length - 1) == 1, out - F.lit(1 << length)).otherwise(out)
    return out


def place(value: Column, start: int, length: int, little: bool) -> Column:
    """A value's lowest bits at their place in a 64-bit payload."""
    value = value.cast("bigint")
    if little:
        own = value if length >= 64 else value.bitwiseAND(F.lit((1 << length) - 1))
        return F.shiftleft(own, start)
    out, at = F.lit(0).cast("bigint"), start
    for k in range(length - 1, -1, -1):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(value, k).bitwiseAND(F.lit(1)), at))
        at = at + 15 if at % 8 == 0 else at - 1
    return out


# -- symbol tables: filters over arrays of a solution's parts


def wildcard(pattern: str) -> str:
    """A whole-name pattern in which only ``*`` is a wildcard, case ignored."""
    return "(?i)^" + ".*".join(re.escape(p) for p in pattern.split("*")) + "$"


_flat_classes = lambda s: F.flatten(F.transform(s["Projects"], lambda p: p["Classes"]))
_PART = {"Projects": lambda s: s["Projects"], "Classes": _flat_classes, "Methods": lambda s: F.flatten(F.transform(_flat_classes(s), lambda c: c["Methods"]))}
for _kind in ("Interfaces", "Enums", "Structs"):
    _PART[_kind] = lambda s, kind=_kind: F.flatten(F.transform(s["Projects"], lambda p: p[kind]))


def _part_filter(name: str, part: str, keep: Callable[..., Column]) -> None:
    ROW_FUNCTIONS[name.lower()] = lambda row, *args: F.filter(_PART[part](row), lambda x: keep(x, *args))
    LIBRARY.setdefault("csharp", set()).add(name)


for _part in ("Projects", "Classes", "Interfaces", "Enums", "Structs", "Methods"):
    _part_filter(f"Get{_part}ByNames", _part, lambda x, *names: x["Name"].isin([n.value for n in names]))
_part_filter("GetMethodsByPattern", "Methods", lambda x, p: x["Name"].rlike(wildcard(str(constant(p)))))
_part_filter("GetHighComplexityClasses", "Classes", lambda x, t: F.exists(x["Methods"], lambda m: m["CyclomaticComplexity"] >= column(t)))
_part_filter("GetHighComplexityMethods", "Methods", lambda x, t: x["CyclomaticComplexity"] >= column(t))
_part_filter("GetUndocumentedClasses", "Classes", lambda x: ~x["HasDocumentation"])
_part_filter("GetUndocumentedMethods", "Methods", lambda x: ~x["HasDocumentation"])
_part_filter("GetAsyncMethodsWithoutSuffix", "Methods", lambda x: x["IsAsync"] & ~x["Name"].endswith("Async"))
_part_filter("GetDeeplyNestedMethods", "Methods", lambda x, d: x["NestingDepth"] > column(d))
_part_filter("GetLowCohesionClasses", "Classes", lambda x, t: x["LackOfCohesion"] >= column(t))
_part_filter("GetMethodsWithUnusedParameters", "Methods", lambda x: x["UnusedParameterCount"] > 0)
_part_filter("GetMethodsWithUnusedVariables", "Methods", lambda x: x["UnusedVariableCount"] > 0)
_part_filter("GetClassesWithUnusedFields", "Classes", lambda x: x["UnusedFieldCount"] > 0)
for _part in ("Classes", "Interfaces", "Enums", "Structs"):
    _part_filter(f"GetUnused{_part}", _part, lambda x: x["ReferenceCount"] == 0)
_part_filter("FindImplementations", "Classes", lambda x, i: F.array_contains(x["Interfaces"], column(i)))


@row_function("csharp", "FindDerivedClasses")
def derived_classes(row, base):
    """Classes that derive from a class, named or given as a row, directly or through others."""
    name = F.coalesce(F.get_json_object(F.to_json(F.struct(base.alias("c"))), "$.c.Name"), F.get_json_object(F.to_json(F.struct(base.alias("c"))), "$.c"))
    below = lambda classes, names: F.filter(classes, lambda c: F.coalesce(F.arrays_overlap(c["BaseTypes"], names), F.lit(False)))
    grow = lambda classes: F.aggregate(classes, F.array(name), lambda names, _: F.array_distinct(F.concat(names, F.transform(below(classes, names), lambda c: c["Name"]))))
    classes = _flat_classes(row)
    return below(classes, grow(classes))


@row_function("csharp", "GetUnusedParameters")
def unused_parameters(row):
    return F.flatten(F.transform(_PART["Methods"](row), lambda m: F.filter(m["Parameters"], lambda p: ~p["IsUsed"])))


@row_function("csharp", "GetUnusedVariables")
def unused_variables(row):
    return F.flatten(F.transform(_PART["Methods"](row), lambda m: F.filter(m["Variables"], lambda v: ~v["IsUsed"])))


@row_function("csharp", "GetUnusedFields")
def unused_fields(row):
    return F.flatten(F.transform(_PART["Classes"](row), lambda c: F.filter(c["Fields"], lambda f: ~f["IsUsed"])))


@row_function("csharp", "FindReferences")
def find_references(row):
    return row["References"]


@row_function("csharp", "GetNugetPackages")
def packages(row, transitive):
    return F.filter(row["NugetPackages"], lambda p: transitive | ~F.coalesce(p["IsTransitive"], F.lit(False)))


# -- repositories


@row_function("git", "SearchForBranches")
def search_branches(row, pattern):
    return F.filter(row["Branches"], lambda b: F.rlike(b["FriendlyName"], pattern))


@row_function("git", "CommitFrom")
def commit_from(row, sha):
    return F.get(F.filter(row["Commits"], lambda c: c["Sha"] == sha), 0)


@row_function("git", "BranchFrom")
def branch_from(row, name):
    return F.get(F.filter(row["Branches"], lambda b: b["CanonicalName"] == name), 0)
