"""Queries through the sources and the functions of their rows, with SQL oracles.

What a source reads (files, archives, logs, repositories, saved service answers) is made
from the driver's tables first, in the shared folder, so that plain SQL over the tables
says what the source has to return.
"""

from __future__ import annotations

import io
import json
import os
import re
import subprocess
import tarfile
import zipfile
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import Engine
from .sources.schemas import COLUMNS
from .storage import put, scratch

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return wrap


def nations(spark: SparkSession, sf_dir: str) -> list[tuple[int, str, int]]:
    """The nation table: 25 rows that fixtures are made of."""
    return sorted(tuple(r) for r in spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name", "n_regionkey").collect())


# -- services: a saved answer for each table of columns


def _answer(kind: str, name: str, i: int):
    """A made-up value of a column (from the nation's key), the dialect text that reads it, and the SQL that says what it is."""
    text = lambda n: F.concat(F.lit(f"{name}_"), n.cast("string"))
    sql = f"'{name}_' || n_nationkey"
    if kind == "string":
        return text, "x.{c}", sql
    if kind == "boolean":
        return (lambda n: (n + i) % 2 == 0), "x.{c}", f"(n_nationkey + {i}) % 2 = 0"
    if kind == "timestamp":
        return (lambda n: F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(days=n)), "x.{c}", "timestamp '2024-01-01' + to_days(n_nationkey)"
    if kind.startswith("array"):
        return (lambda n: F.array(text(n), F.lit("x"))), "MakeFlat(x.{c})", f"{sql} || ', x'"
    if kind.startswith("map"):
        return (lambda n: F.create_map(F.lit("k"), text(n))), "x.{c}['k']", sql
    if kind.startswith("struct"):
        return (lambda n: F.struct(text(n).alias("Name"), F.lit("space").alias("Namespace"), F.create_map(F.lit("k"), text(n)).alias("Labels"))), "x.{c}.Labels['k']", sql
    if kind.startswith("interval"):
        return (lambda n: F.format_string("INTERVAL '%d 00:00:10' DAY TO SECOND", n)), "Cast_Seconds(x.{c})", "(n_nationkey * 86400 + 10)::bigint"
    return (lambda n: (n * (i + 1)).cast(kind)), "x.{c}", f"(n_nationkey * {i + 1})::{kind}"


def _fields(ddl: str) -> list[tuple[str, str]]:
    return [tuple(part.split(" ", 1)) for part in re.split(r", (?![^<]*>)", ddl)]


def _service(schema: str, method: str, ddl: str, args: tuple[str, ...], keep: str = "true", name: str = "") -> None:
    fields = _fields(ddl)
    parts = [_answer(kind, column, i) for i, (column, kind) in enumerate(fields)]
    reads = ", ".join(f"{read.format(c=column)} as c{i}" for i, ((column, _), (_, read, _)) in enumerate(zip(fields, parts)))
    text = f"select {reads} from #{schema}.{method}({', '.join(map(repr, args))}) x"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch(spark, "snapshots")
        rows = spark.read.parquet(f"{sf_dir}/nation.parquet").select(*[value(F.col("n_nationkey")).alias(column) for (column, _), (value, _, _) in zip(fields, parts)])
        rows.write.option("ignoreNullFields", False).json(f"{folder}/{schema}/{method}.json")
        return Engine(spark, snapshots=folder).sql(text)

    key = name or f"service_{schema}_{method}"
    QUERIES[key] = run
    ORACLES[key] = f"select {', '.join(f'{sql} as c{i}' for i, (_, _, sql) in enumerate(parts))} from nation where {keep}"


_REPO = ("RepositoryOwner_7", "RepositoryName_7")
_ARGS = {
    "github.issues": ("o", "r"), "github.pullrequests": ("o", "r"), "github.commits": ("o", "r"), "github.releases": ("o", "r"), "github.branches": _REPO,
    "jira.issues": ("ProjectKey_3",), "jira.comments": ("IssueKey_4",), "kubernetes.podlogs": ("Name_5", "ContainerName_5", "Namespace_5"),
}
_KEEP = {"github.branches": "n_nationkey = 7", "jira.issues": "n_nationkey = 3", "jira.comments": "n_nationkey = 4", "kubernetes.podlogs": "n_nationkey = 5"}
for _key, _ddl in COLUMNS.items():
    _schema, _method = _key.split(".")
    _service(_schema, _method, _ddl, _ARGS.get(_key, ()), _KEEP.get(_key, "true"))
_service("github", "repositories", COLUMNS["github.repositories"], ("OwnerLogin_6",), "n_nationkey = 6", "service_github_repositories_owner")
_service("github", "commits", COLUMNS["github.commits"], ("o", "r", "Sha_9"), "n_nationkey = 9", "service_github_commits_sha")
_service("github", "branchcommits", COLUMNS["github.commits"], ("o", "r", "main", "work"))
_service("jira", "issues", COLUMNS["jira.issues"], ("status = Open",), "true", "service_jira_issues_jql")
_service("kubernetes", "secrets", "Namespace string, Name string, Type string, Age timestamp", ())
_service("kubernetes", "events", COLUMNS["kubernetes.events"], ("space",), "true", "service_kubernetes_events_namespace")
_service("airtable", "records", "Id string, Name string, Tags array<string>", ("tasks",))


def _issues(method: str, arguments: list, filters: list, page: int):
    """A stand-in for an issue tracker's client: it answers with what it was asked."""
    yield {"Key": f"P-{page}", "Summary": arguments[0], "Status": "Open"}
    yield {"Key": f"P-{page + 10}", "Summary": arguments[0], "Status": "Done"}


@query("select 'P-0' as key, 'project = \"P\" AND status = \"Open\"' as asked")
def client_pushdown(spark, sf_dir):
    """Filters reach a client as query text, and hold even where it ignores them."""
    return Engine(spark, clients={"jira": _issues}).sql("select Key as key, Summary as asked from #jira.issues('P') where Status = 'Open'")


# -- functions of issue and cluster rows


@query(
    "select o_orderkey as k, o_orderkey % 3 = 0 as labelled, o_orderkey % 2 = 0 as component, true as fixed, o_orderkey % 5 = 0 as subtask, o_orderkey % 7 <> 0 and o_orderdate < timestamp '1996-06-01' as overdue, "
    "(date_diff('day', o_orderdate, timestamp '2000-01-01'))::int as age, 3 as taken, 'v' || o_orderkey as custom from orders"
)
def issue_rows(spark, sf_dir):
    folder = scratch(spark, "snapshots")
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        k.cast("string").alias("Id"), F.when(k % 3 == 0, F.lit("red, Blue")).otherwise("red").alias("Labels"), F.when(k % 2 == 0, F.lit("core")).otherwise("").alias("Components"), F.lit("1.0, 2.0").alias("FixVersions"),
        F.when(k % 5 == 0, F.lit("P-1")).alias("ParentKey"), F.when(k % 7 == 0, F.lit("Fixed")).alias("Resolution"), day.alias("DueDate"), day.alias("CreatedAt"), (day + F.expr("interval 3 days 5 hours")).alias("ResolvedAt"),
        F.create_map(F.lit("team"), F.concat(F.lit("v"), k.cast("string"))).alias("CustomFields"), F.lit("P").alias("ProjectKey"),
    ).write.json(f"{folder}/jira/issues.json")
    return Engine(spark, snapshots=folder).sql(
        "select ToInt64(i.Id) as k, i.HasLabel('blue') as labelled, i.HasComponent('core') as component, i.HasFixVersion('2.0') as fixed, i.IsSubtask() as subtask, i.IsOverdue(ToDateTimeOffset('06/01/1996')) as overdue, "
        "i.GetAgeInDays(ToDateTimeOffset('01/01/2000')) as age, i.GetTimeToResolutionDays() as taken, i.GetCustomField('team') as custom from #jira.issues('P') i"
    )


@query("select n_nationkey as k, 'app' || n_nationkey as app, case when n_nationkey % 2 = 0 then 'x' else 'none' end as tier from nation")
def pod_labels(spark, sf_dir):
    folder = scratch(spark, "snapshots")
    n = F.col("n_nationkey")
    labels = F.when(n % 2 == 0, F.create_map(F.lit("app"), F.concat(F.lit("app"), n.cast("string")), F.lit("tier"), F.lit("x"))).otherwise(F.create_map(F.lit("app"), F.concat(F.lit("app"), n.cast("string"))))
    spark.read.parquet(f"{sf_dir}/nation.parquet").select(n.cast("string").alias("Name"), F.struct(labels.alias("Labels")).alias("Metadata")).write.json(f"{folder}/kubernetes/pods.json")
    return Engine(spark, snapshots=folder).sql("select ToInt32(p.Name) as k, p.GetLabelOrDefault('app') as app, Coalesce(p.GetLabelOrDefault('tier'), 'none') as tier from #kubernetes.pods() p")


# -- models, by a client that answers from the prompt


def _echo(settings: dict, prompt: str) -> str:
    task, _, text = prompt.partition("\n")
    if task == "sentiment":
        return "Positive." if "1" in text else "negative" if "2" in text else "no idea"
    if task.startswith("about "):
        return "Yes" if task[6:].lower() in text.lower() else "no"
    if task == "entities":
        return json.dumps({"entities": [text, "x"]})
    if task.startswith("applies"):
        return json.dumps({"result": "true" if task.split()[1] in text else "false"})
    if text.endswith("_13"):
        raise RuntimeError("no answer")
    return f"{task}: {text}"


_MOOD = "case when contains(n_name, '1') then 'POSITIVE' when contains(n_name, '2') then 'NEGATIVE' else 'UNKNOWN' end"
_SAID = "case when ends_with(n_name, '_13') then null else '{task}: ' || n_name end"
_MODEL_SQL = (
    f"select n_nationkey as k, {_MOOD} as mood, contains(lower(n_name), '_1') as about, {_SAID.format(task='summarize')} as summary, {_SAID.format(task='translate en to pl')} as translated, lower(n_name) || ', x' as named, "
    f"{_SAID.format(task='describe image')} as picture, {_SAID.format(task='image what')} as asked, contains(n_name, '_2') as applies, {_SAID.format(task='do')} as done, 1 as t1, 1 as t2 from nation"
)
_MODEL = (
    "select n.n_nationkey as k, m.Sentiment(n.n_name) as mood, m.IsContentAbout(n.n_name, '_1') as about, m.SummarizeContent(n.n_name) as summary, m.TranslateContent(n.n_name, 'en', 'pl') as translated, MakeFlat(m.Entities(n.n_name)) as named, "
    "m.DescribeImage(n.n_name) as picture, m.AskImage('what', n.n_name) as asked, m.IsQuestionApplicableToImage('_2', n.n_name) as applies, m.LlmPerform('do', n.n_name) as done, m.CountTokens('a') as t1, m.CountTokens('byte_bpe_multi_50k', 'a') as t2 "
    "from {source} m inner join #tables.nation() n on m.Model is not null"
)
for _name, _source in (("openai", "#openai.gpt('small')"), ("ollama", "#ollama.llm('small', 0.5)")):
    QUERIES[f"model_functions_{_name}"] = lambda spark, sf_dir, text=_MODEL.format(source=_source): Engine(spark, tables=sf_dir, llm_client=_echo).sql(text)
    ORACLES[f"model_functions_{_name}"] = _MODEL_SQL
_SETTINGS = ("Model", "MaxTokens", "Temperature", "FrequencyPenalty", "PresencePenalty")
_GIVEN = ("'m'", "100", "0.5", "0.1", "0.2")
_SELECT = "coalesce(x.Model, '-') || '|' || coalesce(x.MaxTokens, '-') || '|' || coalesce(x.Temperature, '-') || '|' || coalesce(x.FrequencyPenalty, '-') || '|' || coalesce(x.PresencePenalty, '-')"


def _settings(name: str, source: str, expected: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: Engine(spark, llm_client=_echo).sql(f"select {_SELECT} as settings from {source} x")
    ORACLES[name] = f"select '{expected}' as settings"


for _k in range(6):
    _settings(f"model_openai_{_k}", f"#openai.gpt({', '.join(_GIVEN[:_k])})", "|".join([v.strip("'") for v in _GIVEN[:_k]] + ["-"] * (5 - _k)))
_settings("model_ollama_1", "#ollama.llm('m')", "m|-|-|-|-")
_settings("model_ollama_2", "#ollama.llm('m', 0.5)", "m|0.5|-|-|-")


# -- files and directories

EXTENSIONS = (".txt", ".zip", ".tar", ".mp3", ".epub", ".docx", ".png", ".py", ".mp4")
_EXT = f"list_value({', '.join(map(repr, EXTENSIONS))})[n_nationkey % {len(EXTENSIONS)} + 1]"
_FILE = f"(select *, 'nation_' || n_nationkey || {_EXT} as file, {_EXT} as ext, 'r' || n_regionkey as folder, n_name || chr(10) || chr(10) || 'line ' || n_nationkey || chr(10) as body from nation)"


def _tree(spark: SparkSession, sf_dir: str, changed: bool = False) -> str:
    """A folder for each region, a file for each nation; the changed copy lacks some, has others and edits some."""
    root = scratch(spark, "tree")
    for k, name, region in nations(spark, sf_dir):
        body = f"{name}\n\nline {k}\n"
        if changed and k % 5 == 0:
            continue
        put(spark, f"{root}/r{region}/nation_{k}{EXTENSIONS[k % len(EXTENSIONS)]}", body.upper() if changed and k % 3 == 0 else body)
        if changed and k % 4 == 0:
            put(spark, f"{root}/r{region}/new_{k}.txt", body)
    return root


@query(
    "select file as name, folder as dir, ext, length(body)::bigint as len, sha1(body) as s1, sha256(body) as s2, md5(body) as m, to_base64(encode(body)) as b, 3::bigint as lines, 2::bigint as filled, body as txt, hex(encode(body)[1:3]) as head, "
    "hex(encode(body)[-2:]) as tail, hex(encode(body)[3:5]) as bytes, hex(encode(body)) as raw, contains(body, 'line 1') as has, case when contains(body, '_1') then '(1)' else '()' end as word, 0::bigint as kb, length(body)::bigint as l2, '/' || folder || '/' || file as rel, "
    "folder as sub, true as flag, false as meta, '[]' as tags, file as again from " + _FILE
)
def os_files(spark, sf_dir):
    root = _tree(spark, sf_dir)
    return Engine(spark).sql(
        "select f.Name as name, f.DirectoryName as dir, f.Extension as ext, f.Length as len, f.Sha1File() as s1, f.Sha256File() as s2, f.Md5File() as m, f.Base64File() as b, f.CountOfLines() as lines, f.CountOfNotEmptyLines() as filled, f.GetFileContent() as txt, "
        "ToHex(f.Head(3)) as head, ToHex(f.Tail(2)) as tail, ToHex(f.GetFileBytes(3, 2)) as bytes, ToHex(f.GetContent()) as raw, f.HasContent('line 1') as has, f.GetLinesContainingWord('_1') as word, f.GetFileLength('kb') as kb, f.GetLengthOfFile('b') as l2, "
        f"f.GetRelativePath() as rel, f.RelativeSubPath(0) as sub, f.HasAttribute(128) as flag, f.HasMetadataTag('Make') as meta, f.AllMetadataJson() as tags, f.GetExtendedFileInfo().Name as again from #os.files('{root}', true) f"
    )


_CLASSES = {"IsZipArchive": (".zip",), "IsArchive": (".zip", ".tar"), "IsAudio": (".mp3",), "IsBook": (".epub",), "IsDoc": (".docx",), "IsImage": (".png",), "IsSource": (".py",), "IsVideo": (".mp4",)}
_OF = {f: f"ext in ({', '.join(map(repr, e))})" for f, e in _CLASSES.items()}


@query(f"select file as name, {', '.join(f'{sql} as {f}_row, {sql} as {f}_ext' for f, sql in _OF.items())} from {_FILE}")
def os_file_classes(spark, sf_dir):
    both = ", ".join(f"f.{name}() as {name}_row, {name}(f.Extension) as {name}_ext" for name in _CLASSES)
    return Engine(spark).sql(f"select f.Name as name, {both} from #disk.files('{_tree(spark, sf_dir)}', true) f")


@query(f"select file as name, (len(string_split(path, '/')) - 1)::int as depth, '/' || file as below from (select *, folder || '/' || file as path from {_FILE})")
def os_paths(spark, sf_dir):
    """Paths relative to a given base, and leading parts of a row's directory."""
    root = _tree(spark, sf_dir)
    bare = re.sub(r"^file:(//)?", "", root)
    return Engine(spark).sql(f"select f.Name as name, Length(Split(f.RelativeSubPath(9), '/')) - 1 as depth, f.GetRelativePath(Combine('{bare}', f.DirectoryName)) as below from #os.files('{root}', true) f where f.SubPath(0) = ''")


@query("select distinct 'r' || n_regionkey as name, '' as top, true as directory, true as there from nation")
def os_directories(spark, sf_dir):
    return Engine(spark).sql(f"select d.Name as name, d.SubPath(0) as top, d.HasAttribute(16) as directory, d.Exists as there from #os.directories('{_tree(spark, sf_dir)}', true) d")


@query(f"select folder as dir, file as name, length(body)::bigint as len from {_FILE}")
def apply_files(spark, sf_dir):
    """A source applied to the rows of another: the files of each directory."""
    return Engine(spark).sql(f"select d.Name as dir, f.Name as name, f.Length as len from #os.directories('{_tree(spark, sf_dir)}', false) d cross apply #os.files(d.FullName, false) f")


@query(f"select file as name, ls[i] as line, i::int as number from (select file, string_split(rtrim(body, chr(10)), chr(10)) as ls from {_FILE} where ext = '.txt'), unnest(range(1, len(ls) + 1)) as u(i)")
def apply_flat_lines(spark, sf_dir):
    return Engine(spark).sql(f"select f.Name as name, l.Line as line, l.LineNumber as number from #os.files('{_tree(spark, sf_dir)}', true) f cross apply #flat.file(f.FullPath) l where f.Extension = '.txt'")


@query(
    f"select coalesce(a.p, b.p) as path, case when b.p is null then 'Removed' when a.body = b.body then 'TheSame' else 'Modified' end as state from (select '/' || folder || '/' || file as p, body from {_FILE}) a "
    f"left join (select '/' || folder || '/' || file as p, case when n_nationkey % 3 = 0 then upper(body) else body end as body from {_FILE} where n_nationkey % 5 <> 0) b on a.p = b.p "
    f"union all select '/' || folder || '/new_' || n_nationkey || '.txt', 'Added' from {_FILE} where n_nationkey % 4 = 0 and n_nationkey % 5 <> 0"
)
def os_dirscompare(spark, sf_dir):
    return Engine(spark).sql(f"select Coalesce(SourceFileRelative, DestinationFileRelative) as path, State as state from #os.dirscompare('{_tree(spark, sf_dir)}', '{_tree(spark, sf_dir, changed=True)}')")


@query("select 'r' || n_regionkey as dir, count(*)::int as n, true as same from nation group by 1")
def aggregate_rows(spark, sf_dir):
    root = _tree(spark, sf_dir)
    return Engine(spark).sql(f"select f.DirectoryName as dir, Length(AggregateFiles()) as n, Length(AggregateFiles()) = Count(f.Name) as same from #os.files('{root}', true) f group by f.DirectoryName")


@query("select count(distinct n_regionkey)::int as n from nation")
def aggregate_directories(spark, sf_dir):
    return Engine(spark).sql(f"select Length(AggregateDirectories()) as n from #os.directories('{_tree(spark, sf_dir)}', true) d group by 'all'")


@query("select 'nation_' || n_nationkey || '.dll' as name, true as none from nation where n_nationkey < 5")
def os_dlls(spark, sf_dir):
    root = scratch(spark, "dlls")
    for k, name, _ in nations(spark, sf_dir):
        put(spark, f"{root}/nation_{k}{'.dll' if k < 5 else '.txt'}", name)
    return Engine(spark).sql(f"select d.FileInfo.Name as name, d.Version is null as none from #os.dlls('{root}') d")


@query("select true as own, true as named")
def os_processes(spark, sf_dir):
    """The driver's own process is listed."""
    return Engine(spark).sql(f"select p.Responding as own, p.ProcessName is not null as named from #os.processes() p where p.Id = {os.getpid()}")


@query("select 'single' as a, 'single' as b from range(1)")
def os_single(spark, sf_dir):
    return Engine(spark).sql("select a.Dummy as a, b.Dummy as b from #os.single() a inner join #system.dual() b on a.Dummy = b.Dummy")


@query("select n_nationkey as k, length(n_name)::bigint as len, true as none from nation")
def file_info(spark, sf_dir):
    root = scratch(spark, "info")
    for k, name, _ in nations(spark, sf_dir):
        put(spark, f"{root}/f{k}.txt", name)
    bare = re.sub(r"^file:(//)?", "", root)
    return Engine(spark, tables=sf_dir).sql(f"select n.n_nationkey as k, GetFileInfo(Combine('{bare}', 'f' || ToString(n.n_nationkey) || '.txt')).Length as len, GetFileInfo('/nowhere') is null as none from #tables.nation() n")


# -- media tags


def _png(width: int, height: int) -> bytes:
    chunk = lambda kind, data: len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", width.to_bytes(4, "big") + height.to_bytes(4, "big") + b"\x08\x00\x00\x00\x00") + chunk(b"IEND", b"")


def _jpeg(width: int, height: int, make: str) -> bytes:
    """A picture's header with its size and one text tag of exposure data."""
    text = make.encode() + b"\0"
    tiff = b"II*\0\x08\0\0\0" + b"\x02\0" + b"\x0f\x01\x02\0" + len(text).to_bytes(4, "little") + (38).to_bytes(4, "little") + b"\x12\x01\x03\0\x01\0\0\0\x06\0\0\0" + b"\0\0\0\0" + text
    body = b"Exif\0\0" + tiff
    frame = b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + b"\x01\x01\x11\0"
    return b"\xff\xd8\xff\xe1" + (len(body) + 2).to_bytes(2, "big") + body + b"\xff\xc0" + (len(frame) + 2).to_bytes(2, "big") + frame + b"\xff\xd9"


def _pictures(spark: SparkSession, sf_dir: str) -> str:
    root = scratch(spark, "pictures")
    for k, name, _ in nations(spark, sf_dir):
        put(spark, f"{root}/p{k}.{'png' if k % 2 else 'jpg'}", _png(k + 1, 2 * k + 1) if k % 2 else _jpeg(k + 1, 2 * k + 1, name))
    put(spark, f"{root}/broken.jpg", b"\xff\xd8\xff\xe1\x00\x20Exif\0\0II*\0\xff\xff\xff\x7f")
    return root


_TAGS = (
    "select k, dir, tag, value from (select n_nationkey as k, n_name, n_nationkey % 2 = 1 as png from nation), lateral (select * from (values "
    "(true, 'PNG-IHDR', 'Image Width', (k + 1)::varchar), (true, 'PNG-IHDR', 'Image Height', (2 * k + 1)::varchar), (true, 'PNG-IHDR', 'Bits Per Sample', '8'), (false, 'JPEG', 'Image Width', (k + 1)::varchar), (false, 'JPEG', 'Image Height', (2 * k + 1)::varchar), "
    "(false, 'Exif IFD0', 'Make', n_name), (false, 'Exif IFD0', 'Orientation', '6')) as t(of, dir, tag, value) where t.of = png)"
)
for _name, _tail in (("os_metadata", ""), ("os_metadata_lenient", ", false"), ("os_metadata_below", ", true, false")):
    ORACLES[_name] = _TAGS
    QUERIES[_name] = lambda spark, sf_dir, tail=_tail: Engine(spark).sql(
        f"select ToInt32(Skip(GetFileNameWithoutExtension(m.FullName), 1)) as k, m.DirectoryName as dir, m.TagName as tag, m.Description as value from #os.metadata('{_pictures(spark, sf_dir)}'{tail}) m where m.FullName not like '%broken%'"
    )


@query(
    "select n_nationkey as k, (n_nationkey + 1)::varchar as width, case when n_nationkey % 2 = 0 then n_name end as make, n_nationkey % 2 = 0 as exif, n_nationkey % 2 = 0 as oriented, n_nationkey % 2 = 1 as deep, "
    "case when n_nationkey % 2 = 1 then 'PNG-IHDR' else 'Exif IFD0' end as first from nation"
)
def file_metadata(spark, sf_dir):
    return Engine(spark).sql(
        "select ToInt32(Skip(GetFileNameWithoutExtension(f.Name), 1)) as k, f.GetMetadata('Image Width') as width, f.GetMetadata('Exif IFD0', 'Make') as make, f.HasMetadataDirectory('Exif IFD0') as exif, f.HasMetadataTag('Orientation') as oriented, "
        f"f.HasMetadataTag('PNG-IHDR', 'Bits Per Sample') as deep, get_json_object(f.AllMetadataJson(), '$[0].Directory') as first from #os.files('{_pictures(spark, sf_dir)}', false) f where f.Name <> 'broken.jpg'"
    )


# -- archives


def _packed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    zipped, tarred = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(zipped, "w", zipfile.ZIP_DEFLATED) as z, tarfile.open(fileobj=tarred, mode="w") as t:
        for k, name, region in nations(spark, sf_dir):
            z.writestr(f"r{region}/n{k}.txt", name)
            entry = tarfile.TarInfo(f"r{region}/n{k}.txt")
            entry.size = len(name.encode())
            t.addfile(entry, io.BytesIO(name.encode()))
    root = scratch(spark, "archives")
    return put(spark, f"{root}/a.zip", zipped.getvalue()), put(spark, f"{root}/a.tar", tarred.getvalue())


_ENTRY = "select 'r' || n_regionkey || '/n' || n_nationkey || '.txt' as key, length(n_name)::bigint as size, n_name as txt, hex(n_name) as raw, hex(n_name) as stream, false as dir from nation"
for _name, _at in (("archives_zip", 0), ("archives_tar", 1)):
    ORACLES[_name] = _ENTRY
    QUERIES[_name] = lambda spark, sf_dir, at=_at: Engine(spark).sql(f"select a.Key as key, a.Size as size, a.GetTextContent() as txt, ToHex(a.GetContent()) as raw, ToHex(a.GetStreamContent()) as stream, a.IsDirectory as dir from #archives.file('{_packed(spark, sf_dir)[at]}') a")


@query("select 'n' || n_nationkey || '.txt' as name, 'r' || n_regionkey || '/n' || n_nationkey || '.txt' as path, length(n_name)::bigint as len, 1 as level, n_name as txt from nation")
def os_zip(spark, sf_dir):
    return Engine(spark).sql(f"select z.Name as name, z.FullName as path, z.Length as len, z.Level as level, z.GetTextContent() as txt from #os.zip('{_packed(spark, sf_dir)[0]}') z")


# -- texts: flat, delimited, JSON


@query("select i::int as number, case when i % 3 = 0 then '' else 'event ' || i end as line from range(1, (select count(*) + 1 from events)) as t(i)")
def flat_file(spark, sf_dir):
    """A large file in several splits, with empty lines."""
    folder = scratch(spark, "flat")
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    i = F.col("id")
    spark.range(1, n + 1, 1, 1).select(F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("event "), i.cast("string"))).alias("value")).write.text(folder)
    return Engine(spark).sql(f"select f.LineNumber as number, f.Line as line from #flat.file('{folder}') f")


_CELL = "case when n_nationkey % 4 = 0 then null else n_name || chr(10) || 'second \"line\", ' || n_nationkey end"


def _quoted(spark: SparkSession, sf_dir: str, separator: str, lead: str = "") -> str:
    rows = [f'{k}{separator}{"" if k % 4 == 0 else chr(34) + name + chr(10) + "second " + chr(34) * 2 + "line" + chr(34) * 2 + ", " + str(k) + chr(34)}{separator}{region}' for k, name, region in nations(spark, sf_dir)]
    return put(spark, scratch(spark, "quoted") + ".csv", lead + "\n".join([f"nation key{separator}name{separator}region", *rows]) + "\n")


for _name, _method, _separator in (("csv_quoted", "comma", ","), ("tab_quoted", "tab", "\t"), ("semicolon_quoted", "semicolon", ";")):
    ORACLES[_name] = f"select n_nationkey::varchar as k, {_CELL} as cell, n_regionkey::varchar as region from nation"
    QUERIES[_name] = lambda spark, sf_dir, method=_method, separator=_separator: Engine(spark).sql(f"select s.nation_Key as k, s.name as cell, s.region as region from #separatedvalues.{method}('{_quoted(spark, sf_dir, separator)}', true, 0) s".replace("nation_Key", "nationkey"))


@query(f"select n_nationkey::bigint as k, {_CELL} as cell, n_regionkey as region from nation")
def csv_quoted_skipped(spark, sf_dir):
    """Leading lines, quoted line breaks and declared types together."""
    path = _quoted(spark, sf_dir, ",", "junk\nmore junk\n")
    return Engine(spark).sql(f"table T {{ nationkey: long, name: string, region: int }}; couple #separatedvalues.comma with table T as A; select nationkey as k, name as cell, region as region from A('{path}', true, 2)")


@query("select n_nationkey::varchar as k, n_name as name from nation union all select r_regionkey::varchar, r_name from region")
def csv_of_paths(spark, sf_dir):
    """Several files, named by a common table of paths; each header says where a column is."""
    root = scratch(spark, "paths")
    put(spark, f"{root}/a.csv", "\n".join(["k,name", *(f"{k},{name}" for k, name, _ in nations(spark, sf_dir))]))
    put(spark, f"{root}/b.csv", "\n".join(["name,k", *(f"{r[1]},{r[0]}" for r in spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", "r_name").collect())]))
    return Engine(spark).sql(f"with paths as (select f.FullPath as path from #os.files('{root}', false) f) select s.k as k, s.name as name from #separatedvalues.comma(paths, true, 0) s")


@query("select n_nationkey::bigint as k, n_name as name from nation")
def csv_in_archive(spark, sf_dir):
    """Delimited bytes of an archive's entry, applied to its row."""
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("n.csv", "\n".join(["k,name", *(f"{k},{name}" for k, name, _ in nations(spark, sf_dir))]))
    path = put(spark, scratch(spark, "archive") + ".zip", packed.getvalue())
    return Engine(spark).sql(f"table T {{ k: long, name: string }}; couple #separatedvalues.comma with table T as A; select b.k as k, b.name as name from #archives.file('{path}') a cross apply A(a.GetStreamContent(), true, 0) b")


@query("select n_nationkey::bigint as k, n_name as name, 2::int as n, 'a, b' as flat from nation")
def json_with_schema(spark, sf_dir):
    root = scratch(spark, "json")
    data = put(spark, f"{root}/d.json", json.dumps([{"Key": k, "Name": name, "Tags": ["a", "b"]} for k, name, _ in nations(spark, sf_dir)] + [5, None]))
    schema = put(spark, f"{root}/s.json", json.dumps({"Key": "long", "Name": "string", "Tags": ["string"]}))
    return Engine(spark).sql(f"select j.Key as k, j.Name as name, Length(j.Tags) as n, MakeFlat(j.Tags) as flat from #json.file('{data}', '{schema}') j where j.Key is not null")


@query("select conv_id, turn, list_slice(w, 3, len(w)) as rest, w[1:2] as head, w[2:3] as mid from (select conv_id, turn, string_split(text, ' ') as w from conversations)")
def array_parts(spark, sf_dir):
    return Engine(spark, tables=sf_dir).sql("select c.conv_id as conv_id, c.turn as turn, Skip(Split(c.text, ' '), 2) as rest, Take(Split(c.text, ' '), 2) as head, SkipAndTake(Split(c.text, ' '), 1, 2) as mid from #tables.conversations() c")


@query("select range as v, range + 1 as n from range(0, 1000) where (range + 1) % 2 = 0")
def row_number_filter(spark, sf_dir):
    return Engine(spark).sql("select Value as v, RowNumber() as n from #system.range(0, 1000) where RowNumber() % 2 = 0")


# -- vehicle bus

DBC = """VERSION ""

BU_: ECU

BO_ 292 Engine: 8 ECU
 SG_ Speed : 0|16@1+ (0.5,10) [0|100] "km/h" ECU
 SG_ Temp : 16|8@1- (1,-40) [-40|80] "C" ECU

BO_ 293 Exhaust: 8 ECU
 SG_ Gas : 7|16@0+ (1,0) [0|65535] "ppm" ECU

CM_ SG_ 292 Speed "how fast";
BA_ "GenMsgCycleTime" BO_ 292 100;
VAL_ 293 Gas 0 "none" 1 "some" ;
"""


def _dbc(spark: SparkSession) -> str:
    return put(spark, scratch(spark, "bus") + ".dbc", DBC)


@query("select * from (values (292::bigint, 'Engine', 8, 100, 2), (293, 'Exhaust', 8, 0, 1)) as t(id, name, dlc, cycle, signals)")
def can_messages(spark, sf_dir):
    return Engine(spark).sql(f"select m.Id as id, m.Name as name, m.DLC as dlc, m.CycleTime as cycle, Length(m.Signals) as signals from #can.messages('{_dbc(spark)}') m")


@query("select * from (values ('Engine', 'Speed', 0, 16, 0.5::double, 10.0::double, 'km/h', 'how fast', null), ('Engine', 'Temp', 16, 8, 1.0, -40.0, 'C', null, null), ('Exhaust', 'Gas', 7, 16, 1.0, 0.0, 'ppm', null, 'some')) as t(message, name, start, length, factor, shift, unit, about, one)")
def can_signals(spark, sf_dir):
    return Engine(spark).sql(f"select s.MessageName as message, s.Name as name, s.StartBit as start, s.Length as length, s.Factor as factor, s.Offset as shift, s.Unit as unit, s.Comment as about, s.ValueMap[1].Name as one from #can.signals('{_dbc(spark)}') s")


_FRAME = (
    "(select event_id, 292 + event_id % 3 as id, event_id % 65536 as low, (user_id % 256) as mid from events)"
)
_SIGNED = "case when mid >= 128 then mid - 256 else mid end"


def _log(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Frames of three identifiers, one of them unknown; identifiers in a base, payloads in hexadecimal."""
    folder = scratch(spark, "frames")
    e, u = F.col("event_id"), F.col("user_id")
    number = F.lit(292) + e % 3
    digits = {"dec": number.cast("string"), "hex": F.concat(F.lit("0x"), F.hex(number)), "bin": F.conv(number.cast("string"), 10, 2)}[kind]
    spark.read.parquet(f"{sf_dir}/events.parquet").select(e.cast("string").alias("Timestamp"), digits.alias("ID"), F.concat(F.lit("0x"), F.hex(e % 65536 + F.shiftleft(u % 256, 16))).alias("Data")).write.option("header", True).csv(folder)
    return folder


for _kind in ("dec", "hex", "bin"):
    ORACLES[f"can_frames_{_kind}"] = f"select event_id::decimal(20,0) as t, id::bigint as id, id <> 294 as known, case when id = 292 then low * 0.5 + 10 end::double as speed, case when id = 292 then {_SIGNED} - 40 end::double as temp, case when id = 293 then (low % 256) * 256 + low // 256 end::double as gas, case when id = 294 then id end::bigint as stranger from {_FRAME}"
    QUERIES[f"can_frames_{_kind}"] = lambda spark, sf_dir, kind=_kind: Engine(spark).sql(
        f"select f.Timestamp as t, f.ID as id, f.IsWellKnown as known, f.Engine.Speed as speed, f.Engine.Temp as temp, f.Exhaust.Gas as gas, f.UnknownMessage.Id as stranger from #can.separatedvalues('{_log(spark, sf_dir, kind)}', '{_dbc(spark)}', '{kind}') f"
    )


@query(
    f"select event_id::decimal(20,0) as t, low::bigint as speed, (mid << 16)::bigint as temp, ((low % 256) * 256 + low // 256)::bigint as gas, (low + (mid << 16))::bigint as whole, (low * 0.5 + 10)::double as back, "
    f"make_timestamp(event_id * 1000) as at from {_FRAME}"
)
def can_functions(spark, sf_dir):
    """Values placed in and read from payloads, one by one and as one text of a message's signals."""
    folder = scratch(spark, "values")
    e, u = F.col("event_id"), F.col("user_id") % 256
    temp = F.when(u >= 128, u - 256).otherwise(u) - 40
    low = e % 65536
    spark.read.parquet(f"{sf_dir}/events.parquet").select(e.cast("string").alias("Timestamp"), F.lit("292").alias("ID"), low.cast("string").alias("Data"), (low * 0.5 + 10).cast("string").alias("Speed"), temp.cast("string").alias("Temp")).write.parquet(f"{folder}/values.parquet")
    dbc = _dbc(spark)
    log = put(spark, scratch(spark, "one") + ".csv", "Timestamp,ID,Data\n1,292,0x0\n")
    return Engine(spark, tables=folder).sql(
        "select ToDecimal20(v.Timestamp) as t, c.EncodeMessage('Speed', ToDouble(v.Speed)) as speed, c.EncodeMessage('Temp', ToDouble(v.Temp)) as temp, c.EncodeMessage('Gas', ToDouble(v.Data)) as gas, "
        "c.EncodeMessage('{\"Speed\": ' || v.Speed || ', \"Temp\": ' || v.Temp || '}') as whole, c.DecodeMessage('Speed', ToInt64(v.Data)) as back, FromTimestamp(ToInt64(v.Timestamp), 'ms') as at "
        f"from #can.separatedvalues('{log}', '{dbc}') c inner join #tables.values() v on c.ID = 292"
    )


# -- symbol tables


def _solution(spark: SparkSession, sf_dir: str) -> str:
    """One class for each nation in a project for each region; counts come from the keys."""
    folder = scratch(spark, "snapshots")
    projects: dict[int, dict] = {}
    for k, name, region in nations(spark, sf_dir):
        of = projects.setdefault(region, {"Id": f"p{region}", "Name": f"P{region}", "Classes": [], "Interfaces": [], "Enums": [], "Structs": [], "NugetPackages": [{"Id": f"own{region}", "IsTransitive": False}, {"Id": f"far{region}", "IsTransitive": True}]})
        place = [{"Document": f"d{k}", "StartLine": k, "StartColumn": 0, "EndLine": k, "EndColumn": 9}]
        method = {"Name": f"Run{k}" + ("Async" if k % 4 == 0 else ""), "HasDocumentation": k % 2 == 0, "ReferenceCount": k % 3, "IsAsync": k % 2 == 0, "CyclomaticComplexity": k, "NestingDepth": k % 6, "UnusedParameterCount": k % 2, "UnusedVariableCount": k % 3, "Parameters": [{"Name": f"a{k}", "Type": "int", "IsUsed": k % 2 == 0}], "Variables": [{"Name": f"v{k}", "Type": "int", "IsUsed": k % 3 == 0}], "References": place, "ReturnType": f"T{k}", "Body": {"Lines": k, "Calls": [{"Name": f"c{k}"}]}}
        of["Classes"].append({"Name": name, "HasDocumentation": k % 3 == 0, "ReferenceCount": k % 2, "BaseTypes": [f"NATION_{k // 2}"] if k else [], "Interfaces": [f"I{k % 4}"], "LackOfCohesion": k / 10, "UnusedFieldCount": k % 5, "Fields": [{"Name": f"f{k}", "Type": "int", "IsUsed": k % 5 == 0}], "Methods": [method], "References": place})
        for kind, letter in (("Interfaces", "I"), ("Enums", "E"), ("Structs", "S")):
            of[kind].append({"Name": f"{letter}{k}", "HasDocumentation": True, "ReferenceCount": k % 2, "References": place})
    put(spark, f"{folder}/csharp/solution.json", json.dumps({"Id": "s", "Projects": list(projects.values())}))
    return folder


def _symbols(name: str, apply: str, expected: str, value: str = "x.Name") -> None:
    QUERIES[name] = lambda spark, sf_dir: Engine(spark, snapshots=_solution(spark, sf_dir)).sql(f"select {value} as name from #csharp.solution('s.sln') s {apply}")
    ORACLES[name] = f"select {expected} from nation"


_M = "'Run' || n_nationkey || case when n_nationkey % 4 = 0 then 'Async' else '' end as name"
_WHOLE = (
    ("projects_by_names", "GetProjectsByNames('P1', 'P3')", "distinct 'P' || n_regionkey as name", "where n_regionkey in (1, 3)"), ("classes_by_names", "GetClassesByNames('NATION_3', 'none')", "n_name as name", "where n_name = 'NATION_3'"),
    ("interfaces_by_names", "GetInterfacesByNames('I5', 'I6')", "'I' || n_nationkey as name", "where n_nationkey in (5, 6)"), ("enums_by_names", "GetEnumsByNames('E7')", "'E' || n_nationkey as name", "where n_nationkey = 7"),
    ("structs_by_names", "GetStructsByNames('S8', 'S9')", "'S' || n_nationkey as name", "where n_nationkey in (8, 9)"), ("methods_by_names", "GetMethodsByNames('Run1', 'Run4Async')", _M, "where n_nationkey in (1, 4)"),
    ("methods_by_pattern", "GetMethodsByPattern('run1*')", _M, "where starts_with('Run' || n_nationkey, 'Run1')"), ("complex_classes", "GetHighComplexityClasses(20)", "n_name as name", "where n_nationkey >= 20"),
    ("complex_methods", "GetHighComplexityMethods(20)", _M, "where n_nationkey >= 20"), ("undocumented_classes", "GetUndocumentedClasses()", "n_name as name", "where n_nationkey % 3 <> 0"),
    ("undocumented_methods", "GetUndocumentedMethods()", _M, "where n_nationkey % 2 <> 0"), ("async_without_suffix", "GetAsyncMethodsWithoutSuffix()", _M, "where n_nationkey % 4 = 2"),
    ("nested_methods", "GetDeeplyNestedMethods(4)", _M, "where n_nationkey % 6 > 4"), ("loose_classes", "GetLowCohesionClasses(2.0)", "n_name as name", "where n_nationkey >= 20"),
    ("methods_unused_parameters", "GetMethodsWithUnusedParameters()", _M, "where n_nationkey % 2 = 1"), ("methods_unused_variables", "GetMethodsWithUnusedVariables()", _M, "where n_nationkey % 3 > 0"),
    ("unused_parameters", "GetUnusedParameters()", "'a' || n_nationkey as name", "where n_nationkey % 2 = 1"), ("unused_variables", "GetUnusedVariables()", "'v' || n_nationkey as name", "where n_nationkey % 3 > 0"),
    ("unused_fields", "GetUnusedFields()", "'f' || n_nationkey as name", "where n_nationkey % 5 > 0"), ("classes_unused_fields", "GetClassesWithUnusedFields()", "n_name as name", "where n_nationkey % 5 > 0"),
    ("unused_classes", "GetUnusedClasses()", "n_name as name", "where n_nationkey % 2 = 0"), ("unused_interfaces", "GetUnusedInterfaces()", "'I' || n_nationkey as name", "where n_nationkey % 2 = 0"),
    ("unused_enums", "GetUnusedEnums()", "'E' || n_nationkey as name", "where n_nationkey % 2 = 0"), ("unused_structs", "GetUnusedStructs()", "'S' || n_nationkey as name", "where n_nationkey % 2 = 0"),
    ("implementations", "FindImplementations('I2')", "n_name as name", "where n_nationkey % 4 = 2"), ("derived_classes", "FindDerivedClasses('NATION_1')", "n_name as name", "where n_nationkey >= 2"),
)
for _name, _call, _what, _where in _WHOLE:
    _symbols(f"symbols_{_name}", f"cross apply s.{_call} x", f"{_what} from nation {_where} --")
_symbols("symbols_further_properties", "cross apply s.GetMethodsByPattern('*') x cross apply x.Body.Calls c", "'T' || n_nationkey || ' ' || n_nationkey || ' c' || n_nationkey as name", "x.ReturnType || ' ' || ToString(x.Body.Lines) || ' ' || c.Name")
_symbols("symbols_packages_direct", "cross apply s.Projects p cross apply p.GetNugetPackages(false) x", "distinct 'own' || n_regionkey as name", "x.Id")
_symbols("symbols_packages_all", "cross apply s.Projects p cross apply p.GetNugetPackages(true) x", "distinct unnest(['own' || n_regionkey, 'far' || n_regionkey]) as name", "x.Id")
for _name, _get in (("class", "GetClassesByNames('NATION_3')"), ("method", "GetMethodsByNames('Run3')"), ("interface", "GetInterfacesByNames('I3')"), ("enum", "GetEnumsByNames('E3')"), ("struct", "GetStructsByNames('S3')")):
    _symbols(f"symbols_references_of_{_name}", f"cross apply s.{_get} c cross apply c.FindReferences() x", "'d3' as name from range(1) --", "x.Document")


# -- version control


def _git(path: str, *args: str, when: int = 0, who: str = "a") -> None:
    stamp = f"{1_600_000_000 + when} +0000"
    env = os.environ | {"GIT_AUTHOR_DATE": stamp, "GIT_COMMITTER_DATE": stamp, "GIT_AUTHOR_NAME": who, "GIT_AUTHOR_EMAIL": f"{who}@x", "GIT_COMMITTER_NAME": who, "GIT_COMMITTER_EMAIL": f"{who}@x", "GIT_CONFIG_GLOBAL": "/dev/null"}
    subprocess.run(["git", "-C", path, *args], check=True, capture_output=True, env=env)


def _history(spark: SparkSession, sf_dir: str) -> str:
    """A commit for each nation on main; a branch leaves it in the middle and gets three commits of its own.

    Repositories are read where the program ``git`` can see them, so the shared folder has to be mounted.
    """
    path = re.sub(r"^file:(//)?", "", scratch(spark, "repository"))
    os.makedirs(path)
    _git(path, "init", "-q", "-b", "main")
    for k, name, region in nations(spark, sf_dir):
        with open(f"{path}/f{region}.txt", "a") as f:
            f.write(f"{name}\n")
        _git(path, "add", "-A")
        _git(path, "commit", "-q", "-m", f"add {name}", when=60 * k, who=f"u{region}")
        if k == 10:
            _git(path, "tag", "light")
            _git(path, "tag", "-a", "heavy", "-m", "a note", when=60 * k)
            _git(path, "branch", "side")
    _git(path, "checkout", "-q", "side")
    for k in range(3):
        with open(f"{path}/side.txt", "a") as f:
            f.write(f"side {k}\n")
        _git(path, "add", "-A")
        _git(path, "commit", "-q", "-m", f"side {k}", when=6000 + k, who="s")
    _git(path, "checkout", "-q", "main")
    _git(path, "remote", "add", "origin", "http://host/x.git")
    _git(path, "branch", "-q", "--set-upstream-to=main", "side")
    with open(f"{path}/fresh.txt", "w") as f:
        f.write("new")
    with open(f"{path}/f0.txt", "a") as f:
        f.write("changed\n")
    return path


_WHEN = "to_timestamp(1600000000 + 60 * n_nationkey)::timestamp"


def _vcs(name: str, text: str, oracle: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: Engine(spark).sql(text.replace("{path}", _history(spark, sf_dir)))
    ORACLES[name] = oracle


_vcs("git_commits", "select c.MessageShort as msg, c.Author as who, c.AuthorEmail as mail, c.Committer as by, c.CommittedWhen as at, Length(c.Parents) as parents, Length(Split(c.Sha, '')) > 39 as sha from #git.commits('{path}') c", f"select 'add ' || n_name as msg, 'u' || n_regionkey as who, 'u' || n_regionkey || '@x' as mail, 'u' || n_regionkey as by, {_WHEN} as at, (n_nationkey > 0)::int as parents, true as sha from nation")
_vcs("git_branches", "select b.FriendlyName as name, b.CanonicalName as full, b.IsRemote as remote, b.IsCurrentRepositoryHead as head, b.Tip.MessageShort as tip from #git.branches('{path}') b", "select * from (values ('main', 'refs/heads/main', false, true, 'add NATION_24'), ('side', 'refs/heads/side', false, false, 'side 2')) as t(name, \"full\", remote, head, tip)")
_vcs("git_tags", "select t.FriendlyName as name, t.IsAnnotated as noted, t.Message as msg, t.Annotation.Name as note, t.Commit.Sha is not null as sha from #git.tags('{path}') t", "select * from (values ('light', false, null, null, true), ('heavy', true, 'a note', 'heavy', true)) as t(name, noted, msg, note, sha)")
_vcs("git_filehistory", "select h.FilePath as path, h.ChangeType as change, h.Author as who, h.CommittedWhen as at from #git.filehistory('{path}', '*.txt') h", f"select 'f' || n_regionkey || '.txt' as path, case when n_nationkey = min(n_nationkey) over (partition by n_regionkey) then 'Added' else 'Modified' end as change, 'u' || n_regionkey as who, {_WHEN} as at from nation")
_vcs("git_filehistory_take", "select h.CommittedWhen as at from #git.filehistory('{path}', 'f1.txt', 2) h", f"select {_WHEN} as at from nation where n_regionkey = 1 order by n_nationkey desc limit 2")
_vcs("git_filehistory_skip", "select h.CommittedWhen as at from #git.filehistory('{path}', 'f1.txt', 1, 2) h", f"select {_WHEN} as at from nation where n_regionkey = 1 order by n_nationkey desc limit 2 offset 1")
_vcs("git_status", "select s.FilePath as path, s.State as state, s.WorkDirStatus as work from #git.status('{path}') s", "select * from (values ('fresh.txt', 'NewInWorkdir', 'NewInWorkdir'), ('f0.txt', 'Modified', 'Modified')) as t(path, state, work)")
_vcs("git_remotes", "select r.Name as name, r.Url as url, r.PushUrl as push from #git.remotes('{path}') r", "select 'origin' as name, 'http://host/x.git' as url, 'http://host/x.git' as push")
_vcs("git_blame", "select b.StartLineNumber as first, b.LineCount as n, b.Author as who, b.Summary as msg, b.Lines[0].Content as line from #git.blame('{path}', 'f1.txt') b", "select row_number() over (order by n_nationkey)::int as first, 1 as n, 'u1' as who, 'add ' || n_name as msg, n_name as line from nation where n_regionkey = 1")
_vcs("git_blame_revision", "select b.StartLineNumber as first, b.Lines[0].Content as line from #git.blame('{path}', 'f1.txt', 'heavy') b", "select row_number() over (order by n_nationkey)::int as first, n_name as line from nation where n_regionkey = 1 and n_nationkey <= 10")
_vcs("git_repository", "select Length(r.Branches) as branches, Length(r.Commits) as commits, r.Head.FriendlyName as head, Length(r.Tags) as tags, Length(r.Stashes) as stashes, r.Information.IsBare as bare, r.Information.IsShallow as shallow, r.Information.IsHeadDetached as detached from #git.repository('{path}') r", "select 2 as branches, (count(*) + 3)::int as commits, 'main' as head, 2 as tags, 0 as stashes, false as bare, false as shallow, false as detached from nation")
_vcs("git_search_branches", "select b.FriendlyName as name from #git.repository('{path}') r cross apply r.SearchForBranches('^s') b", "select 'side' as name")
_vcs("git_branch_commits", "select c.MessageShort as msg from #git.repository('{path}') r cross apply r.GetBranchSpecificCommits(r.BranchFrom('refs/heads/side')) c", "select 'side ' || range as msg from range(3)")
_vcs("git_merge_base", "select c.MessageShort as msg, r.CommitFrom(c.Sha).Author as who from #git.repository('{path}') r cross apply #git.commits(r.WorkingDirectory) c where r.FindMergeBase(r.BranchFrom('refs/heads/side')).Sha = c.Sha", "select 'add NATION_10' as msg, 'u' || n_regionkey as who from nation where n_nationkey = 10")
_vcs("git_difference", "select d.Path as path, d.ChangeKind as kind from #git.repository('{path}') r cross apply r.DifferenceBetween(r.BranchFrom('refs/heads/main'), r.BranchFrom('refs/heads/side')) d", "select 'side.txt' as path, 'Added' as kind union all select distinct 'f' || n_regionkey || '.txt', 'Modified' from nation where n_nationkey > 10")
_vcs("git_difference_current", "select d.Path as path from #git.repository('{path}') r cross apply r.DifferenceBetweenCurrentAndBranch(r.BranchFrom('refs/heads/side')) d", "select 'side.txt' as path union all select distinct 'f' || n_regionkey || '.txt' from nation where n_nationkey > 10")
_vcs("git_difference_commits", "select d.Path as path from #git.repository('{path}') r cross apply r.DifferenceBetween(r.Commits[0], r.Commits[1]) d where r.Commits[0].MessageShort like 'side%'", "select 'side.txt' as path")
_vcs("git_difference_mixed", "select d.Path as path from #git.repository('{path}') r cross apply r.DifferenceBetweenCommitAndBranch(r.FindMergeBase(r.BranchFrom('refs/heads/side')), r.BranchFrom('refs/heads/side')) d", "select 'side.txt' as path")
_vcs("git_difference_back", "select d.Path as path, d.ChangeKind as kind from #git.repository('{path}') r cross apply r.DifferenceBetweenBranchAndCommit(r.BranchFrom('refs/heads/side'), r.FindMergeBase(r.BranchFrom('refs/heads/side'))) d", "select 'side.txt' as path, 'Deleted' as kind")
_vcs("git_patch", "select p.LinesAdded as added, p.LinesDeleted as gone, Length(p.Changes) as files from #git.repository('{path}') r cross apply r.PatchBetween(r.BranchFrom('refs/heads/side'), r.BranchFrom('refs/heads/main')) p", "select count(*)::int as added, 3 as gone, (count(distinct n_regionkey) + 1)::int as files from nation where n_nationkey > 10")
_vcs("git_difference_contents", "select d.Path as path, d.Exists as there, d.OldMode as was, d.NewMode as now, d.OldContent as old, d.NewContent as new, ToHex(d.NewContentBytes) as raw from #git.repository('{path}') r cross apply r.DifferenceBetween(r.FindMergeBase(r.BranchFrom('refs/heads/side')), r.BranchFrom('refs/heads/side')) d", "select 'side.txt' as path, true as there, '000000' as was, '100644' as now, null as old, body as new, hex(body) as raw from (select string_agg('side ' || range || chr(10), '' order by range) as body from range(3))")
_vcs("git_patch_changes", "select c.Path as path, c.LinesAdded as added, c.LinesDeleted as gone, c.OldMode as was, c.Mode as now, c.IsBinaryComparison as binary, Contains(c.Content, '-side 1') as told from #git.repository('{path}') r cross apply r.PatchBetween(r.BranchFrom('refs/heads/side'), r.BranchFrom('refs/heads/main')) p cross apply p.Changes c", "select 'side.txt' as path, 0 as added, 3 as gone, '100644' as was, '000000' as now, false as binary, true as told union all select 'f' || n_regionkey || '.txt', count(*)::int, 0, '100644', '100644', false, false from nation where n_nationkey > 10 group by n_regionkey")
_vcs("git_tag_notes", "select t.Annotation.Tagger.Name as who, t.Annotation.Tagger.Email as mail, t.Annotation.Tagger.WhenSigned as at, t.Annotation.Sha is not null as sha from #git.tags('{path}') t where t.IsAnnotated = true", "select 'a' as who, 'a@x' as mail, to_timestamp(1600000600)::timestamp as at, true as sha")
_vcs("git_tracking", "select b.FriendlyName as name, b.TrackedBranch.CanonicalName as tracked, b.BranchTrackingDetails.AheadBy as ahead, b.BranchTrackingDetails.BehindBy as behind from #git.branches('{path}') b", "select 'side' as name, 'refs/heads/main' as tracked, 3 as ahead, (select count(*)::int from nation where n_nationkey > 10) as behind union all select 'main', null, null, null")
_vcs("git_configuration", "select c.Value as value, c.ConfigurationLevel as level from #git.repository('{path}') r cross apply r.Configuration c where c.Key = 'core.bare'", "select 'false' as value, 'Local' as level")
_vcs("git_merge_base_commit", "select r.FindMergeBase(r.BranchFrom('refs/heads/side')).MergeBaseCommit.Sha = r.FindMergeBase(r.BranchFrom('refs/heads/side')).Sha as same from #git.repository('{path}') r", "select true as same")
_vcs("git_first_last", "select c.Author as who, MinCommit(c).MessageShort as first, MaxCommit(c).MessageShort as last from #git.commits('{path}') c group by c.Author", "select 'u' || n_regionkey as who, 'add ' || arg_min(n_name, n_nationkey) as first, 'add ' || arg_max(n_name, n_nationkey) as last from nation group by n_regionkey")
_vcs("git_first_last_parent", "select c.Author as who, MinCommit(c, 1).MessageShort as first, MaxCommit(c, 1).MessageShort as last from #git.commits('{path}') c group by c.Author", "select 'u' || n_regionkey as who, 'add ' || (select arg_min(n_name, n_nationkey) from nation) as first, 'add ' || (select arg_max(n_name, n_nationkey) from nation) as last from nation group by n_regionkey")
_vcs("git_apply", "select h.CommittedWhen as at from #git.repository('{path}') r cross apply #git.commits(r.WorkingDirectory) h", f"select {_WHEN} as at from nation")
