"""Service tables: code hosting, issue trackers, containers, clusters, base tables, symbol tables, models.

A service is read through an injected client: the option ``clients`` maps a schema to a
callable that takes (method, arguments, filters, page) and yields JSON objects. Filters
that the service understands are pushed to it (to an issue tracker as query text), and
Spark applies all of them again. Without a client, the option ``snapshots`` names a folder
of saved answers in JSON lines, ``<schema>/<method>.json``, which Spark reads in parallel
with the declared columns. A service with neither raises, unless the option
``missing_services`` is ``"empty"``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThanOrEqual, InputPartition, LessThanOrEqual

from .basic import empty, exists
from .registry import Registry, TableFunction
from .schemas import COLUMNS

_NAME = "Name string, HasDocumentation boolean, ReferenceCount int"
_USE = "array<struct<Name:string,Type:string,IsUsed:boolean>>"
_REFERENCE = "array<struct<Document:string,StartLine:int,StartColumn:int,EndLine:int,EndColumn:int>>"
_METHOD = f"array<struct<Name:string,HasDocumentation:boolean,ReferenceCount:int,IsAsync:boolean,CyclomaticComplexity:int,NestingDepth:int,UnusedParameterCount:int,UnusedVariableCount:int,Parameters:{_USE},Variables:{_USE},References:{_REFERENCE}>>"
_CLASS = f"array<struct<Name:string,HasDocumentation:boolean,ReferenceCount:int,BaseTypes:array<string>,Interfaces:array<string>,LackOfCohesion:double,UnusedFieldCount:int,Fields:{_USE},Methods:{_METHOD},References:{_REFERENCE}>>"
_PLAIN = f"array<struct<Name:string,HasDocumentation:boolean,ReferenceCount:int,References:{_REFERENCE}>>"
_PACKAGE = "array<struct<Id:string,Version:string,License:string,LicenseUrl:string,IsTransitive:boolean>>"
SOLUTION = f"Id string, Projects array<struct<Id:string,Name:string,Classes:{_CLASS},Interfaces:{_PLAIN},Enums:{_PLAIN},Structs:{_PLAIN},NugetPackages:{_PACKAGE}>>"

#: Columns whose equality or range a service can serve itself.
SERVED = {"github": ("State", "AuthorLogin", "Language", "Sha", "UpdatedAt"), "jira": ("Status", "Assignee", "Reporter", "Type", "Priority", "ProjectKey", "CreatedAt", "UpdatedAt")}


#: An issue tracker's own names of columns.
_FIELDS = {"ProjectKey": "project", "CreatedAt": "created", "UpdatedAt": "updated"}


def jql(base: str, filters: list[tuple[str, str, object]]) -> str:
    """The query text of an issue table: a project key or query text, and the pushed filters; values are quoted."""
    first = [base if " " in base or "=" in base else f"project = {json.dumps(base)}"] if base else []
    return " AND ".join(first + [f"{_FIELDS.get(name, name.lower())} {op} {json.dumps(str(value))}" for name, op, value in filters])


class PageReader(DataSourceReader):
    def __init__(self, client, method: str, args: list, schema, served: tuple[str, ...]):
        self.client, self.method, self.args, self.schema, self.served = client, method, args, schema, served
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters) -> Iterator:
        ops = {EqualTo: "=", GreaterThanOrEqual: ">=", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in ops and f.attribute[0] in self.served:
                self.filters.append((f.attribute[0], ops[type(f)], f.value))
            yield f  # a service may match more loosely, so Spark checks again

    def partitions(self):
        pages = getattr(self.client, "pages", None)
        count = pages(self.method, self.args, self.filters) if pages else 1
        return [InputPartition(k) for k in range(count)]

    def read(self, part):
        names, args = self.schema.names, self.args
        if self.served == SERVED["jira"] and self.method == "issues":
            args = [jql(str(args[0]) if args else "", self.filters), *args[1:]]
        for item in self.client(self.method, args, self.filters, part.value):
            yield tuple(item.get(n) for n in names)


def page_source(client, method: str, args: list, ddl: str, served: tuple[str, ...]) -> type[DataSource]:
    """A data source class around one client and call."""

    class Pages(DataSource):
        @classmethod
        def name(cls):
            return "lumenql_pages"

        def schema(self):
            return ddl

        def reader(self, schema):
            return PageReader(client, method, args, schema, served)

    return Pages


def service(schema: str, method: str, ddl: str | None):
    def make(engine, *args) -> DataFrame:
        client = (engine.options.get("clients") or {}).get(schema)
        if client is not None:
            engine.spark.dataSource.register(page_source(client, method, list(args), ddl, SERVED.get(schema, ())))
            return engine.spark.read.format("lumenql_pages").load()
        root = engine.options.get("snapshots")
        path = f"{root}/{schema}/{method}.json"
        if root is None or not exists(engine, path):
            if ddl is None or engine.options.get("missing_services") != "empty":
                raise ValueError(f"#{schema}.{method} needs a client (option clients) or a saved answer (option snapshots)")
            return empty(engine, ddl)
        reader = engine.spark.read.option("mode", "FAILFAST")
        if schema == "csharp":
            # A symbol table says itself which properties of its entities it holds.
            known = reader.json(path).schema
            df = reader.schema(merged(T.StructType.fromDDL(ddl), known)).json(path)
        else:
            df = (reader.schema(ddl) if ddl else reader).json(path)
        return _narrow(df, schema, method, list(args))

    return make


def merged(declared: T.DataType, found: T.DataType) -> T.DataType:
    """The declared type with every further field, at any depth, that the data has."""
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merged(declared.elementType, found.elementType))
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        have = {f.name: f.dataType for f in found.fields}
        own = [T.StructField(f.name, merged(f.dataType, have[f.name]) if f.name in have else f.dataType) for f in declared.fields]
        return T.StructType(own + [f for f in found.fields if f.name not in declared.names])
    return declared


def _narrow(df: DataFrame, schema: str, method: str, args: list) -> DataFrame:
    """The rows of a snapshot that a call's arguments ask for, where the table says whose they are."""
    keys = {"github": ("RepositoryOwner", "RepositoryName"), "kubernetes": ("Namespace",)}.get(schema, ())
    # Query text is for a service; a saved answer is one to the same text.
    if (schema, method) == ("jira", "issues") and args and " " not in str(args[0]):
        keys = ("ProjectKey",)
    if (schema, method) == ("jira", "comments"):
        keys = ("IssueKey",)
    if (schema, method) == ("kubernetes", "podlogs"):
        keys = ("Name", "ContainerName", "Namespace")
    if (schema, method) == ("github", "repositories"):
        keys = ("OwnerLogin",)
    if (schema, method) == ("github", "commits"):
        keys = (*keys, "Sha")
    for key, value in zip(keys, args):
        if key in df.columns:
            df = df.where(F.col(key) == value)
        elif key == "Namespace" and "Metadata" in df.columns:
            df = df.where(F.col("Metadata.Namespace") == value)
    return df


#: Overloads by their parameters, where a function takes any.
PARAMETERS = {
    "github.repositories": ((), ("owner: string",)),
    "github.issues": (("owner: string", "repo: string"),),
    "github.pullrequests": (("owner: string", "repo: string"),),
    "github.commits": (("owner: string", "repo: string"), ("owner: string", "repo: string", "sha: string")),
    "github.branches": (("owner: string", "repo: string"),),
    "github.releases": (("owner: string", "repo: string"),),
    "jira.issues": (("projectKeyOrJql: string",),),
    "jira.comments": (("issueKey: string",),),
    "kubernetes.podlogs": (("podName: string", "containerName: string", "namespace: string"),),
    "kubernetes.events": ((), ("namespace: string",)),
}


def register(registry: Registry) -> None:
    def add(schema: str, method: str, ddl: str | None, overloads=((),)) -> None:
        for params in overloads:
            registry.add(TableFunction(schema, method, tuple(params), service(schema, method, ddl)))

    for key, ddl in COLUMNS.items():
        schema, method = key.split(".")
        add(schema, method, ddl, PARAMETERS.get(key, ((),)))
    add("github", "branchcommits", COLUMNS["github.commits"], (("owner: string", "repo: string", "base: string", "head: string"),))
    add("kubernetes", "secrets", "Namespace string, Name string, Type string, Age timestamp")
    add("airtable", "records", None, (("tableName: string",),))
    add("csharp", "solution", SOLUTION, (("path: string",),))

    def model(engine, *settings) -> DataFrame:
        """One row that carries a model's settings; its functions take them along."""
        names = ("Model", "MaxTokens", "Temperature", "FrequencyPenalty", "PresencePenalty")
        values = [str(s) for s in settings] + [None] * (len(names) - len(settings))
        return engine.spark.range(1).select(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, values)])

    gpt = ("model: string", "maxTokens: int", "temperature: decimal", "frequencyPenalty: decimal", "presencePenalty: decimal")
    for k in range(len(gpt) + 1):
        registry.add(TableFunction("openai", "gpt", gpt[:k], model))
    for k in (1, 2):
        registry.add(TableFunction("ollama", "llm", ("model: string", "temperature: decimal")[:k], model))
