"""Nodes of the query dialect. Expressions keep their source text, which names unaliased results."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Node:
    pass


@dataclass(frozen=True)
class Literal(Node):
    value: object


@dataclass(frozen=True)
class Name(Node):
    """A dotted path: column, ``alias.column`` or a nested field."""

    parts: tuple[str, ...]


@dataclass(frozen=True)
class Index(Node):
    of: Node
    key: Node


@dataclass(frozen=True)
class Field(Node):
    of: Node
    name: str


@dataclass(frozen=True)
class Call(Node):
    """A function call; ``target`` is the alias or value before the dot, if any."""

    name: str
    args: tuple[Node, ...]
    target: Node | None = None
    distinct: bool = False


@dataclass(frozen=True)
class Unary(Node):
    op: str
    of: Node


@dataclass(frozen=True)
class Binary(Node):
    op: str
    left: Node
    right: Node


@dataclass(frozen=True)
class In(Node):
    of: Node
    items: tuple[Node, ...]
    negated: bool = False


@dataclass(frozen=True)
class Between(Node):
    of: Node
    low: Node
    high: Node
    negated: bool = False


@dataclass(frozen=True)
class IsNull(Node):
    of: Node
    negated: bool = False


@dataclass(frozen=True)
class Case(Node):
    whens: tuple[tuple[Node, Node], ...]
    otherwise: Node | None
    operand: Node | None = None


@dataclass(frozen=True)
class Star(Node):
    alias: str | None = None


@dataclass(frozen=True)
class Item:
    """One selected expression, its result name and whether the query gave it."""

    expr: Node
    name: str
    aliased: bool = False


@dataclass(frozen=True)
class Source:
    """What a query reads: a table function, a coupled or common table, or a property of an earlier alias."""

    kind: str  # function, named, value
    alias: str
    schema: str | None = None
    name: str = ""
    args: tuple[Node, ...] = ()
    value: Node | None = None


@dataclass(frozen=True)
class Join:
    kind: str  # inner, left, right, full, cross apply, outer apply
    source: Source
    on: Node | None = None


@dataclass(frozen=True)
class Select:
    items: tuple[Item, ...]
    source: Source | None
    joins: tuple[Join, ...] = ()
    where: Node | None = None
    group: tuple[Node, ...] = ()
    having: Node | None = None
    order: tuple[tuple[Node, bool], ...] = ()
    skip: int | None = None
    take: int | None = None
    distinct: bool = False


@dataclass(frozen=True)
class SetOp:
    kind: str  # union, union all, except, intersect
    left: Node | Select | SetOp
    right: Node | Select | SetOp
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class Query:
    body: object
    ctes: tuple[tuple[str, object], ...] = ()


@dataclass(frozen=True)
class TableDecl:
    name: str
    columns: tuple[tuple[str, str], ...] = field(default=())


@dataclass(frozen=True)
class Couple:
    schema: str
    method: str
    table: str
    alias: str


@dataclass(frozen=True)
class Desc:
    schema: str
    method: str | None = None
    args: tuple[Node, ...] | None = None
