"""Table functions by schema and name, without regard to case."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

Factory = Callable[..., DataFrame]


@dataclass(frozen=True)
class TableFunction:
    """One overload: its parameters, and how a DataFrame or, for lateral use, an array Column is made."""

    schema: str
    name: str
    params: tuple[str, ...]
    make: Factory
    lateral: Callable[..., Column] | None = None
    variadic: bool = False

    def takes(self, count: int) -> bool:
        return count == len(self.params) or (self.variadic and count >= len(self.params))


class UnknownName(LookupError):
    """A schema or method that is not there; the message names the alternatives."""


class Registry:
    def __init__(self) -> None:
        self._functions: dict[str, list[TableFunction]] = {}

    def add(self, function: TableFunction) -> None:
        self._functions.setdefault(function.schema.lower(), []).append(function)

    def schemas(self) -> list[str]:
        return sorted(self._functions)

    def methods(self, schema: str) -> list[TableFunction]:
        if schema.lower() not in self._functions:
            raise UnknownName(f"unknown schema #{schema}; there are: {', '.join(self.schemas())}")
        return self._functions[schema.lower()]

    def overloads(self, schema: str, name: str) -> list[TableFunction]:
        all_of = self.methods(schema)
        found = [f for f in all_of if f.name.lower() == name.lower()]
        found = found or [f for f in all_of if f.name == "*"]
        if not found:
            raise UnknownName(f"#{schema} has no method {name}; it has: {', '.join(sorted({f.name for f in all_of}))}")
        return found

    def find(self, schema: str, name: str, count: int) -> TableFunction:
        overloads = self.overloads(schema, name)
        for f in overloads:
            if f.takes(count):
                return f
        raise UnknownName(f"#{schema}.{name} does not take {count} arguments; it takes: {', '.join('(' + ', '.join(f.params) + ')' for f in overloads)}")
