"""From parsed statements to DataFrames. Catalyst plans, prunes and pushes down; nothing is executed here.

While a query is built, every column is named ``alias.column``, so sources never clash
and unused columns are pruned as usual. Results are renamed at the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import library
from ..functions.library import Constant
from ..operators import setops
from ..operators.grouping import AGGREGATES, aggregate
from ..operators.numbering import numbered
from . import ast as A


class QueryError(ValueError):
    pass


#: The column that holds a row's number while a query that asks for it is built.
ROW_NUMBER = ".row_number"


@dataclass
class Scope:
    """A table under construction: the columns of each alias, and what each alias is."""

    df: DataFrame
    aliases: dict[str, list[str]] = field(default_factory=dict)
    functions: dict[str, dict] = field(default_factory=dict)

    def find(self, name: str) -> str | None:
        return next((a for a in self.aliases if a.lower() == name.lower()), None)


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: object) -> Column:
    if isinstance(value, Decimal):
        return F.lit(value).cast("decimal(38,18)")
    return F.lit(value)


class Lowering:
    def __init__(self, engine):
        self.engine = engine
        self.tables: dict[str, tuple[tuple[str, str], ...]] = {}
        self.coupled: dict[str, A.Couple] = {}
        self.ctes: dict[str, DataFrame] = {}

    # -- statements
    def run(self, statements: list[object]) -> DataFrame | None:
        out = None
        for s in statements:
            if isinstance(s, A.TableDecl):
                self.tables[s.name.lower()] = s.columns
            elif isinstance(s, A.Couple):
                self.coupled[s.alias.lower()] = s
            elif isinstance(s, A.Desc):
                out = self.desc(s)
            else:
                for name, body in s.ctes:
                    self.ctes[name.lower()] = self.body(body)
                out = self.body(s.body)
        return out

    def desc(self, s: A.Desc) -> DataFrame:
        spark = self.engine.spark
        if s.args is not None:
            df = self.table_function(s.schema, s.method, s.args)
            rows = [(f.name, i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
            return spark.createDataFrame(rows, "Name string, Index int, Type string")
        functions = self.engine.registry.methods(s.schema) if s.method is None else self.engine.registry.overloads(s.schema, s.method)
        width = max((len(f.params) for f in functions), default=0)
        rows = [(f.name, *f.params, *[None] * (width - len(f.params))) for f in functions]
        return spark.createDataFrame(rows, ", ".join(["Name string", *[f"`Param {i}` string" for i in range(width)]]))

    def body(self, node) -> DataFrame:
        if isinstance(node, A.SetOp):
            left, right, keys = self.body(node.left), self.body(node.right), list(node.keys)
            if node.kind == "union all":
                return setops.union_all(left, right)
            by_low = {c.lower(): c for c in left.columns}
            keys = [by_low[k.lower()] for k in keys]
            return {"union": setops.union_keyed, "except": setops.except_keyed, "intersect": setops.intersect_keyed}[node.kind](left, right, keys)
        return self.select(node)

    # -- sources
    def values(self, args) -> list[object]:
        """Arguments as Python values; the name of a common table stands for its first column's values."""
        out = []
        for a in args:
            if isinstance(a, A.Literal):
                out.append(a.value)
            elif isinstance(a, A.Unary) and isinstance(a.of, A.Literal):
                out.append(-a.of.value)
            elif isinstance(a, A.Name) and a.parts[0].lower() in self.ctes:
                out.append(self.paths(self.ctes[a.parts[0].lower()]))
            else:
                raise QueryError("arguments of a table function have to be constants, but under apply")
        return out

    def paths(self, df: DataFrame) -> list[str]:
        """A list of paths for a reader: metadata, of at most ``max_paths`` entries."""
        most = int(self.engine.options.get("max_paths", 100_000))
        rows = df.select(df.columns[0]).limit(most + 1).collect()
        if len(rows) > most:
            raise QueryError(f"more than {most} paths")
        return [r[0] for r in rows]

    def table_function(self, schema: str, name: str, args, declared=None) -> DataFrame:
        function = self.engine.registry.find(schema, name, len(args))
        values = self.values(args)
        if function.name == "*":
            values = [name, *values]
        extra = {"declared": list(declared)} if declared else {}
        return function.make(self.engine, *values, **extra)

    def source(self, s: A.Source) -> Scope:
        if s.kind == "function":
            df, functions = self.table_function(s.schema, s.name, s.args), self.engine.row_library(s.schema, s.args and self.values(s.args) or [])
        else:
            key = s.name.lower()
            functions = {}
            if key in self.ctes:
                df = self.ctes[key]
            elif key in self.coupled:
                c = self.coupled[key]
                df, functions = self.table_function(c.schema, c.method, s.args, self.tables[c.table.lower()]), self.engine.row_library(c.schema, [])
            else:
                raise QueryError(f"unknown table {s.name}; there are: {', '.join(sorted([*self.ctes, *self.coupled]))}")
        named = df.select(*[F.col(_tick(c)).alias(f"{s.alias}.{c}") for c in df.columns])
        return Scope(named, {s.alias: list(df.columns)}, {s.alias: functions})

    # -- select
    def select(self, q: A.Select) -> DataFrame:
        if q.source is None:
            scope = Scope(self.engine.spark.range(1).select(F.lit(1).alias(".one")), {})
        else:
            scope = self.source(q.source)
        q = self.anti(q, scope)
        if any(self.has_row_number(n) for n in (*(i.expr for i in q.items), *([q.where] if q.where is not None else []))) and not q.joins:
            scope.df = numbered(scope.df, ROW_NUMBER)
        for join in q.joins:
            scope = self.join(scope, join)
        if q.joins and any(self.has_row_number(n) for n in (*(i.expr for i in q.items), *([q.where] if q.where is not None else []))):
            scope.df = numbered(scope.df, ROW_NUMBER)
        if q.where is not None:
            scope.df = scope.df.where(self.expr(q.where, scope))
        items = self.expand(q.items, scope)
        calls: list[A.Call] = []
        for node in [*(i.expr for i in items), *([q.having] if q.having is not None else []), *(k for k, _ in q.order)]:
            self.aggregates(node, calls)
        if q.group or calls:
            return self.grouped(q, items, calls, scope)
        out = [self.expr(i.expr, scope).alias(i.name) for i in items]
        if q.distinct:
            df = scope.df.select(*out).distinct()
            result = Scope(df.select(*[F.col(_tick(c)).alias(f".{c}") for c in df.columns]), {"": df.columns})
            return self.ordered(df, q, lambda k: self.by_result(k, items, result, df))
        if not q.order:
            return self.limited(scope.df.select(*out), q)
        keys = [self.sort_key(k, items, scope) for k, _ in q.order]
        hidden = [k.alias(f"__sort{i}") for i, k in enumerate(keys)]
        df = scope.df.select(*out, *hidden)
        df = df.orderBy(*[F.col(f"__sort{i}").desc() if down else F.col(f"__sort{i}").asc() for i, (_, down) in enumerate(q.order)])
        return self.limited(df, q).drop(*[f"__sort{i}" for i in range(len(keys))])

    def by_result(self, node, items, result, df):
        for i in items:
            if i.expr == node or (isinstance(node, A.Name) and node.parts == (i.name,)):
                return F.col(_tick(i.name))
        return self.expr(node, result)

    def ordered(self, df: DataFrame, q: A.Select, key) -> DataFrame:
        if q.order:
            df = df.orderBy(*[key(k).desc() if down else key(k).asc() for k, down in q.order])
        return self.limited(df, q)

    @staticmethod
    def limited(df: DataFrame, q: A.Select) -> DataFrame:
        if q.skip:
            df = df.offset(q.skip)
        return df if q.take is None else df.limit(q.take)

    def sort_key(self, node, items, scope: Scope) -> Column:
        if isinstance(node, A.Name) and len(node.parts) == 1:
            for i in items:
                if i.aliased and i.name.lower() == node.parts[0].lower():
                    return self.expr(i.expr, scope)
        return self.expr(node, scope)

    def expand(self, items, scope: Scope) -> list[A.Item]:
        out = []
        for i in items:
            if not isinstance(i.expr, A.Star):
                out.append(i)
                continue
            several = len(scope.aliases) > 1
            for alias, columns in scope.aliases.items():
                if i.expr.alias is None or alias.lower() == i.expr.alias.lower():
                    out += [A.Item(A.Name((alias, c)), f"{alias}.{c}" if several else c) for c in columns]
        return out

    # -- joins and apply
    def join(self, scope: Scope, join: A.Join) -> Scope:
        if "apply" in join.kind:
            return self.apply(scope, join)
        other = self.source(join.source)
        both = Scope(scope.df, {**scope.aliases, **other.aliases}, {**scope.functions, **other.functions})
        condition = self.expr(join.on, both)
        how = {"inner": "inner", "left": "left", "right": "right", "full": "full", "left_anti": "left_anti"}[join.kind]
        both.df = scope.df.join(other.df, condition, how)
        if how == "left_anti":
            both.aliases.pop(join.source.alias)
        return both

    def apply(self, scope: Scope, join: A.Join) -> Scope:
        s = join.source
        functions: dict = {}
        if s.kind == "value":
            value = self.expr(s.value, scope)
        else:
            declared = None
            schema, name = s.schema, s.name
            if s.kind == "named":
                if s.name.lower() not in self.coupled:
                    raise QueryError(f"{s.name} cannot be applied")
                c = self.coupled[s.name.lower()]
                schema, name, declared = c.schema, c.method, self.tables[c.table.lower()]
            function = self.engine.registry.find(schema, name, len(s.args))
            if function.lateral is None:
                return self.apply_source(scope, join, schema, name, declared)
            args = [self.raw(a, scope) for a in s.args]
            args = args if declared else [library.column(a) for a in args]
            value = function.lateral(*args, *([list(declared)] if declared else []))
            functions = self.engine.row_library(schema, [])
        explode = F.explode_outer if join.kind == "outer apply" else F.explode
        held = [F.col(_tick(c)) for c in scope.df.columns]
        kind = scope.df.select(value.alias("v")).schema["v"].dataType
        df = scope.df.select(*held, explode(value).alias(*([".key", ".value"] if isinstance(kind, T.MapType) else [".item"])))
        if isinstance(kind, T.MapType):
            columns = {"Key": F.col("`.key`"), "Value": F.col("`.value`")}
        elif isinstance(kind.elementType, T.StructType):
            columns = {f.name: F.col("`.item`")[f.name] for f in kind.elementType.fields}
        else:
            columns = {"Value": F.col("`.item`")}
        df = df.select(*held, *[c.alias(f"{s.alias}.{n}") for n, c in columns.items()])
        return Scope(df, {**scope.aliases, s.alias: list(columns)}, {**scope.functions, s.alias: functions})

    def apply_source(self, scope: Scope, join: A.Join, schema: str, name: str, declared) -> Scope:
        """Apply a table function whose arguments come from rows.

        Arguments name places to read (folders, files, repositories): metadata, like a list
        of paths. Each distinct set of them becomes one scan, ``max_paths`` at most, and
        the scans meet the rows again by their arguments.
        """
        s = join.source
        function = self.engine.registry.find(schema, name, len(s.args))
        args = [self.expr(a, scope) for a in s.args]
        most = int(self.engine.options.get("max_paths", 100_000))
        keys = [f".arg{i}" for i in range(len(args))]
        told = scope.df.select(*[a.alias(k) for k, a in zip(keys, args)]).distinct().limit(most + 1).collect()
        if len(told) > most:
            raise QueryError(f"#{schema}.{name} is applied to more than {most} places; the option max_paths raises the limit")
        scans = None
        for row in told:
            if any(v is None for v in row):
                continue
            values = list(row) if function.name != "*" else [name, *row]
            df = function.make(self.engine, *values, **({"declared": list(declared)} if declared else {}))
            columns = list(df.columns)
            df = df.select(*[F.lit(v).alias(k) for k, v in zip(keys, row)], *[F.col(_tick(c)).alias(f"{s.alias}.{c}") for c in columns])
            scans = df if scans is None else scans.unionByName(df, allowMissingColumns=True)
        if scans is None:
            raise QueryError(f"#{schema}.{name} is applied to no place, so its columns are unknown")
        held = scope.df.columns
        meet = None
        left = scope.df.select("*", *[a.alias(f"{k}.of") for k, a in zip(keys, args)])
        for k in keys:
            same = F.col(_tick(f"{k}.of")) == F.col(_tick(k))
            meet = same if meet is None else meet & same
        out = left.join(scans, meet, "left" if join.kind == "outer apply" else "inner") if meet is not None else left.crossJoin(scans)
        columns = [c[len(s.alias) + 1 :] for c in scans.columns if c not in keys]
        out = out.select(*[F.col(_tick(c)) for c in [*held, *[f"{s.alias}.{c}" for c in columns]]])
        return Scope(out, {**scope.aliases, s.alias: columns}, {**scope.functions, s.alias: self.engine.row_library(schema, [])})

    def anti(self, q: A.Select, scope: Scope) -> A.Select:
        """A left join whose only use is that its key is null becomes an anti join."""
        if len(q.joins) != 1 or q.joins[0].kind != "left" or q.where is None:
            return q
        join, parts = q.joins[0], _conjuncts(q.where)
        alias = join.source.alias.lower()
        keys = {n.parts[1].lower() for n in _equal_names(join.on) if len(n.parts) == 2 and n.parts[0].lower() == alias}
        tests = [p for p in parts if isinstance(p, A.IsNull) and not p.negated and isinstance(p.of, A.Name) and len(p.of.parts) == 2 and p.of.parts[0].lower() == alias and p.of.parts[1].lower() in keys]
        rest = [p for p in parts if p not in tests]
        used = [i.expr for i in q.items] + rest + list(q.group) + [k for k, _ in q.order] + ([q.having] if q.having is not None else [])
        # Every name has to say which alias it is of, and none may be of the joined one.
        if not tests or any(isinstance(n, A.Star) or (isinstance(n, A.Name) and (len(n.parts) < 2 or n.parts[0].lower() == alias)) for u in used for n in _walk(u)):
            return q
        where = None
        for p in rest:
            where = p if where is None else A.Binary("and", where, p)
        from dataclasses import replace

        return replace(q, joins=(A.Join("left_anti", join.source, join.on),), where=where)

    # -- grouping
    def aggregates(self, node, out: list[A.Call]) -> None:
        for n in _walk(node, stop=lambda c: isinstance(c, A.Call) and self.is_aggregate(c)):
            if isinstance(n, A.Call) and self.is_aggregate(n) and n not in out:
                out.append(n)

    @staticmethod
    def is_aggregate(call: A.Call) -> bool:
        return call.name.lower() in AGGREGATES

    @staticmethod
    def has_row_number(node) -> bool:
        return any(isinstance(n, A.Call) and n.name.lower() == "rownumber" for n in _walk(node))

    def grouped(self, q: A.Select, items, calls, scope: Scope) -> DataFrame:
        constant = [isinstance(k, A.Literal) for k in q.group]
        nodes = [k for k, c in zip(q.group, constant) if not c]
        keys = [self.expr(k, scope) for k in nodes]
        wanted = []
        for call in calls:
            parent = 0
            args = list(call.args)
            if len(args) == 2 and isinstance(args[1], A.Literal):
                parent = int(args[1].value)
            if call.name.lower() in ("aggregatefiles", "aggregatedirectories") and not args:
                value = self.row(next(iter(scope.aliases)), scope)  # the row itself is what is collected
            else:
                value = F.lit(1) if not args or isinstance(args[0], A.Star) else self.expr(args[0], scope)
            wanted.append((call.name.lower(), value, parent, call.distinct))
        df, key_names, results = aggregate(scope.df, keys, wanted)
        swap: dict[A.Node, Column] = {n: F.col(k) for n, k in zip(nodes, key_names)}
        for n, k in zip(nodes, key_names):
            if isinstance(n, A.Name):
                swap.setdefault(A.Name((n.parts[-1],)), F.col(k))
        swap |= {c: F.col(r) for c, r in zip(calls, results)}
        inner = Scope(df, {}, scope.functions)
        if q.having is not None:
            inner.df = df = df.where(self.expr(q.having, inner, swap))
        named = {i.name.lower(): i for i in items if i.aliased}
        out = [self.expr(i.expr, inner, swap).alias(i.name) for i in items]
        keys_of = []
        for k, _ in q.order:
            node = named[k.parts[0].lower()].expr if isinstance(k, A.Name) and len(k.parts) == 1 and k.parts[0].lower() in named and k not in swap else k
            keys_of.append(self.expr(node, inner, swap))
        df = df.select(*out, *[k.alias(f"__sort{i}") for i, k in enumerate(keys_of)])
        if q.distinct and not keys_of:
            df = df.distinct()
        if keys_of:
            df = df.orderBy(*[F.col(f"__sort{i}").desc() if down else F.col(f"__sort{i}").asc() for i, (_, down) in enumerate(q.order)])
        return self.limited(df, q).drop(*[f"__sort{i}" for i in range(len(keys_of))])

    # -- expressions
    def raw(self, node, scope, swap=None):
        """An argument: constants stay constants."""
        return Constant(node.value) if isinstance(node, A.Literal) else self.expr(node, scope, swap)

    def expr(self, node, scope: Scope, swap: dict | None = None) -> Column:
        if swap and node in swap:
            return swap[node]
        go = lambda n: self.expr(n, scope, swap)
        match node:
            case A.Literal(value):
                return literal(value)
            case A.Name(parts):
                return self.name(parts, scope)
            case A.Field(of, name):
                return go(of)[name]
            case A.Index(of, key):
                inner = go(of)
                return F.get(inner, go(key)) if isinstance(key, A.Literal) and isinstance(key.value, int) else F.try_element_at(inner, go(key))
            case A.Unary(op, of):
                return {"not": lambda c: ~c, "-": lambda c: -c, "+": lambda c: c, "~": F.bitwise_not}[op](go(of))
            case A.Binary(op, left, right):
                return _BINARY[op](go(left), go(right))
            case A.In(of, items, negated):
                found = go(of).isin(*[go(i) for i in items]) if items else F.lit(False)
                return ~found if negated else found
            case A.Between(of, low, high, negated):
                found = go(of).between(go(low), go(high))
                return ~found if negated else found
            case A.IsNull(of, negated):
                return go(of).isNotNull() if negated else go(of).isNull()
            case A.Case(whens, otherwise, operand):
                test = lambda c: go(c) if operand is None else go(operand) == go(c)
                out = None
                for condition, value in whens:
                    out = F.when(test(condition), go(value)) if out is None else out.when(test(condition), go(value))
                return out if otherwise is None else out.otherwise(go(otherwise))
            case A.Call():
                return self.call(node, scope, swap)
        raise QueryError(f"cannot use {node} here")

    def name(self, parts: tuple[str, ...], scope: Scope) -> Column:
        alias = scope.find(parts[0])
        if alias is not None and len(parts) > 1:
            column = _match(scope.aliases[alias], parts[1])
            if column is not None:
                return _nested(F.col(_tick(f"{alias}.{column}")), parts[2:])
            if parts[1].lower() == "self":
                return _nested(self.row(alias, scope), parts[2:])
        found = [(a, c) for a, columns in scope.aliases.items() if (c := _match(columns, parts[0])) is not None]
        if len(found) > 1:
            raise QueryError(f"{parts[0]} is ambiguous: {', '.join(f'{a}.{c}' for a, c in found)}")
        if found:
            return _nested(F.col(_tick(f"{found[0][0]}.{found[0][1]}")), parts[1:])
        if alias is not None and len(parts) == 1:
            return self.row(alias, scope)
        raise QueryError(f"unknown column {'.'.join(parts)}; there are: {', '.join(f'{a}.{c}' for a, cs in scope.aliases.items() for c in cs)}")

    @staticmethod
    def row(alias: str, scope: Scope) -> Column:
        return F.struct(*[F.col(_tick(f"{alias}.{c}")).alias(c) for c in scope.aliases[alias]])

    def call(self, node: A.Call, scope: Scope, swap) -> Column:
        name, args = node.name.lower(), [self.raw(a, scope, swap) for a in node.args]
        alias = target = None
        if isinstance(node.target, A.Name) and len(node.target.parts) == 1:
            alias = scope.find(node.target.parts[0])
        if node.target is not None and alias is None:
            target = self.expr(node.target, scope, swap)
        if name == "rownumber":
            return F.col(_tick(ROW_NUMBER))
        bound = scope.functions.get(alias, {}) if alias is not None else {k: f for fs in scope.functions.values() for k, f in fs.items()}
        if name in bound:
            return bound[name](*map(library.column, args))
        if target is not None and name in library.ROW_FUNCTIONS:
            return library.ROW_FUNCTIONS[name](target, *args)
        if name in ("skip", "take", "skipandtake") and args:
            first = target if target is not None else library.column(args[0])
            kind = scope.df.select(first.alias("v")).schema["v"].dataType
            if isinstance(kind, T.ArrayType):
                return library.part_of_array(name, first, *(args if target is not None else args[1:]))
        rows = [alias] if alias is not None else list(scope.aliases)[:1] if len(scope.aliases) == 1 else []
        if name in library.FUNCTIONS and (name not in library.ROW_FUNCTIONS or not rows or self.fits(name, len(args))):
            return library.FUNCTIONS[name](*([target] if target is not None else []), *args)
        if name in library.ROW_FUNCTIONS and rows:
            return library.ROW_FUNCTIONS[name](self.row(rows[0], scope), *args)
        return F.call_function(name, *([target] if target is not None else []), *map(library.column, args))

    @staticmethod
    def fits(name: str, count: int) -> bool:
        """Whether a function that exists with and without a row is meant without one: by its argument count."""
        import inspect

        need = {"subpath": 2, "haslabel": 2, "length": 1}.get(name)
        if need is None:
            need = 1 if name.startswith("is") else len(inspect.signature(library.FUNCTIONS[name]).parameters)
        return count >= need


_BINARY = {
    "or": lambda a, b: a | b, "and": lambda a, b: a & b, "=": lambda a, b: a == b, "<>": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "like": F.like, "rlike": F.rlike, "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b,
    "/": F.try_divide, "%": F.try_mod, "||": F.concat, "&": lambda a, b: a.bitwiseAND(b), "|": lambda a, b: a.bitwiseOR(b), "^": lambda a, b: a.bitwiseXOR(b),
    "<<": lambda a, b: F.call_function("shiftleft", a, b), ">>": lambda a, b: F.call_function("shiftright", a, b),
}


def _nested(column: Column, path) -> Column:
    for part in path:
        column = column[part]
    return column


def _match(columns: list[str], name: str) -> str | None:
    return name if name in columns else next((c for c in columns if c.lower() == name.lower()), None)


def _children(node):
    match node:
        case A.Unary(_, of) | A.IsNull(of, _) | A.Field(of, _):
            return [of]
        case A.Binary(_, left, right):
            return [left, right]
        case A.Index(of, key):
            return [of, key]
        case A.In(of, items, _):
            return [of, *items]
        case A.Between(of, low, high, _):
            return [of, low, high]
        case A.Case(whens, otherwise, operand):
            return [x for w in whens for x in w] + [x for x in (otherwise, operand) if x is not None]
        case A.Call(_, args, target, _):
            return [*args, *([target] if target is not None else [])]
    return []


def _walk(node, stop=lambda n: False):
    yield node
    if not stop(node):
        for child in _children(node):
            yield from _walk(child, stop)


def _conjuncts(node) -> list:
    return _conjuncts(node.left) + _conjuncts(node.right) if isinstance(node, A.Binary) and node.op == "and" else [node]


def _equal_names(node) -> list[A.Name]:
    return [n for p in _conjuncts(node) if isinstance(p, A.Binary) and p.op == "=" for n in (p.left, p.right) if isinstance(n, A.Name)]
