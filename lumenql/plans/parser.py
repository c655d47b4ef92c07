"""Lexer and recursive-descent parser of the query dialect."""

from __future__ import annotations

import re
from decimal import Decimal

from . import ast as A


class ParseError(ValueError):
    pass


_TOKEN = re.compile(
    r"""(?P<space>\s+|--[^\n]*|/\*.*?\*/)
      | (?P<string>'(?:[^'\\]|\\.|'')*')
      | (?P<number>0[xX][0-9a-fA-F]+|0[bB][01]+|0[oO][0-7]+|\d+\.\d+(?:[eE][+-]?\d+)?|\d+)(?P<suffix>ub|us|ui|ul|[bslidBSLID](?![A-Za-z0-9_]))?
      | (?P<name>[A-Za-z_][A-Za-z0-9_]*|\[[A-Za-z_][^\]]*\]|"[^"]+")
      | (?P<schema>\#[A-Za-z_][A-Za-z0-9_]*)
      | (?P<op><>|!=|>=|<=|<<|>>|\|\||[-+*/%=<>(),.;{}:&|^~\[\]?])""",
    re.VERBOSE | re.DOTALL,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0"}
_CLAUSES = frozenset("select from where group having order skip take union except intersect inner left right full cross outer join on with as table couple desc apply and or not like rlike in is between contains case when then else end limit offset".split())


class Token:
    __slots__ = ("kind", "text", "value", "begin", "end")

    def __init__(self, kind: str, text: str, value: object, begin: int, end: int):
        self.kind, self.text, self.value, self.begin, self.end = kind, text, value, begin, end


def tokenize(text: str) -> list[Token]:
    out, at = [], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ParseError(f"unexpected character {text[at]!r} at {at}")
        kind, raw = m.lastgroup, m.group()
        if kind == "suffix":
            kind = "number"
        if kind == "string":
            value: object = re.sub(r"\\(.)|''", lambda e: "'" if e[0] == "''" else _ESCAPES.get(e[1], e[1] if e[1] in "'\\" else e[0]), raw[1:-1])
        elif kind == "number":
            value = _number(m["number"], m["suffix"])
        elif kind == "name":
            value = raw[1:-1] if raw[0] in '["' else raw
            kind = "quoted" if raw[0] in '["' else kind
        elif kind == "schema":
            value = raw[1:]
        else:
            value = raw
        if kind != "space":
            out.append(Token(kind, raw, value, m.start(), m.end()))
        at = m.end()
    out.append(Token("end", "", None, len(text), len(text)))
    return out


def _number(digits: str, suffix: str | None) -> object:
    prefix = digits[:2].lower()
    if prefix in ("0x", "0b", "0o"):
        return int(digits[2:], {"0x": 16, "0b": 2, "0o": 8}[prefix])
    if "." in digits or (suffix or "").lower() == "d":
        return Decimal(digits)
    return int(digits)


class Parser:
    def __init__(self, text: str):
        self.text, self.tokens, self.at = text, tokenize(text), 0

    # -- token helpers
    @property
    def now(self) -> Token:
        return self.tokens[self.at]

    def word(self, *words: str, ahead: int = 0) -> bool:
        """Whether the next tokens are these keywords."""
        span = self.tokens[self.at + ahead : self.at + ahead + len(words)]
        return len(span) == len(words) and all(t.kind == "name" and t.text.lower() == w for t, w in zip(span, words))

    def take_word(self, *words: str) -> bool:
        if self.word(*words):
            self.at += len(words)
            return True
        return False

    def op(self, text: str) -> bool:
        return self.now.kind == "op" and self.now.text == text

    def take_op(self, text: str) -> bool:
        if self.op(text):
            self.at += 1
            return True
        return False

    def need_op(self, text: str) -> None:
        if not self.take_op(text):
            raise ParseError(f"expected {text!r} at {self.now.begin}, found {self.now.text!r}")

    def need_word(self, word: str) -> None:
        if not self.take_word(word):
            raise ParseError(f"expected {word!r} at {self.now.begin}, found {self.now.text!r}")

    def name(self) -> str:
        if self.now.kind not in ("name", "quoted"):
            raise ParseError(f"expected a name at {self.now.begin}, found {self.now.text!r}")
        self.at += 1
        return str(self.tokens[self.at - 1].value)

    # -- statements
    def script(self) -> list[object]:
        out: list[object] = []
        while self.now.kind != "end":
            if not self.take_op(";"):
                out.append(self.statement())
        return out

    def statement(self) -> object:
        if self.word("table") and self.tokens[self.at + 1].kind in ("name", "quoted"):
            return self.table()
        if self.take_word("couple"):
            schema, method = self.schema_method()
            self.need_word("with")
            self.need_word("table")
            table = self.name()
            self.need_word("as")
            return A.Couple(schema, method, table, self.name())
        if self.take_word("desc"):
            schema = str(self.now.value)
            self.at += 1
            if not self.take_op("."):
                return A.Desc(schema)
            method = self.name()
            return A.Desc(schema, method, self.arguments() if self.op("(") else None)
        return self.query()

    def table(self) -> A.TableDecl:
        self.need_word("table")
        name, columns = self.name(), []
        self.need_op("{")
        while not self.take_op("}"):
            column = self.name()
            self.take_op(":")
            kind = str(self.now.value)
            self.at += 1
            columns.append((column, kind + ("?" if self.take_op("?") else "")))
            self.take_op(",")
        return A.TableDecl(name, tuple(columns))

    def schema_method(self) -> tuple[str, str]:
        if self.now.kind != "schema":
            raise ParseError(f"expected #schema at {self.now.begin}")
        schema = str(self.now.value)
        self.at += 1
        self.need_op(".")
        return schema, self.name()

    def query(self) -> A.Query:
        ctes = []
        if self.take_word("with"):
            while True:
                name = self.name()
                self.need_word("as")
                self.need_op("(")
                ctes.append((name, self.set_query()))
                self.need_op(")")
                if not self.take_op(","):
                    break
        return A.Query(self.set_query(), tuple(ctes))

    def set_query(self):
        left = self.select()
        while True:
            for kind in ("union all", "union", "except", "intersect"):
                if self.take_word(*kind.split()):
                    break
            else:
                return left
            keys: list[str] = []
            if self.op("(") and not self.word("select", ahead=1) and not self.word("from", ahead=1):
                self.need_op("(")
                while not self.take_op(")"):
                    keys.append(".".join(self.path()))
                    self.take_op(",")
            left = A.SetOp(kind, left, self.select(), tuple(keys))

    def path(self) -> list[str]:
        parts = [self.name()]
        while self.take_op("."):
            parts.append(self.name())
        return parts

    def select(self) -> A.Select:
        if self.take_op("("):
            inner = self.set_query()
            self.need_op(")")
            return inner
        parts: dict[str, object] = {}
        if self.take_word("select"):
            parts["distinct"] = self.take_word("distinct")
            parts["items"] = self.items()
        source, joins = None, []
        if self.take_word("from"):
            source = self.source()
            while (join := self.join()) is not None:
                joins.append(join)
        if self.take_word("where"):
            parts["where"] = self.expr()
        if self.take_word("group", "by"):
            parts["group"] = self.list_of_exprs()
        if self.take_word("having"):
            parts["having"] = self.expr()
        if "items" not in parts and self.take_word("select"):
            parts["distinct"] = self.take_word("distinct")
            parts["items"] = self.items()
        if self.take_word("order", "by"):
            order = []
            while True:
                key = self.expr()
                down = self.take_word("desc")
                if not down:
                    self.take_word("asc")
                order.append((key, down))
                if not self.take_op(","):
                    break
            parts["order"] = tuple(order)
        for _ in range(2):
            for word in ("skip", "take"):
                if self.take_word(word):
                    parts[word] = int(self.now.value)
                    self.at += 1
        if "items" not in parts:
            raise ParseError(f"expected select at {self.now.begin}, found {self.now.text!r}")
        return A.Select(source=source, joins=tuple(joins), **parts)

    def list_of_exprs(self) -> tuple[A.Node, ...]:
        out = [self.expr()]
        while self.take_op(","):
            out.append(self.expr())
        return tuple(out)

    def items(self) -> tuple[A.Item, ...]:
        out = []
        while True:
            begin = self.now.begin
            expr = self.expr()
            name, aliased = self.text[begin : self.tokens[self.at - 1].end], False
            if self.take_word("as"):
                name, aliased = str(self.now.value), True
                self.at += 1
            elif self.now.kind in ("quoted", "string") or (self.now.kind == "name" and self.now.text.lower() not in _CLAUSES):
                name, aliased = str(self.now.value), True
                self.at += 1
            out.append(A.Item(expr, name, aliased))
            if not self.take_op(","):
                return tuple(out)

    def alias(self, default: str) -> str:
        self.take_word("as")
        if self.now.kind == "quoted" or (self.now.kind == "name" and self.now.text.lower() not in _CLAUSES):
            return self.name()
        return default

    def source(self) -> A.Source:
        if self.now.kind == "schema":
            schema, method = self.schema_method()
            args = self.arguments()
            return A.Source("function", self.alias(""), schema, method, args)
        begin = self.at
        parts = self.path()
        if len(parts) == 1:
            args = self.arguments() if self.op("(") else ()
            return A.Source("named", self.alias(parts[0]), None, parts[0], args)
        self.at = begin
        value = self.postfix()
        return A.Source("value", self.alias(parts[-1]), value=value)

    def join(self) -> A.Join | None:
        for words, kind in (
            (("inner", "join"), "inner"), (("left", "outer", "join"), "left"), (("right", "outer", "join"), "right"), (("full", "outer", "join"), "full"),
            (("left", "join"), "left"), (("right", "join"), "right"), (("full", "join"), "full"), (("join",), "inner"),
            (("cross", "apply"), "cross apply"), (("outer", "apply"), "outer apply"),
        ):
            if self.take_word(*words):
                source = self.source()
                on = None
                if "apply" not in kind:
                    self.need_word("on")
                    on = self.expr()
                return A.Join(kind, source, on)
        return None

    def arguments(self) -> tuple[A.Node, ...]:
        self.need_op("(")
        args = []
        while not self.take_op(")"):
            args.append(self.expr())
            if not self.op(")"):
                self.need_op(",")
        return tuple(args)

    # -- expressions
    def expr(self) -> A.Node:
        left = self.conjunction()
        while self.take_word("or"):
            left = A.Binary("or", left, self.conjunction())
        return left

    def conjunction(self) -> A.Node:
        left = self.negation()
        while self.take_word("and"):
            left = A.Binary("and", left, self.negation())
        return left

    def negation(self) -> A.Node:
        return A.Unary("not", self.negation()) if self.take_word("not") else self.comparison()

    def comparison(self) -> A.Node:
        left = self.binary(0)
        while True:
            if self.now.kind == "op" and self.now.text in ("=", "<>", "!=", "<", ">", "<=", ">="):
                op = self.now.text.replace("!=", "<>")
                self.at += 1
                left = A.Binary(op, left, self.binary(0))
                continue
            if self.take_word("is"):
                negated = self.take_word("not")
                self.need_word("null")
                left = A.IsNull(left, negated)
                continue
            negated = self.word("not") and self.take_word("not")
            if self.take_word("like"):
                node: A.Node = A.Binary("like", left, self.binary(0))
            elif self.take_word("rlike"):
                node = A.Binary("rlike", left, self.binary(0))
            elif self.take_word("in"):
                left = A.In(left, self.arguments(), negated)
                continue
            elif self.take_word("contains"):
                node = A.In(left, self.arguments())
            elif self.take_word("between"):
                low = self.binary(0)
                self.need_word("and")
                left = A.Between(left, low, self.binary(0), negated)
                continue
            elif negated:
                raise ParseError(f"unexpected not at {self.now.begin}")
            else:
                return left
            left = A.Unary("not", node) if negated else node

    _LEVELS = (("|", "^"), ("&",), ("<<", ">>"), ("+", "-", "||"), ("*", "/", "%"))

    def binary(self, level: int) -> A.Node:
        if level == len(self._LEVELS):
            return self.unary()
        left = self.binary(level + 1)
        while self.now.kind == "op" and self.now.text in self._LEVELS[level]:
            op = self.now.text
            self.at += 1
            left = A.Binary(op, left, self.binary(level + 1))
        return left

    def unary(self) -> A.Node:
        for op in ("-", "+", "~"):
            if self.take_op(op):
                return A.Unary(op, self.unary())
        return self.postfix()

    def postfix(self) -> A.Node:
        node = self.primary()
        while True:
            if self.take_op("."):
                if self.take_op("*"):
                    return A.Star(node.parts[0])
                name = self.name()
                if self.op("("):
                    node = A.Call(name, self.arguments(), node)
                elif isinstance(node, A.Name):
                    node = A.Name((*node.parts, name))
                else:
                    node = A.Field(node, name)
            elif self.take_op("["):
                node = A.Index(node, self.expr())
                self.need_op("]")
            else:
                return node

    def primary(self) -> A.Node:
        token = self.now
        if token.kind in ("number", "string"):
            self.at += 1
            return A.Literal(token.value)
        if self.take_op("("):
            inner = self.expr()
            self.need_op(")")
            return inner
        if self.take_op("*"):
            return A.Star()
        if token.kind == "name":
            low = token.text.lower()
            if low in ("null", "true", "false") and not (self.tokens[self.at + 1].text in (".", "(")):
                self.at += 1
                return A.Literal({"null": None, "true": True, "false": False}[low])
            if low == "case":
                return self.case()
        if token.kind in ("name", "quoted"):
            name = self.name()
            if self.op("(") and token.kind == "name":
                if self.tokens[self.at + 1].kind == "name" and self.tokens[self.at + 1].text.lower() == "distinct":
                    self.at += 2
                    args = self.list_of_exprs()
                    self.need_op(")")
                    return A.Call(name, args, None, True)
                return A.Call(name, self.arguments())
            return A.Name((name,))
        raise ParseError(f"unexpected {token.text!r} at {token.begin}")

    def case(self) -> A.Node:
        self.need_word("case")
        operand = None if self.word("when") else self.expr()
        whens = []
        while self.take_word("when"):
            condition = self.expr()
            self.need_word("then")
            whens.append((condition, self.expr()))
        otherwise = self.expr() if self.take_word("else") else None
        self.need_word("end")
        return A.Case(tuple(whens), otherwise, operand)


def parse(text: str) -> list[object]:
    return Parser(text).script()
