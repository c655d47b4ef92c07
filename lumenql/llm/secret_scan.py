"""Secret scanning with DataFrame expressions only.

Base rules find assignments, access keys and long hexadecimal runs by pattern. The
method then slides a window over every other candidate string, keeps the counts of the
characters in the window, updates the window's Shannon entropy from the one count that
a step raises and the one it lowers, and compares it with the limit of the candidate's
character class. An allow-list suppresses known harmless strings.

Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, running

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_GATE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"(AKIA[A-Z0-9]{14,})()"
HEX = r"([0-9a-f]{16,})()"
VALUE_CHARS = 12
CLASS = "A-Za-z0-9+/_=-"
#: A maximal run of candidate characters with a digit in it.
CANDIDATE = rf"((?<![{CLASS}])(?=[A-Za-z+/_=-]*[0-9])[{CLASS}]{{%d,}})()"
#: Strings that look random and are not secret: identifiers, integrity tags, counting runs, placeholders.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^sha(1|256|384|512)-",
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx",
    r"(?i)0123456789|abcdefghij",
)
#: Candidates of one letter case, grouped keys and padding included; two runs of digits at least.
SINGLE_CASE = r"^([a-z0-9]+|[A-Z0-9]+=*|[A-Z0-9]{4,8}(-[A-Z0-9]{4,8}){2,})$"
TWO_RUNS = r"[0-9][^0-9]+[0-9]"
#: Candidates of one case need a digit for so many characters; words and identifiers have fewer.
DIGIT_EVERY = 16
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_SCALE = 1_000_000
#: Counts of a window: candidate characters from ``+`` to ``z``, ten six-bit counts in each of eight words.
FIRST, CELLS = 43, 10


@dataclass(frozen=True)
class Rules:
    """Parameters of the scan: window width (62 at most), entropy limits in bits by class, allow-list patterns.

    ``single_bits`` is the limit of candidates of one letter case that are not pure
    hexadecimal. Other candidates without letters of both cases (paths, words joined by
    signs) are no class of their own and are not scanned.
    """

    window: int = 20
    hex_bits: float = 3.0
    alnum_bits: float = 3.6
    base64_bits: float = 3.7
    single_bits: float = 3.3
    allowed: tuple[str, ...] = field(default=ALLOWED)

    def most(self, bits: float) -> int:
        """The largest sum of c*log2(c), in millionths, at which a window still has ``bits``."""
        return math.floor((math.log2(self.window) - bits) * self.window * _SCALE)

    def terms(self) -> list[int]:
        return [0, *(round(c * math.log2(c) * _SCALE) for c in range(1, self.window + 2))]


def _matches(text: Column, pattern: str, kind: int, shortest: int = 0, told: bool = False) -> Column:
    """Spans of a pattern's matches, with their text if ``told``; a match whose group 2 is shorter than ``shortest`` is passed over."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("value"))

    def step(at: Column, part: Column) -> tuple[Column, Column, Column]:
        start = at + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), *([part["hit"].alias("text")] if told else []))
        return end, span, part["hit"].isNotNull() & (F.length(part["value"]) >= shortest)

    return running(parts, F.lit(0), _SPAN[6:-2] + (",text:string>" if told else ">"), step)


def _none() -> Column:
    return F.array().cast(_SPAN)


def base_spans(text: Column) -> Column:
    """The spans of the three base rules, unordered. ``text`` must not be null."""
    return F.concat(
        F.when(text.rlike(ASSIGN_GATE), _matches(text, ASSIGN, 0, VALUE_CHARS)).otherwise(_none()),
        F.when(text.contains("AKIA"), _matches(text, ACCESS, 1)).otherwise(_none()),
        F.when(text.rlike("[0-9a-f]{16}"), _matches(text, HEX, 2)).otherwise(_none()),
    )


def _hot_part(candidate: Column, rules: Rules) -> Column:
    """From the first to the last window above the class's limit: ``first``, ``last`` (null if none)."""
    terms = F.array(*map(F.lit, rules.terms()))
    kind = F.when(candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(rules.most(rules.hex_bits)))
    mixed = candidate.rlike("[a-z]") & candidate.rlike("[A-Z]")
    kind = kind.when(mixed & candidate.rlike("^[A-Za-z0-9]+$"), F.lit(rules.most(rules.alnum_bits)))
    kind = kind.when(mixed, F.lit(rules.most(rules.base64_bits)))
    digits = F.length(F.regexp_replace(candidate, "[^0-9]", ""))
    single = candidate.rlike(SINGLE_CASE) & candidate.rlike(TWO_RUNS) & (digits * DIGIT_EVERY >= F.length(candidate))
    limit = kind.when(single, F.lit(rules.most(rules.single_bits))).otherwise(F.lit(-1))
    codes = F.transform(F.array_remove(F.split(candidate, ""), ""), lambda c: F.ascii(c) - FIRST)
    gone = F.concat(F.array_repeat(F.lit(-1), rules.window), codes)
    pairs = F.slice(F.arrays_zip(codes.alias("new"), gone.alias("old")), 1, F.length(candidate))
    one = lambda code: F.call_function("shiftleft", F.lit(1).cast("long"), (code % CELLS) * 6)

    def step(acc: Column, p: Column) -> Column:
        at = lambda k: F.call_function("shiftrightunsigned", F.element_at(acc["n"], (k / CELLS).cast("int") + 1), (k % CELLS) * 6).bitwiseAND(F.lit(63).cast("long")).cast("int")
        term = lambda c: F.element_at(terms, c + 1)
        moved = lambda c, k: c + F.when(k == (p["new"] / CELLS).cast("int"), one(p["new"])).otherwise(0) - F.when((p["old"] >= 0) & (k == (p["old"] / CELLS).cast("int")), one(p["old"])).otherwise(0)
        rise = term(at(p["new"]) + 1) - term(at(p["new"]))
        fall = F.when(p["old"] < 0, 0).otherwise(term(at(p["old"]) - 1) - term(at(p["old"])))
        total = acc["s"] + F.when(p["new"] == p["old"], 0).otherwise(rise + fall)
        end = acc["i"] + 1
        hot = (end >= rules.window) & (total <= acc["limit"])
        return F.struct(
            F.transform(acc["n"], moved).alias("n"), total.alias("s"), end.alias("i"), acc["limit"].alias("limit"),
            F.when(hot & acc["first"].isNull(), end - rules.window).otherwise(acc["first"]).alias("first"),
            F.when(hot, end).otherwise(acc["last"]).alias("last"),
        )

    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), 8).alias("n"), F.lit(0).alias("s"), F.lit(0).alias("i"), limit.alias("limit"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    scan = F.aggregate(pairs, zero, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))
    allowed = F.lit(False)
    for pattern in rules.allowed:
        allowed = allowed | candidate.rlike(pattern)
    return F.when(~allowed & (limit >= 0), scan)


def entropy_spans(text: Column, base: Column, rules: Rules) -> Column:
    """Spans that the entropy scan finds; candidates that lie inside a base span are left to it."""
    pattern = CANDIDATE % rules.window

    def scan(found: Column) -> Column:
        def one(span: Column) -> Column:
            hot = bind(span["text"], lambda c: _hot_part(c, rules))
            return bind(hot, lambda h: F.struct((span["start"] + h["first"]).alias("start"), span["kind"].alias("kind"), (span["start"] + h["last"]).alias("end")))

        inside = lambda span: F.exists(base, lambda b: (b["start"] <= span["start"]) & (span["end"] <= b["end"]))
        return F.filter(F.transform(F.filter(found, lambda s: ~inside(s)), one), lambda s: s["start"].isNotNull())

    return F.when(text.rlike(pattern), scan(_matches(text, pattern, 3, told=True))).otherwise(_none())


def scan_secrets(docs: DataFrame, text_col: str = "text", rules: Rules = Rules(), out: str = "secret_spans") -> DataFrame:
    """Adds ``out``: all spans (start, kind, end) sorted; ``kind`` indexes ``KINDS``.

    Null texts count as empty and have none. Equal rows get equal spans. A table without
    rows stays empty, and all columns stay, but one that is named as ``out`` is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.withColumn("__base", base_spans(text))
    return base.withColumn(out, F.array_sort(F.concat("__base", entropy_spans(text, F.col("__base"), rules)))).drop("__base")


def as_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    wanted = [KINDS.index(k) for k in kinds]
    return F.filter(spans, lambda s: s["kind"].isin(wanted))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "<secret>", rules: Rules = Rules()) -> DataFrame:
    """The table with each run of overlapping spans in ``text_col`` replaced by ``mask``.

    Null and empty texts stay as they are, repeated rows are masked alike, very long texts
    are masked whole, other columns are unchanged, and an empty table stays empty.
    """
    text = F.col(text_col)

    def step(at: Column, s: Column) -> tuple[Column, Column, Column]:
        piece = F.concat(F.substring(text, at + 1, s["start"] - at), F.lit(mask))
        return F.greatest(at, s["end"]), piece, s["start"] >= at

    last = F.array_max(F.transform("__spans", lambda s: s["end"]))
    done = F.concat(F.array_join(running(F.col("__spans"), F.lit(0), "string", step), ""), F.substring(text, last + 1, F.length(text)))
    found = scan_secrets(docs, text_col, rules, out="__spans")
    return found.withColumn(text_col, F.when(F.size("__spans") > 0, done).otherwise(text)).drop("__spans")
