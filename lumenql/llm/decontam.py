"""Benchmark decontamination by template canonicalisation.

Texts become templates: words lower-cased, numbers (in digits or in words), names and
units replaced by typed placeholders. Windows of five template tokens are hashed, and a
document's windows meet the benchmark's in a hash join. A match of window positions gives
an alignment of a document with an item; within it the tokens must agree and the slots
must be consistent: one value of the item stands for one value of the document
throughout, and the other way round. Windows with a slot that breaks this do not count,
unless their values are equal. Questions that were re-parameterised pass, chance meetings
of different slots do not. An item is leaked if aligned windows cover enough of its
tokens; an item shorter than a window is leaked if it stands in a document as it is.
Scripts without spaces between words have a token for each character.

Names are capitalised words inside sentences. As copies may change case, items and
documents are compared in two forms: with names as slots, and caseless with names as
words. A window of fewer than two words besides its slots says nothing by its template
and is joined by its values.

Only windows that pass a bitmap of the benchmark's hashes are shuffled. The bitmap has a
fixed size; the benchmark itself is a table of the join and never reaches the driver.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_groups, materialize, released, text_key
from .pretoken import Cache

WINDOW, COVERAGE = 5, 0.5
#: Words that a window's template must hold; with fewer it counts by its values alone.
LEAST_WORDS = 2
#: Leading bits of a hash that the bitmap tells apart: 8 MB, whatever the benchmark's size.
BITMAP_BITS = 26
#: Letters and marks of scripts without spaces between words; each is a token of its own.
_SINGLE = "\u0E01-\u0E3A\u0E40-\u0E4E\u0E81-\u0ECE\u0EDC-\u0EDF\u1000-\u103F\u1050-\u108F\u1780-\u17D3\u3005-\u3007\u3041-\u309A\u309D-\u309F\u30A1-\u30FA\u30FC-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF"
TOKEN = re.compile(rf"\d+(?:[.,:]\d+)*|[^\W\d_{_SINGLE}]+|[{_SINGLE}]|[.!?\n]")
WORD, CAPITAL, NUMBER, END, UNIT, NUMERAL = range(6)
#: Words that are numbers; a run of them is one number.
NUMERALS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
#: Unit words that follow a number.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr hrs hour hours minute minutes second seconds day days week weeks month months year years meter meters metre metres kilometer kilometers mile miles gram grams kilogram kilograms pound pounds liter liters litre litres dollar dollars cent cents euro euros usd eur percent degrees kb mb gb".split())
_MULTIPLIER = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1 | 1 for k in range(WINDOW)], dtype=np.uint64)
_SLOT = {NUMBER: np.uint64(0x6E756D0000000002), CAPITAL: np.uint64(0x6E616D6500000001), UNIT: np.uint64(0x756E697400000004)}


#: What a character is to ``TOKEN``: nothing, part of a number or a word, or a token of its own.
_GAP, _DIGIT, _LETTER, _ALONE, _STOP = range(5)
#: Flags beside that: it may join digits, its token is a number or a name if it stands first.
_JOINS, _DIGITAL, _UPPER = 8, 16, 32
#: Factor of a character's value by its place in a token, as a power.
_BASE = np.uint64(0xD1342543DE82EF95)
#: Characters that are cut into tokens at once, up to the next white space: about 40 bytes of memory for each.
_PIECE = 1 << 20
_BREAK = re.compile(r"\s")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: class and flags, and a value in which case makes no difference."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    flags = np.zeros(len(every), np.uint8)
    for kind, pattern in ((_STOP, r"[.!?\n]"), (_LETTER, r"[^\W_]+"), (_ALONE, f"[{_SINGLE}]+"), (_DIGIT, r"\d+")):
        for run in re.finditer(pattern, every):
            flags[run.start() : run.end()] = kind
    flags[[ord(c) for c in ".,:"]] |= _JOINS
    tokens = np.flatnonzero(flags).tolist()
    for flag, test in ((_DIGITAL, str.isdigit), (_UPPER, str.isupper)):
        flags[[p for p in tokens if test(every[p])]] |= flag
    # The one character whose lower case is two takes the slow way.
    low = np.frombuffer(every.replace("\u0130", " ").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return flags, _mixed((low.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """At least the first ``n`` powers of ``_BASE``."""
    global _powers
    if len(_powers) < n:
        _powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(2 * n, _BASE)])
    return _powers


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.intp)


def _word_code(low: str) -> int:
    total, factor = 0, 1
    for at in range(0, len(low), _PIECE):
        points = _points(low[at : at + _PIECE])
        total += factor * int((_characters()[1][points] * _power(len(points))[: len(points)]).sum())
        factor = factor * pow(int(_BASE), len(points), 1 << 64) % (1 << 64)
    return int(_mixed(np.array([total % (1 << 64)], np.uint64))[0]) & ~7


@cache
def _known() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of units and numerals in order, their kinds, and a table of the leading 16 bits that occur."""
    kinds = {_word_code(w): NUMERAL for w in NUMERALS} | {_word_code(w): UNIT for w in UNITS}
    codes = np.array(sorted(kinds), np.uint64)
    first = np.zeros(1 << 16, bool)
    first[codes >> np.uint64(48)] = True
    return codes, np.array([kinds[c] for c in sorted(kinds)], np.uint64), first


def _token_code(token: str) -> int:
    """A 64-bit code whose low three bits are the token's kind. Case does not change the rest."""
    if token[0] in ".!?\n":
        return END
    low = token.lower()
    code = _word_code(low)
    if token[0].isdigit():
        return code | NUMBER
    if low in UNITS:
        return code | UNIT
    if low in NUMERALS:
        return code | NUMERAL
    return code | (CAPITAL if token[0].isupper() else WORD)


def _piece_codes(text: str) -> np.ndarray:
    flags, values = _characters()
    points = _points(text)
    flag = flags[points]
    kind = flag & np.uint8(7)
    join = np.flatnonzero(flag & np.uint8(_JOINS))
    join = join[(join > 0) & (join < len(points) - 1)]
    kind[join[(kind[join - 1] == _DIGIT) & (kind[join + 1] == _DIGIT)]] = _DIGIT
    first = kind >= _ALONE
    first[1:] |= kind[1:] != kind[:-1]
    first[:1] = True
    inside = np.flatnonzero(kind)
    begin = np.flatnonzero(first[inside])
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = np.diff(begin, append=len(inside))
    offset = np.arange(len(inside)) - np.repeat(begin, length)
    code = _mixed(np.add.reduceat(values[points[inside]] * _power(int(length.max()))[offset], begin)) & ~np.uint64(7)
    start = inside[begin]
    flag = flag[start]
    out = np.where(flag & np.uint8(_UPPER), np.uint64(CAPITAL), np.uint64(WORD))
    known, kinds, leading = _known()
    some = np.flatnonzero(leading[code >> np.uint64(48)])
    place = np.minimum(np.searchsorted(known, code[some]), len(known) - 1)
    same = known[place] == code[some]
    out[some[same]] = kinds[place[same]]
    out[flag & np.uint8(_DIGITAL) > 0] = NUMBER
    code |= out
    code[kind[start] == _STOP] = END
    return code


def token_codes(text: str, codes: Cache) -> np.ndarray:
    """``_token_code`` of each match of ``TOKEN``, for all characters at once.

    Texts with one of the two letters whose lower case is not one letter, always the same,
    and long pieces without white space are cut by the expression; ``codes`` keeps their codes.
    """
    singly = "\u0130" in text or "\u03A3" in text
    parts, at = [np.zeros(0, np.uint64)], 0
    while at < len(text):
        cut = _BREAK.search(text, at + _PIECE)
        end = cut.start() if cut else len(text)
        if singly or end - at > 4 * _PIECE:
            tokens = TOKEN.findall(text, at, end)
            parts.append(np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens)))
        else:
            parts.append(_piece_codes(text[at:end]))
        at = end
    return np.concatenate(parts)


@dataclass
class Template:
    """Codes of a text's tokens (``value``), their kinds, and the two template forms."""

    value: np.ndarray
    typed: np.ndarray
    caseless: np.ndarray
    slot: np.ndarray


def template(text: str, codes: Cache) -> Template:
    coded = token_codes(text, codes)
    kind = (coded & np.uint64(7)).astype(np.int8)
    after_end = np.r_[True, kind[:-1] == END][: len(kind)]
    word = kind != END
    kind, coded, after_end = kind[word], coded[word] & ~np.uint64(7), after_end[word]
    if (kind == NUMERAL).any():
        # A run of number words becomes one number, named by all of them.
        more = np.r_[False, (kind[1:] == NUMERAL) & (kind[:-1] == NUMERAL)]
        begin = np.flatnonzero(~more)
        mixed = coded * np.where(more, _MULTIPLIER[1], np.uint64(1))
        coded, kind, after_end = np.add.reduceat(mixed, begin), np.where(kind == NUMERAL, NUMBER, kind)[begin], after_end[begin]
    kind = np.where((kind == UNIT) & ~np.r_[False, kind[:-1] == NUMBER][: len(kind)], WORD, kind)
    names = (kind == CAPITAL) & ~after_end
    caseless = coded.copy()
    caseless[kind == NUMBER] = _SLOT[NUMBER]
    caseless[kind == UNIT] = _SLOT[UNIT]
    typed = caseless.copy()
    typed[names] = _SLOT[CAPITAL]
    slot = np.where(kind == NUMBER, 1, np.where(kind == UNIT, 2, np.where(names, 3, 0))).astype(np.int8)
    return Template(coded, typed, caseless, slot)


def windows(codes: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """One hash for each window of ``width`` codes, ``WINDOW`` at most."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        part = codes[k : k + n] * _MULTIPLIER[k]
        out += part ^ (part >> np.uint64(29))
    return out


class _Found:
    """Windows of one text that may be joined: hash, place, width, values and slots."""

    def __init__(self, text: Template, widths: tuple[int, ...], bitmap: np.ndarray | None):
        self.rows = []
        words = np.convolve(text.slot == 0, np.ones(WINDOW, int), "valid") if len(text.value) >= WINDOW else np.zeros(0, int)
        names = text.slot == 3
        if WINDOW in widths and len(words):
            # By the template without names, by the template with names, by the values.
            told = words + np.convolve(names, np.ones(WINDOW, int), "valid")
            hashes, plain = windows(text.caseless), told < LEAST_WORDS
            if plain.any():
                hashes[plain] = windows(text.value)[plain] ^ _PLAIN
            self._add(hashes, WINDOW, text, bitmap, None)
            if names.any():
                named = np.convolve(names, np.ones(WINDOW, int), "valid") > 0
                self._add(windows(text.typed), WINDOW, text, bitmap, named & (words >= LEAST_WORDS))
        for width in widths:
            # An item below the window width is one window of its values.
            if width < WINDOW and len(text.value) >= width and (bitmap is not None or len(text.value) == width):
                self._add(windows(text.value, width) ^ _SHORT[width], width, text, bitmap, None)

    def _add(self, hashes: np.ndarray, width: int, text: Template, bitmap: np.ndarray | None, mask: np.ndarray | None) -> None:
        if bitmap is not None:
            top = hashes >> np.uint64(64 - BITMAP_BITS)
            seen = (bitmap[top >> np.uint64(3)] >> (top & np.uint64(7)).astype(np.uint8)) & 1 > 0
            mask = seen if mask is None else mask & seen
        at = np.arange(len(hashes)) if mask is None else np.flatnonzero(mask)
        if len(at):
            place = at[:, None] + np.arange(WINDOW)
            inside = np.arange(WINDOW) < width
            place = np.where(inside, place, 0)
            self.rows.append((hashes[at], at, np.full(len(at), width), np.where(inside, text.value[place], np.uint64(0)), np.where(inside, text.slot[place], 0).astype(np.int8)))


#: Keep hashes of values apart from those of templates, by width.
_PLAIN = np.uint64(0x706C61696E000005)
_SHORT = {k: np.uint64(0x73686F7274000000 + k) for k in range(1, WINDOW)}
_WINDOWS_DDL = "hash long, at long, width long, length long, value binary, slot binary"


def _window_rows(keys: list[str], widths: tuple[int, ...], bitmap):
    """A function for ``mapInArrow``: long columns ``keys``, then the text; out go the keys and its windows."""

    def run(batches):
        codes = Cache(_token_code, 1 << 17)
        seen = bitmap and bitmap.value()
        for batch in batches:
            of, length, parts = [], [], []
            for k, text in enumerate(batch.column(len(keys))):
                if text.is_valid:
                    made = template(text.as_py(), codes)
                    for part in _Found(made, widths, seen).rows:
                        of.append(np.full(len(part[0]), k))
                        length.append(np.full(len(part[0]), len(made.value)))
                        parts.append(part)
            if not parts:
                continue
            row = pa.array(np.concatenate(of))
            hashes, at, width, value, slot = (np.concatenate(x) for x in zip(*parts))
            raw = lambda x: pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.dtype.itemsize * WINDOW), len(x), [None, pa.py_buffer(x.tobytes())]).cast(pa.binary())
            out = [*(c.take(row) for c in batch.columns[: len(keys)]), pa.array(hashes.view(np.int64)), pa.array(at), pa.array(width), pa.array(np.concatenate(length)), raw(value), raw(slot)]
            yield pa.RecordBatch.from_arrays(out, [*keys, "hash", "at", "width", "length", "value", "slot"])

    return run


class _Bitmap:
    """The benchmark's hashes by their leading bits, as the blocks that hold any."""

    def __init__(self, hashes: DataFrame):
        place = F.shiftrightunsigned("hash", 64 - BITMAP_BITS) + 1
        bits = hashes.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        self.shared = hashes.sparkSession.sparkContext.broadcast([(r.k, bytes(r.bits)) for r in bits.collect()])

    def value(self) -> np.ndarray:
        out = np.zeros(1 << BITMAP_BITS - 3, np.uint8)
        for k, bits in self.shared.value:
            out[(k - 1) * len(bits) : k * len(bits)] = np.frombuffer(bits, np.uint8)
        return out


def _consistent(at: np.ndarray, shift: int, x: np.ndarray, y: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, int]:
    """The windows of an alignment that count, and the number of differing slot values in them.

    ``x``, ``y`` and ``kind`` are values of the item, of the document, and slot kinds, a row
    for each window start in ``at``. Windows count whose slots map one to one throughout
    the alignment, and always those with equal values; a slot in conflict takes only the
    windows that touch it.
    """
    spans = at[:, None] + np.arange(WINDOW)
    here, first, place = np.unique(spans, return_index=True, return_inverse=True)
    place = place.reshape(spans.shape)
    x, y, kind = x.ravel()[first], y.ravel()[first], kind.ravel()[first]
    equal, slot = x == y, kind != 0
    good = equal | slot
    pairs, of = np.unique(np.stack([kind[slot].astype(np.uint64), x[slot], y[slot]]), axis=1, return_inverse=True)
    alone = np.ones(pairs.shape[1], bool)
    for side in (1, 2):
        _, group, n = np.unique(pairs[[0, side]], axis=1, return_inverse=True, return_counts=True)
        alone &= n[group.ravel()] == 1
    good[slot] = alone[of.ravel()]
    keep = good[place].all(axis=1) | equal[place].all(axis=1)
    seen = np.zeros(len(here), bool)
    seen[place[keep]] = True
    differ = seen[slot] & ~equal[slot]
    return at[keep], len(np.unique(of.ravel()[differ]))


def _judge(coverage: float):
    """The leak, if it is one, of the joined windows of one document and one item."""

    def use(table: pa.Table):
        number = lambda c: table.column(c).to_numpy()
        flat = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind).reshape(-1, WINDOW)
        pos, at, width = number("pos"), number("at"), int(number("width")[0])
        x, y, kind = flat("item_value", np.uint64), flat("value", np.uint64), np.maximum(flat("item_slot", np.int8), flat("slot", np.int8))
        if width < WINDOW:
            out = (len(np.unique(pos[(x == y).all(axis=1)])), 1.0, 0)
            if not out[0]:
                return
        else:
            covered, used, changed = np.zeros(int(number("length")[0]), bool), 0, 0
            for shift in np.unique(pos - at).tolist():
                line = np.flatnonzero(pos - at == shift)
                starts, first = np.unique(at[line], return_index=True)
                line = line[first]
                kept, agreed = _consistent(starts, shift, x[line], y[line], kind[line])
                covered[kept[:, None] + np.arange(WINDOW)] = True
                used += len(kept)
                changed = max(changed, agreed)
            out = (used, float(covered.mean()), changed)
            if out[1] < coverage:
                return
        ids = [table.column(c)[0].as_py() for c in ("doc_id", "a", "b", "item_id")]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.float64() if isinstance(v, float) else pa.int64()) for v in (*ids, *out)], ["doc_id", "a", "b", "item_id", "n_windows", "coverage", "n_changed_slots"])

    return use


_LEAKS_DDL = "doc_id long, a long, b long, item_id long, n_windows long, coverage double, n_changed_slots long"


def leaks_by_text(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """``find_leaks`` with the key ``a``, ``b`` of the document's text, so that rows that share an id stay apart."""
    item = benchmark.select(F.col(item_col).cast("long").alias("item_id"), *(k.alias(n) for k, n in zip(text_key(F.col(item_text_col)), "cd")), F.col(item_text_col).alias("text"))
    item = item.dropDuplicates(["item_id", "c", "d"])
    every = tuple(range(1, WINDOW + 1))
    items, _ = materialize(item.mapInArrow(released(_window_rows(["item_id", "c", "d"], every, None)), f"item_id long, c long, d long, {_WINDOWS_DDL}"), "benchmark-windows")
    # One row for each width, five at most.
    widths = tuple(sorted(r.width for r in items.select("width").distinct().collect()))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(k.alias(n) for k, n in zip(text_key(F.col(text_col)), "ab")), F.col(text_col).alias("text"))
    if not widths:
        return docs.sparkSession.createDataFrame([], _LEAKS_DDL)
    found = rows.mapInArrow(released(_window_rows(["doc_id", "a", "b"], widths, _Bitmap(items))), f"doc_id long, a long, b long, {_WINDOWS_DDL}")
    found = found.select("doc_id", "a", "b", F.col("hash").alias("__hash"), F.col("at").alias("pos"), "value", "slot")
    items = items.withColumnsRenamed({"value": "item_value", "slot": "item_slot"})
    met = found.join(items, F.col("__hash") == F.col("hash")).drop("hash", "__hash")
    # Groups are told by long columns without nulls.
    names = {"doc_id": ("di", "dn"), "item_id": ("ii", "in")}
    met = met.withColumns({n: v for c, (i, k) in names.items() for n, v in ((i, F.coalesce(c, F.lit(0).cast("long"))), (k, F.col(c).isNull().cast("long")))})
    return in_groups(met, ["a", "b", "di", "dn", "c", "d", "ii", "in"], _judge(coverage), _LEAKS_DDL)


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Pairs of documents and the benchmark items that they hold.

    Returns ``doc_id, item_id, n_windows, coverage, n_changed_slots``; options are the
    column names ``id_col, text_col, item_col, item_text_col`` and the ``coverage``.

    Null and empty texts hold nothing, and nothing is found of items without a token.
    Items of fewer than five tokens are found where all their tokens stand with equal
    values; ``n_windows`` then counts the places. Rows that repeat a document's id and text
    give one row for each item, texts that share an id one each. Very long texts are
    searched whole, extra columns are ignored, and an empty table on either side gives no row.
    """
    return leaks_by_text(docs, benchmark, **options).drop("a", "b")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows whose text holds no benchmark item, columns unchanged.

    Rows are told by id and text, so a clean text stays though another row of its id goes;
    a null id is an id like any other. Only ids and keys meet in the join: leaked ones are
    few, and adaptive execution broadcasts them where their size allows.
    """
    leaked = leaks_by_text(docs, benchmark, id_col=id_col, text_col=text_col, **options).select(F.col("doc_id").alias("__id"), F.col("a").alias("__a"), F.col("b").alias("__b")).distinct()
    a, b = text_key(docs[text_col])
    return docs.join(leaked, (a == F.col("__a")) & (b == F.col("__b")) & docs[id_col].cast("long").eqNullSafe(F.col("__id")), "left_anti")
