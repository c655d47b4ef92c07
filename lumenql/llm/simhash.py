"""SimHash near-deduplication over a Gray-order hierarchical index.

1. Each text becomes a 64-bit fingerprint of its word shingles.
2. Equal fingerprints are one node, named by its smallest document.
3. The 64 bits form five blocks; fingerprints that differ in at most three bits agree in
   two blocks at least, so each node is dealt to the ten pairs of blocks. A pair's common
   value names a bucket of about 26 bits.
4. In each bucket a Gray-order index links nodes (``gray.py``). A bucket above
   ``bucket_rows`` is dealt again by parts of its free bits, so no bucket outgrows a task
   and no pair is lost.
5. Buckets yield stars, which large-star and small-star steps join to components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_few, in_groups, materialize, text_key
from .components import connected_components
from .gray import gray_rank, link

BITS, SEED, RADIUS = 64, 42, 3
WIDTHS = (13, 13, 13, 13, 12)
#: Last level of dealing; see ``bucket_links``.
DEEPEST = 3
#: Shingles that are hashed at once.
SLICE = 1 << 16
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
_BYTE_AT = (np.arange(8) * 256)[None, :]


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, by byte and bit."""
    return np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE_AT).ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE


def _pack(ones: np.ndarray, n: int) -> int:
    return int(np.packbits((2 * ones > n).ravel(), bitorder="little").view(np.int64)[0])


def mark_bits(hashes: np.ndarray) -> int:
    """SimHash of 64-bit hashes, as a signed integer: a bit is 1 if over half of them have it."""
    ones = np.zeros((8, 8))
    for begin in range(0, len(hashes), SLICE):
        ones += _ones(hashes[begin : begin + SLICE])
    return _pack(ones, len(hashes))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles as a signed 64-bit integer.

    A-Z is lower-cased, words are runs without ASCII white space, and repeated shingles
    count each time. Fewer words than ``shingle`` make one shingle; no word gives zero.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - shingle + 1)
    ones = np.zeros((8, 8))
    digest = xxhash.xxh64_intdigest
    for begin in range(0, n, SLICE):
        part = tokens[begin : begin + SLICE + shingle - 1]
        rows = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(part) >= shingle else [b" ".join(part)]
        hashes = np.fromiter((digest(x, SEED) for x in rows), dtype=np.uint64)
        ones += _ones(hashes)
    return _pack(ones, n)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: ``doc_id``, ``fp`` (signed 64-bit) and the long columns ``keep``. Null texts count as empty."""
    names = ["doc_id", "fp", *keep]

    def run(batches):
        for batch in batches:
            fps = [fingerprint(x.as_py(), shingle) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _masks(level: int) -> list[int]:
    """The bits that the members of each kind of bucket share.

    At level 0 the kinds are the pairs of blocks. The kinds ``4 * k`` to ``4 * k + 3`` below
    kind ``k`` add a quarter of its free bits each: fingerprints that differ in three bits
    share one quarter at least.
    """
    if level:
        free = lambda mask: [1 << k for k in range(BITS) if not mask >> k & 1]
        return [mask | sum(free(mask)[k :: RADIUS + 1]) for mask in _masks(level - 1) for k in range(RADIUS + 1)]
    low, block = 0, []
    for width in WIDTHS:
        block.append((1 << width) - 1 << low)
        low += width
    return [a | b for a, b in combinations(block, 2)]


def _dealt(rows: DataFrame, kinds: Column, level: int) -> DataFrame:
    """Rows in the buckets of an array of kinds: ``kind``, ``part`` (the shared bits), ``fp``, ``rep``."""
    masks = F.array(*(F.lit(m - (1 << BITS) if m >> BITS - 1 else m).cast("long") for m in _masks(level)))
    out = rows.select("fp", "rep", F.explode(kinds).alias("kind"))
    return out.select(F.col("kind").cast("long").alias("kind"), F.col("fp").bitwiseAND(F.element_at(masks, F.col("kind").cast("int") + 1)).alias("part"), "fp", "rep")


def gray_stars(table: pa.Table, keys: list[str], name: str, radius: int):
    """Stars of the fingerprints that link within groups of ``keys``, by the values of the column ``name``."""
    columns = [table.column(k).to_numpy() for k in keys]
    group = np.cumsum(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])
    several = np.bincount(group)[group] > 1
    values, own, group = table.column("fp").to_numpy()[several].view(np.uint64), table.column(name).to_numpy()[several], group[several]
    order = np.lexsort((gray_rank(values), group))
    values, own, group = values[order], own[order], group[order]
    label = link(values, group, radius)
    child = np.flatnonzero(label != np.arange(len(label)))
    if len(child):
        yield pa.RecordBatch.from_arrays([pa.array(own[child]), pa.array(own[label[child]])], ["a", "b"])


def bucket_links(nodes: DataFrame, radius: int = RADIUS, bucket_rows: int = 4096) -> DataFrame:
    """Stars of links within buckets: columns ``a``, ``b`` (node ids), from distinct ``fp`` and their ``rep``.

    A bucket above ``bucket_rows`` is dealt again by quarters of its free bits, level by
    level; at ``DEEPEST`` 18 free bits are left, so no bucket holds more than 2**18
    fingerprints. A node is in ten buckets, and in four for each one that was too large:
    the number of rows never grows with the square of a bucket's size.
    """
    if radius > RADIUS:
        raise ValueError(f"five blocks find links of {RADIUS} differing bits at most")
    use = lambda table: gray_stars(table, ["kind", "part"], "rep", radius)
    rows = _dealt(nodes, F.sequence(F.lit(0), F.lit(len(_masks(0)) - 1)), 0)
    out = None
    for level in range(DEEPEST + 1):
        part, crowded = rows, None
        if level < DEEPEST:
            # The key is written differently from the rows', so that a crowded bucket's rows can be split in the joins.
            key = F.col("part").bitwiseXOR(F.lit(1))
            crowded, _ = materialize(rows.groupBy("kind", "part").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows).select(F.col("kind").alias("k"), key.alias("p")), "crowded")
            if crowded.isEmpty():
                crowded = None
            else:
                meet = (F.col("kind") == F.col("k")) & (key == F.col("p"))
                part = rows.join(crowded, meet, "left_anti")
                below = F.transform(F.sequence(F.lit(0), F.lit(RADIUS)), lambda k: F.col("kind") * (RADIUS + 1) + k)
                rows, _ = materialize(_dealt(rows.join(crowded, meet, "left_semi"), below, level + 1), "crowded-rows")
        found = in_groups(part, ["kind", "part"], use, "a long, b long", together=True)
        out = found if out is None else out.union(found)
        if crowded is None:
            break
    return out


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, radius: int = RADIUS, bucket_rows: int = 4096) -> DataFrame:
    """Fingerprint and near-duplicate group of every document.

    Returns ``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the
    smallest ``doc_id`` that links of ``radius`` or fewer differing bits reach.

    Null and empty texts have fingerprint zero, which links like any other. Rows that
    repeat a document give one row each. A row without ``doc_id`` has a fingerprint and
    the component of the documents that share it, else null; it links nothing itself.
    Other columns are ignored, and an empty table gives no row.
    """
    by_doc, _ = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes, _ = materialize(by_doc.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    found, _ = connected_components(bucket_links(nodes.where("rep is not null"), radius, bucket_rows))
    named = nodes.join(found, nodes.rep == found.hi, "left").select(F.col("fp").alias("of"), F.coalesce("lo", "rep").alias("component_id"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return by_doc.join(named, by_doc.fp == named.of, "left").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class, columns unchanged.

    ``classes`` has ``doc_id``, the text's key ``a``, ``b``, and ``class``, for every row of
    ``docs``. The row with the smallest id stays, one without an id only where no other is
    in the class; among texts that share this id the one with the smallest key, and of
    rows that repeat both, one.
    """
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "a", "b")
    rows = classes.groupBy("class", "doc_id", "a", "b").agg(F.count("*").alias("n"))
    stays = rows.groupBy("class").agg(F.min(F.struct(*(first[c].alias(c) for c in ("unnamed", "doc_id", "a", "b")), "n")).alias("s"))
    stays, _ = materialize(in_few(stays, docs.count()).select(F.col("s.doc_id").alias("__id"), F.col("s.a").alias("__a"), F.col("s.b").alias("__b"), (F.col("s.n") > 1).alias("__more")), "stays")
    a, b = text_key(docs[text_col])
    meet = lambda side: (a == side["__a"]) & (b == side["__b"]) & docs[id_col].cast("long").eqNullSafe(side["__id"])
    single, several = stays.where("not __more"), stays.where("__more")
    repeated = docs.join(several, meet(several), "left_semi")
    # Rows that repeat are told by id and key; the other columns come from any one of them.
    whole = repeated.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("i"), *(k.alias(n) for k, n in zip(text_key(F.col(text_col)), ("x", "y"))))
    one = whole.dropDuplicates(["i", "x", "y"]).select("row.*")
    return docs.join(single, meet(single), "left_semi").union(one)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each group of documents that ``simhash_components`` links, columns unchanged.

    The row with the smallest id stays. Rows are told apart by id and text: a text that
    shares its id with another group's is a document of its own, and of rows that repeat
    id and text one stays. Rows without an id belong to the group of their text. Null and
    empty texts are one group; very long texts are read whole; an empty table stays empty.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints, _ = materialize(fingerprints(keyed.withColumns(dict(zip("ab", text_key(F.col("text"))))), shingle=options.get("shingle", 3), keep=("a", "b")), "fingerprints")
    nodes, _ = materialize(prints.select("fp", F.col("fp").alias("rep")).distinct(), "nodes")
    found, _ = connected_components(bucket_links(nodes, options.get("radius", RADIUS), options.get("bucket_rows", 4096)))
    named = nodes.join(found, nodes.rep == found.hi, "left").select(F.col("fp").alias("of"), F.coalesce("lo", "fp").alias("class"))
    return keep_one(docs, prints.join(named, prints.fp == named.of).select("doc_id", "a", "b", "class"), id_col, text_col)
