"""Near-duplicate groups at a Jaccard similarity of word shingles, found over SimHash fingerprints.

Texts whose five-word shingle sets reach a similarity of 0.8 differ in about ten of 64
fingerprint bits, too many to deal fingerprints by blocks of their bits. So

1. each text gets a SimHash of its set of shingles and 24 routing keys of five minima each
   (a pair at 0.8 meets in one of them with a chance above 0.9999, a closer one more so);
2. where a key's rows meet, the Gray-order index links the fingerprints within ``RADIUS``
   bits; a key above ``bucket_rows`` links all its rows, and is left to the next step;
3. components of these links are candidates. Their texts' shingle sets are compared
   exactly, with a prefix filter, in chunks of bounded size;
4. a candidate larger than a chunk is first linked within chunks and among one text of
   each part found; then only the texts outside its largest part meet the others.

Exact copies are one node throughout, so they never meet in pairs.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TEXT_ROWS, in_few, in_groups, materialize, released, text_key
from .components import connected_components
from .simhash import SEED, gray_stars, keep_one, mark_bits

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
#: Bits at which the index links; a pair at 0.8 differs in more with a chance below one in a million.
RADIUS = 24
#: Rows of a routing key that the index compares, and shingles and texts of a chunk.
BUCKET_ROWS, CHUNK_SHINGLES, CHUNK_TEXTS = 512, 1 << 21, 1024
#: Shingles that are hashed at once.
SLICE = 1 << 12
_TURN = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(SEED + 1).integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; fewer words make one shingle, no word none."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(tokens) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), SEED)], np.uint64)
    rows = map(b" ".join, zip(*(tokens[k:] for k in range(width))))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(r, SEED) for r in rows), np.uint64, len(tokens) - width + 1))


def signature(found: np.ndarray) -> tuple[int, np.ndarray]:
    """SimHash of a set of shingles and its routing keys, both signed."""
    if not len(found):
        return 0, np.zeros(BANDS, np.int64)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for begin in range(0, len(found), SLICE):
        np.minimum(least, (((found[begin : begin + SLICE] ^ _TURN[0]) * _TURN[1]) >> np.uint64(8)).min(axis=1), out=least)
    keys = (least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64)
    keys ^= keys >> np.uint64(31)
    return mark_bits(found), (keys * _MIX[:, 0]).view(np.int64)


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, a, b, node, fp, n, keys`` of every row; ``node`` names the shingle set."""
    schema = "doc_id long, a long, b long, node long, fp long, n long, keys array<long>"

    def run(batches):
        for batch in batches:
            node, fp, n, keys = [], [], [], []
            for text in batch.column(3):
                found = shingles(text.as_py(), width)
                bits, own = signature(found)
                node.append(xxhash.xxh64_intdigest(found.tobytes(), SEED) - (1 << 63))
                fp.append(bits)
                n.append(len(found))
                keys.append(own)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(x, pa.int64()) for x in (node, fp, n)), lists], ["doc_id", "a", "b", "node", "fp", "n", "keys"])

    return docs.mapInArrow(released(run), schema)


def _candidates(signed: DataFrame, rows: int, radius: int, bucket_rows: int) -> DataFrame:
    """Stars of nodes that meet under a routing key within ``radius`` bits; ``rows`` bounds the keys' rows."""
    key = F.xxhash64("band", "value")
    dealt = signed.select("node", "fp", F.posexplode("keys").alias("band", "value")).select(key.alias("bucket"), "node", "fp").distinct()
    dealt, _ = materialize(in_few(dealt, rows), "routed")
    met = dealt.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1")
    # The key is written differently after the aggregate, so that a crowded key's rows can be split in the join.
    met = met.select(F.col("bucket").bitwiseXOR(F.lit(1)).alias("key"), "n", "head")
    routed = dealt.withColumn("key", F.col("bucket").bitwiseXOR(F.lit(1))).join(met, "key").drop("key")
    routed, _ = materialize(in_few(routed, rows), "met")

    use = lambda table: gray_stars(table, ["bucket"], "node", radius)
    few = in_groups(routed.where(F.col("n") <= bucket_rows).select("bucket", "node", "fp"), ["bucket"], use, "a long, b long", together=True)
    return few.union(routed.where((F.col("n") > bucket_rows) & (F.col("node") != F.col("head"))).select("node", "head"))


def link_sets(sets: list[np.ndarray], label: np.ndarray, similarity: float) -> np.ndarray:
    """Join the parts ``label`` (each member's names one member) wherever two sets reach the similarity."""
    part = label.copy()
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
    alike = lambda x, y: len(x) == len(y) == 0 or (inter := len(np.intersect1d(x, y, assume_unique=True))) >= similarity * (len(x) + len(y) - inter) - 1e-9
    held: dict[int, list[int]] = {}
    heads: list[int] = []
    placed: list[int] = []
    for i in order:
        x = sets[i]

        def join(j: int) -> None:
            part[part == part[i]] = part[j]

        # Most texts resemble the first of a part that is there already; then only other parts are left to meet.
        for j in heads:
            if part[j] != part[i] and len(sets[j]) >= similarity * len(x) - 1e-9 and alike(sets[j], x):
                join(j)
        if placed and (part[placed] != part[i]).any():
            prefix = x[: len(x) - ceil(similarity * len(x) - 1e-9) + 1].tolist() or [-1]
            met = np.unique(np.array([j for t in prefix for j in held.get(t, ())], dtype=np.int64))
            for j in met[part[met] != part[i]].tolist():
                if part[j] != part[i] and len(sets[j]) >= similarity * len(x) - 1e-9 and alike(sets[j], x):
                    join(j)
        else:
            prefix = x[: len(x) - ceil(similarity * len(x) - 1e-9) + 1].tolist() or [-1]
        for t in prefix:
            held.setdefault(t, []).append(i)
        if not any(part[j] == part[i] for j in heads):
            heads.append(i)
            heads = heads[-HEADS:]
        placed.append(i)
    return part


#: Parts whose first text is tried before the prefix filter.
HEADS = 8


def _exact(sets: DataFrame, keys: list[str], similarity: float) -> DataFrame:
    """Stars of equal parts in each group of ``keys``; ``sets`` has ``node``, ``part`` (its part so far) and ``set``."""

    def use(table: pa.Table):
        node, begin = np.unique(table.column("node").to_numpy(), return_index=True)
        if len(node) < 2:
            return
        held = table.column("set").combine_chunks() if table.num_rows else None
        found = [np.frombuffer(held[int(i)].as_py(), np.uint64) for i in begin]
        _, first, label = np.unique(table.column("part").to_numpy()[begin], return_index=True, return_inverse=True)
        out = link_sets(found, first[label], similarity)
        other = np.flatnonzero(out != np.arange(len(out)))
        yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(node[out[other]])], ["a", "b"])

    return in_groups(sets, keys, use, "a long, b long")


def _in_chunks(sets: DataFrame, by: str) -> DataFrame:
    """Adds ``chunk`` and ``chunks``: the rows of each value of ``by`` dealt into chunks of bounded size."""
    size = sets.groupBy(by).agg(F.sum("n").alias("w"), F.count("*").alias("c"))
    chunks = F.ceil(F.greatest(F.col("w") / CHUNK_SHINGLES, F.col("c") / CHUNK_TEXTS, F.lit(1)))
    size = size.select(F.col(by).bitwiseXOR(F.lit(1)).alias("__by"), chunks.alias("chunks"))
    out = sets.withColumn("__key", F.col(by).bitwiseXOR(F.lit(1))).join(size, F.col("__key") == F.col("__by")).drop("__key", "__by")
    return out.withColumn("chunk", F.pmod(F.xxhash64("node", "part"), F.col("chunks")))


def _joined(edges: list[DataFrame]) -> tuple[DataFrame, str]:
    """The components of written tables of links."""
    return connected_components(reduce(DataFrame.union, edges), sum(e.count() for e in edges))


def _parts(sets: DataFrame, edges: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``sets`` with ``part`` as all edges so far have it, and the edges in one table."""
    found, _ = _joined(edges)
    named = found.select(F.col("hi").alias("__node"), "lo")
    return sets.drop("part").join(named, F.col("node") == F.col("__node"), "left").withColumn("part", F.coalesce("lo", "node")).drop("lo", "__node"), found.select("hi", "lo")


def _set_links(sets: DataFrame, rows: int, similarity: float) -> DataFrame:
    """All links of at most ``rows`` sets within candidates (``comp``), as parts: ``hi``, ``lo``."""
    few = lambda df: in_few(df, rows, 4, TEXT_ROWS)
    sets, _ = materialize(few(_in_chunks(sets.withColumn("part", F.col("node")), "comp")), "sets")
    links, _ = materialize(few(_exact(sets, ["comp", "chunk"], similarity)), "set-links")
    large = sets.where("chunks > 1")
    if large.isEmpty():
        return _joined([links])[0].select("hi", "lo")
    # One text of each part found so far, chunk by chunk.
    parts, found = _parts(large, [links])
    heads = _in_chunks(parts.where("node = part").drop("chunk", "chunks"), "comp")
    more, _ = materialize(few(_exact(heads, ["comp", "chunk"], similarity)), "head-links")
    parts, found = _parts(large, [found, more])
    parts, _ = materialize(few(parts), "parts")
    # What lies outside the largest part of its candidate meets everything else there.
    count = parts.groupBy("comp", "part").agg(F.count("*").alias("c"))
    main = count.groupBy("comp").agg(F.max(F.struct("c", "part")).alias("m")).select(F.col("comp").bitwiseXOR(F.lit(1)).alias("__by"), F.col("m.part").alias("main"))
    told = parts.withColumn("__key", F.col("comp").bitwiseXOR(F.lit(1))).join(main, F.col("__key") == F.col("__by")).drop("__key", "__by", "chunk", "chunks")
    outside = _in_chunks(told.where("part <> main"), "comp")
    dealt = outside.groupBy("comp").agg(F.max("chunks").alias("__n")).select(F.col("comp").bitwiseXOR(F.lit(1)).alias("__by"), "__n")
    every = _in_chunks(told, "comp").withColumn("__key", F.col("comp").bitwiseXOR(F.lit(1)))
    every = every.join(dealt, F.col("__key") == F.col("__by"))
    columns = ["comp", "tile", "node", "part", "set"]
    right = every.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))).withColumn("tile", F.col("row") * F.lit(1 << 31) + F.col("chunk")).select(columns)
    whole = every.groupBy("comp").agg(F.max("chunks").alias("__m")).select(F.col("comp").bitwiseXOR(F.lit(1)).alias("__of"), "__m")
    left = outside.withColumn("__key", F.col("comp").bitwiseXOR(F.lit(1))).join(whole, F.col("__key") == F.col("__of"))
    left = left.withColumn("column", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__m") - 1))).withColumn("tile", F.col("chunk") * F.lit(1 << 31) + F.col("column")).select(columns)
    last, _ = materialize(few(_exact(left.union(right), ["comp", "tile"], similarity)), "tile-links")
    return _joined([links, more, last])[0].select("hi", "lo")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The near-duplicate class of every row: ``doc_id, a, b, class``; ``a, b`` are the text's key.

    Texts link at ``similarity`` or more of their shingle sets, transitively. A-Z is
    lower-cased, words are runs without ASCII white space. Texts without a word (null,
    empty) are one class, and a text of fewer words than ``shingle`` links only to its
    copies. Rows without an id have a class too; other columns are ignored. Very long
    texts are compared whole; an empty table gives no row.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(k.alias(n) for k, n in zip(text_key(F.col(text_col)), "ab")), F.col(text_col).alias("text"))
    signed, _ = materialize(_signed(keyed, shingle), "signed")
    routed = BANDS * signed.count()
    met, _ = connected_components(_candidates(signed.where("n > 0"), routed, radius, bucket_rows), routed)
    # The smallest node of a candidate has no row of its own there.
    near = met.select(F.col("hi").alias("of"), F.col("lo").alias("comp")).union(met.select("lo", "lo").distinct())
    # One raw text for each node of a candidate.
    raw = signed.groupBy("node", "n").agg(F.min(F.struct("a", "b")).alias("k")).join(near, F.col("node") == F.col("of"))
    raw = raw.select("node", "n", "comp", F.col("k.a").alias("__a"), F.col("k.b").alias("__b"))
    texts = keyed.select("a", "b", "text").join(raw, (F.col("a") == F.col("__a")) & (F.col("b") == F.col("__b"))).select("comp", "node", "n", "text")

    def cut(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([shingles(t.as_py(), shingle).tobytes() for t in batch.column(3)], pa.binary())], ["comp", "node", "n", "set"])

    sets = texts.mapInArrow(released(cut), "comp long, node long, n long, set binary").dropDuplicates(["comp", "node", "n"])
    found = _set_links(sets, 2 * met.count(), similarity).select(F.col("hi").alias("of"), "lo")
    return signed.join(found, F.col("node") == F.col("of"), "left").select("doc_id", "a", "b", F.coalesce("lo", "node").alias("class"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each class of ``near_duplicate_classes``, columns unchanged; which one: see ``keep_one``."""
    return keep_one(docs, near_duplicate_classes(docs, id_col, text_col, **options), id_col, text_col)
