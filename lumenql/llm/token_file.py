"""Token-id files: blocks of Simple-8b words with their own document offsets.

A block holds whole documents in ascending id order:

    bytes 0-7    magic ``LQS8B\\x01\\0\\0``
    8-23         number of documents, number of 64-bit words (two uint64)
    then         document ids (int64), tokens of each document (uint64),
                 offset of each document's first word (uint64), words (uint64)

All numbers are little-endian. A document's words start at its offset, so any document
decodes alone and all of a block decode in one vectorised pass. Blocks are written as
binary rows of a Parquet container, through Spark's own commit protocol, and each row
repeats the number of ids and documents, and the ids of its part before it, for readers
that only plan.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import simple8b
from .common import scratch
from .pretoken import PLAIN, Cache, Splitter

MAGIC = b"LQS8B\x01\0\0"
END_ID = 1
#: Pre-tokens of each generation of a worker's cache; a packed one takes about 200 bytes.
KNOWN = 1 << 18
#: Words of a worker's table, which takes about 40 bytes for each, and ids for each of them above which it is trimmed too.
WORDS, WORD_IDS = 1 << 20, 32
#: Characters whose words are looked up at once; a longer text makes a group of its own.
GROUP_CHARS = 1 << 22
#: Ids after which a block is closed.
BLOCK_IDS = 1 << 17


class WordTable:
    """Words and their ids as columns, in which all words of a group of texts are looked up at once.

    When it holds more than ``size`` words, or very many ids, those go that no later group
    has asked for, and very long ones; at most half of ``size`` stay, the oldest.
    """

    def __init__(self, make, size: int):
        self._make, self._size = make, size
        self.words = pa.array([], pa.string())
        self.count, self.used = np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all the words in a row, and the number of each word's ids."""
        if len(self.words) > self._size or len(self.ids) > WORD_IDS * self._size:
            self._trim()
        known = len(self.words)
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        gaps = np.flatnonzero(at < 0)
        self.used[at[at >= 0]] = True
        if len(gaps):
            new = words.take(pa.array(gaps)).dictionary_encode()
            at = at.copy()
            at[gaps] = known + new.indices.to_numpy()
            self._add(new.dictionary)
        count = self.count[at]
        ends = np.cumsum(count)
        first = (np.cumsum(self.count) - self.count)[at]
        return self.ids[np.repeat(first - (ends - count), count) + np.arange(count.sum())], count

    def _add(self, new: pa.StringArray) -> None:
        packed = self._make(new.to_numpy(zero_copy_only=False).tolist())
        self.words = pa.concat_arrays([self.words, new])
        self.count = np.r_[self.count, np.array([len(p) // 4 for p in packed], np.int64)]
        self.used = np.r_[self.used, np.zeros(len(new), bool)]
        self.ids = np.r_[self.ids, np.frombuffer(b"".join(packed), np.uint32)]

    def _trim(self) -> None:
        stay = np.zeros(len(self.words), bool)
        stay[np.flatnonzero(self.used & (self.count <= WORD_IDS))[: self._size // 2]] = True
        self.words, self.ids = self.words.filter(pa.array(stay)), self.ids[np.repeat(stay, self.count)]
        self.count, self.used = self.count[stay], np.zeros(int(stay.sum()), bool)


class LibraryEncoder:
    """The tokenizers library, whose model encodes each new pre-token once and keeps it as packed ids.

    White space is part of no pre-token, so a plain text's ids are those of the words between
    its white space, which a table holds; other texts are cut by the library.
    """

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        model, letters = self.splitter.tokenizer.model, self.splitter.letters
        self.known = Cache(lambda word: array("I", [t.id for t in model.tokenize(letters(word))]).tobytes(), KNOWN)
        self.table = WordTable(self._words, WORDS)

    def encode(self, text: str) -> bytes:
        """The text's ids as unsigned 32-bit integers of the machine's byte order."""
        return next(self.encode_all([text]))

    def encode_all(self, texts):
        """``encode`` of each text, in order."""
        group: list[str] = []
        held = 0
        for text in texts:
            if group and held + len(text) > GROUP_CHARS:
                yield from self._group(group)
                group, held = [], 0
            group.append(text)
            held += len(text)
        yield from self._group(group)

    def _group(self, texts: list[str]):
        plain = [None if any(mark in text for mark in self.splitter.special) or not PLAIN.fullmatch(text) else text.lower() for text in texts]
        words = pc.ascii_split_whitespace(pa.array(plain, pa.string()))
        ids, count = self.table.encode(words.flatten())
        ends = np.r_[0, 4 * np.cumsum(count)][np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))].tolist()
        packed, begin = ids.tobytes(), 0
        for text, own, end in zip(texts, plain, ends):
            yield self._other(text) if own is None else packed[begin:end]
            begin = end

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of words of lower-case plain texts; one of letters only is a pre-token."""
        get, cut = self.known.__getitem__, self.splitter.plain
        return [get(word) if word.isalpha() else b"".join(map(get, cut(word))) for word in words]

    def _other(self, text: str) -> bytes:
        get = self.known.__getitem__
        return b"".join([array("I", [p]).tobytes() if isinstance(p, int) else b"".join(map(get, p)) for p in self.splitter.pieces(text)])


_loaded: dict[str, LibraryEncoder] = {}


def encode_block(ids: list[int], texts: list[bytes]) -> bytes:
    """One block from document ids and their token ids, packed as ``LibraryEncoder`` gives them."""
    tokens = np.array([len(t) // 4 for t in texts], dtype=np.int64)
    flat = np.frombuffer(b"".join(texts), np.uint32)
    words, offsets = simple8b.pack_rows(flat, tokens)
    parts = [np.array([len(ids), len(words)]).astype("<u8"), np.array(ids, dtype="<i8"), tokens.astype("<u8"), offsets.astype("<u8"), words.astype("<u8")]
    return MAGIC + b"".join(p.tobytes() for p in parts)


def decode_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, tokens of each, and all token ids of a block."""
    if block[:8] != MAGIC:
        raise ValueError("not a token block")
    docs, size = (int(x) for x in np.frombuffer(block, "<u8", 2, 8))
    ids = np.frombuffer(block, "<i8", docs, 24)
    tokens = np.frombuffer(block, "<u8", docs, 24 + 8 * docs).astype(np.int64)
    values = simple8b.unpack(np.frombuffer(block, "<u8", size, 24 + 24 * docs))
    if len(values) != tokens.sum():
        raise ValueError("token block is damaged")
    return ids, tokens, values


def write_tokens(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every document, append ``END_ID``, and write blocks in ascending id order.

    Documents are range-partitioned by id, sorted, and encoded as they are written; a
    partition's blocks are numbered, so the order of all documents is (part, block). Null
    texts count as empty. Rows without an id sort first and read back with a null id.
    Rows that share an id may come in either order, each with its own tokens. Very long
    texts are encoded whole, other columns are ignored, and a table without rows writes no block.
    """

    def run(batches):
        if tokenizer not in _loaded:
            _loaded[tokenizer] = LibraryEncoder(tokenizer)
        encoder, part = _loaded[tokenizer], TaskContext.get().partitionId()
        ids: list[int] = []
        texts: list[bytes] = []
        held = number = before = 0
        end = array("I", [END_ID]).tobytes()

        def close():
            block = encode_block(ids, texts)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([held], pa.int64()), pa.array([before], pa.int64()), pa.array([block], pa.binary())], ["part", "block", "docs", "ids", "before", "data"])

        for batch in batches:
            for key, got in zip(batch.column(0), encoder.encode_all(text.as_py() or "" for text in batch.column(1))):
                got += end
                ids.append(NO_ID if key.as_py() is None else key.as_py())
                texts.append(got)
                held += len(got) // 4
                if held >= block_ids:
                    yield close()
                    ids, texts, held, before, number = [], [], 0, before + held, number + 1
        if ids:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    dealt.mapInArrow(run, "part int, block long, docs long, ids long, before long, data binary").write.option("compression", "none").parquet(path)


#: Stands for a missing document id in a block.
NO_ID = -(1 << 63)


def read_tokens(spark: SparkSession, path: str, *, digests: bool = False) -> DataFrame:
    """The documents of token files: ``doc_id, start, n_tokens`` and ``ids``, or their ``ids_crc32``.

    ``start`` counts the ids of all documents before this one. Only the totals of parts,
    as many as the writer had partitions, reach the driver.
    """
    blocks = spark.read.parquet(path)
    starts: dict[int, int] = {}
    total = 0
    for row in blocks.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect():
        starts[row["part"]] = total
        total += row["ids"]

    def run(batches):
        for batch in batches:
            for part, before, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids, tokens, values = decode_block(data.as_py())
                ends = np.cumsum(tokens)
                begin = ends - tokens
                columns = [pa.array([None if i == NO_ID else i for i in ids.tolist()], pa.int64()), pa.array(begin + before + starts[part]), pa.array(tokens)]
                if digests:
                    flat = values.astype("<u4")
                    last = pa.array([zlib.crc32(flat[a:b]) for a, b in zip(begin.tolist(), ends.tolist())], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*columns, last], names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"]
    schema = f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digests else 'ids array<bigint>'}"
    return blocks.select("part", "before", "data").mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str, path: str | None = None, *, digests: bool = True, **options) -> DataFrame:
    """Write the documents' tokens and read them back."""
    path = path or scratch(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path, **options)
    return read_tokens(docs.sparkSession, path, digests=digests)
