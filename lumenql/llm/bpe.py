"""Byte-pair encoding and decoding with forced boundaries.

Two neighbouring bytes that stand side by side inside no token of the vocabulary can
never be merged into one, so a cut between them is certain. Every pre-token is cut at
all such places, its fragments are encoded independently of each other, and their ids
are concatenated. Fragments repeat far more often than pre-tokens, and each is encoded
once per task's cache.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released
from .pretoken import Cache, Splitter

#: Entries of each generation of a worker's caches; bounds its memory.
CACHE = 100_000


#: Ids after which rows are handed on; bounds what a worker holds besides its caches.
HELD_IDS = 1 << 18
#: Parts above which a fragment is merged through a heap.
LONG = 64
_BITS = 20
_NEW = (1 << _BITS) - 1
_NEVER = 1 << 62


class ForcedBoundaryBpe:
    """Encoder and decoder for a BPE tokenizer file with word-end suffixes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        #: Pair of ids -> rank and id of the merged token, in one number.
        self.merges: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[self.vocab[left] << _BITS | self.vocab[right]] = rank << _BITS | self.vocab[left + right]
        self.splitter = Splitter(path)
        self.text_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.splitter.special.items()}
        #: Neighbours inside some token: within it, and with its last character where that ends a word.
        self.inside: set[str] = set()
        self.inside_end: set[str] = set()
        for token in self.vocab:
            ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            pairs = [body[k : k + 2] for k in range(len(body) - 1)]
            if ends and pairs:
                self.inside_end.add(pairs.pop())
            self.inside.update(pairs)
        self.middle = Cache(lambda part: self._merge([self.vocab[c] for c in part]), CACHE)
        self.end = Cache(lambda part: self._merge([*(self.vocab[c] for c in part[:-1]), self.vocab[part[-1] + self.suffix]]), CACHE)
        self.words = Cache(self._word, CACHE)

    def fragments(self, letters: str) -> list[str]:
        """A pre-token's byte characters, cut wherever two neighbours occur inside no token."""
        out, begin, last = [], 0, len(letters) - 1
        inside = self.inside
        for k in range(1, last):
            if letters[k - 1 : k + 1] not in inside:
                out.append(letters[begin:k])
                begin = k
        if last > 0 and letters[last - 1 :] not in self.inside_end:
            out.append(letters[begin:last])
            begin = last
        out.append(letters[begin:])
        return out

    def _word(self, word: str) -> tuple[int, ...]:
        *middle, end = self.fragments(self.splitter.letters(word))
        ids = self.end[end]
        return tuple(chain(*map(self.middle.__getitem__, middle), ids)) if middle else ids

    def _merge(self, parts: list[int]) -> tuple[int, ...]:
        """Apply the merges of a fragment in rank order, the leftmost first among equals."""
        if len(parts) > LONG:
            return self._merge_long(parts)
        get = self.merges.get
        pairs = [get(a << _BITS | b, _NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != _NEVER:
            k = pairs.index(best)
            parts[k : k + 2] = [best & _NEW]
            del pairs[k]
            if k:
                pairs[k - 1] = get(parts[k - 1] << _BITS | parts[k], _NEVER)
            if k < len(pairs):
                pairs[k] = get(parts[k] << _BITS | parts[k + 1], _NEVER)
        return tuple(parts)

    def _merge_long(self, parts: list[int]) -> tuple[int, ...]:
        """The same with a heap of pairs over a linked list, in near linear time."""
        n, get = len(parts), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, k, parts[k], parts[k + 1]) for k in range(n - 1) if (m := get(parts[k] << _BITS | parts[k + 1])) is not None]
        heapify(heap)
        while heap:
            merge, k, left, right = heappop(heap)
            if parts[k] != left or (j := after[k]) >= n or parts[j] != right:
                continue  # one of the two has been merged meanwhile
            parts[k], parts[j], after[k] = merge & _NEW, -1, after[j]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (m := get(parts[a] << _BITS | parts[b])) is not None:
                    heappush(heap, (m, a, parts[a], parts[b]))
        return tuple(p for p in parts if p >= 0)

    def encode(self, text: str) -> list[int]:
        words = self.words
        out: list[int] = []
        for piece in self.splitter.pieces(text):
            if isinstance(piece, int):
                out.append(piece)
            else:
                out.extend(chain.from_iterable(map(words.__getitem__, piece)))
        return out

    def decode(self, ids) -> str:
        """Token texts joined by one space: the file names no decoder."""
        return " ".join(map(self.text_of.__getitem__, ids))


_loaded: dict[str, ForcedBoundaryBpe] = {}


def load(path: str) -> ForcedBoundaryBpe:
    """The encoder of a file, once for each worker process."""
    if path not in _loaded:
        _loaded[path] = ForcedBoundaryBpe(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, digests: bool = False) -> DataFrame:
    """Token ids and decoded text of every document.

    Returns ``doc_id, n_tokens, ids array<int>, decoded``; with ``digests`` the two long
    columns are replaced by ``ids_sha256`` (of the decimal ids joined by one space) and
    ``decoded_sha256``. ``tokenizer`` is the path of a tokenizers-library file, readable
    on every executor. Null texts count as empty and have no token; repeated rows give a
    row each; very long texts are encoded whole; other columns are ignored, and an empty
    table gives no row.
    """

    def run(batches):
        bpe, kind = load(tokenizer), pa.string() if digests else pa.list_(pa.int32())
        for batch in batches:
            count, first, second, held, begin = [], [], [], 0, 0

            def close():
                keys = batch.column(0).slice(begin, len(count))
                return pa.RecordBatch.from_arrays([keys, pa.array(count, pa.int64()), pa.array(first, kind), pa.array(second, pa.string())], names)

            for x in batch.column(1):
                ids = bpe.encode(x.as_py() or "")
                decoded = bpe.decode(ids)
                count.append(len(ids))
                if digests:
                    first.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                    second.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                else:
                    first.append(ids)
                    second.append(decoded)
                held += len(ids)
                if held >= HELD_IDS:
                    yield close()
                    begin += len(count)
                    count, first, second, held = [], [], [], 0
            if count:
                yield close()

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"]
    kinds = ["long", "long", "string", "string"] if digests else ["long", "long", "array<int>", "string"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(released(run), ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
