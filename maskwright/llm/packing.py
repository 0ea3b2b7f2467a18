"""Token packing: first-fit decreasing in randomised groups of documents.

Tokenising is local to a task and only piece lengths leave it; texts and ids
are never shuffled.  Documents are dealt to groups by a hash of their id, each
group small enough for one task, and each group is packed on its own with a
tournament tree over the bins' free room.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise

SEQUENCE, END_ID = 4096, 2
#: documents in a group, on average
GROUP_DOCS = 8192
#: remembered words per generation and worker, of about 200 bytes each; more save time, fewer memory
CACHE_WORDS = 400_000
#: characters of texts whose unknown words are encoded together
PORTION_CHARS = 1_000_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordCache(dict):
    """raw word -> its ids as little-endian uint32 bytes, in two generations of bounded size.

    White space never takes part in a token of the vocabulary and merges never
    cross it, so a text's ids are those of its words, joined; and as all is made
    lower-case, A-Z may be so beforehand.  Words not yet known are encoded
    together.  A text with the spelling of a special token is encoded as a whole.
    """

    def __init__(self, path: str, size: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.size = size or CACHE_WORDS
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.older: dict[bytes, bytes] = {}

    def _learn(self, words: set[bytes]) -> None:
        """Make sure that all ``words`` are known."""
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        marked, new = [], set()
        for word in words:
            if word in self:
                continue
            if (ids := self.older.get(word)) is not None:
                self[word] = ids
            elif word[-1:] in (b",", b".") and word[-2:-1].isalpha():
                # a letter and a mark are never one token: the word and the mark on their own
                marked.append(word)
                new.update(p for p in (word[:-1], word[-1:]) if p not in self)
            else:
                new.add(word)
        order = list(new)
        found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in order], add_special_tokens=False)
        for word, one in zip(order, found):
            self[word] = array("I", one.ids).tobytes()
        for word in marked:
            self[word] = self[word[:-1]] + self[word[-1:]]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text."""
        whole = [bool(t) and any(s in t for s in self.special) for t in texts]
        split = [[] if w or not t else t.encode("utf-8", "replace").lower().split() for t, w in zip(texts, whole)]
        self._learn(set().union(*split))
        return [
            array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() if w else b"".join(map(self.__getitem__, words))
            for t, w, words in zip(texts, whole, split)
        ]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


def _portions(texts: pa.Array) -> Iterator[list[str | None]]:
    """A few megabytes of texts at a time, one text at least."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_py())
        size += len(part[-1] or "")
        if size >= PORTION_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


_caches: dict[tuple[str, int | None], WordCache] = {}


def word_cache(path: str, size: int | None = None) -> WordCache:
    if (path, size) not in _caches:
        _caches[path, size] = WordCache(path, size)
    return _caches[path, size]


def _pieces(path: str, size: int, end_id: int, cache_words: int | None):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(path, cache_words)
        for part in source:
            out: tuple[list, ...] = ([], [], [], [], [])
            encoded = (ids for texts in _portions(part.column(1)) for ids in cache.encode_all(texts))
            for doc, ids in zip(part.column(0).to_pylist(), encoded):
                raw = ids + end
                tokens = len(raw) // 4
                for start in range(0, tokens, size):
                    piece = raw[4 * start : 4 * (start + size)]
                    for column, value in zip(out, (doc, start, len(piece) // 4, zlib.crc32(piece), tokens)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], PIECES.replace(" long", "").split(", "))

    return run


class Tournament:
    """Free room of bins in a complete binary tree whose inner nodes hold the larger child."""

    def __init__(self, bins: int, room: int):
        self.base = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.base)

    def place(self, size: int) -> int:
        """Take ``size`` from the first bin that has it; its number."""
        best, at = self.best, 1
        while at < self.base:
            at *= 2
            if best[at] < size:
                at += 1
        bin_ = at - self.base
        best[at] -= size
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return bin_


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, larger items first."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    full = int((lengths >= size).sum())
    bins[order[:full]] = np.arange(full)
    tree = Tournament(max(1, len(lengths) - full), size)
    used = np.zeros(len(lengths) - full, dtype=np.int64)
    for i in order[full:].tolist():
        b = tree.place(int(lengths[i]))
        bins[i], offsets[i] = full + b, used[b]
        used[b] += lengths[i]
    return bins, offsets


def _pack(size: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), size)
        number = group["grp"].to_numpy().astype(np.int64)
        return (
            group.drop_columns(["grp"])
            .append_column("sequence_id", pa.array((number << 32) + bins, pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    return run


def pack_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    group_docs: int = GROUP_DOCS,
    cache_words: int | None = None,
) -> DataFrame:
    """Pieces of all documents and the sequence each lies in.

    A document is its ids and then ``end_id``; it is cut every ``size`` ids, so
    only its last piece can be shorter.  Null and empty texts are the end id
    alone.  Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``; a sequence holds at most ``size`` ids, its pieces gapless from 0.
    Repeated rows are packed as often as they occur; extra columns are ignored.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialise(narrow.mapInArrow(_pieces(tokenizer_path, size, end_id, cache_words), PIECES), "pieces")
    groups = max(1, -(-pieces.where("start = 0").count() // group_docs))
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("long"))
    return dealt.groupBy("grp").applyInArrow(_pack(size), PIECES + ", sequence_id long, offset long")
