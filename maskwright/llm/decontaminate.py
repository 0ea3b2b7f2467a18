"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Test items are the stated query set and are taken in blocks of bounded size,
so what a task holds of them has a proven bound however long the benchmark is.
Per block the corpus is scanned once.  Every n-gram of an item is a seed,
however many documents have it; what common ones cost is bounded by a filter
that no passage of the wanted score fails, not by leaving them out.  Passages
are aligned with their item where they are found, so no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernel import NON_WORD, U64, distinct, ngram_hashes, word_hashes

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: score of an alignment as a share of the item's score with itself
MIN_SCORE = 0.5
#: bytes of item text held by a task at once
BLOCK_BYTES = 8 << 20
HITS = "doc_id long, item_id long, score double, start_word long, end_word long"
_FILTER_BITS = 22
#: what a point of score counts in a cell that holds a start as well
_SCORE = 1 << 32
#: windows of seeds held at once before they are merged
_WINDOWS = 1_000_000


def item_words(text: str | None) -> np.ndarray:
    """Hashes of a text's words: letters and digits, lower-case, punctuation dropped."""
    return word_hashes(text.lower().encode("utf-8", "surrogatepass"), NON_WORD) if text else np.empty(0, dtype=U64)


class Seeds:
    """N-grams of a block of items, with a fixed-size bitmap in front of the exact table."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.words = [item_words(t) for _, t in items]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.tables = {n: self._table(n) for n in {min(SEED_WORDS, size) for size in self.sizes.tolist()} - {0}}

    def _table(self, n: int) -> tuple[np.ndarray, ...]:
        """Sorted n-grams, their bitmap, and for each from ``first`` on: its items with the least and greatest offset in them."""
        mine = [k for k, size in enumerate(self.sizes.tolist()) if min(SEED_WORDS, size) == n]
        counts = self.sizes[mine] - n + 1
        gram = np.concatenate([ngram_hashes(self.words[k], n) for k in mine])
        item = np.repeat(np.array(mine, dtype=np.int64), counts)
        offset = np.concatenate([np.arange(c) for c in counts.tolist()])
        order = np.lexsort((offset, item, gram))
        gram, item, offset = gram[order], item[order], offset[order]
        new = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (item[1:] != item[:-1]))))
        low, high = offset[new], offset[np.append(new[1:], len(gram)) - 1]
        gram, item = gram[new], item[new]
        first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        grams = gram[first]
        bitmap = np.zeros(1 << _FILTER_BITS, dtype=bool)
        bitmap[(grams & U64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
        return grams, bitmap, np.append(first, len(gram)), item, low, high

    def hits(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``words`` that start an n-gram of an item, and the n-grams' places in the table."""
        table, bitmap = self.tables[n][:2]
        grams = ngram_hashes(words, n)
        at = np.flatnonzero(bitmap[(grams & U64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(table, grams[at]), len(table) - 1)
        same = table[place] == grams[at]
        return at[same], place[same]

    def slack(self, k: np.ndarray, min_score: float) -> np.ndarray:
        """Words an alignment of at least ``min_score`` can have beyond its item's: each costs one of the item's two a word."""
        return np.ceil(2 * (1 - min_score) * self.sizes[k]).astype(np.int64)

    def windows(self, words: np.ndarray, min_score: float) -> np.ndarray:
        """Rows (item, start, end): where alignments through a seed can lie; disjoint for each item, in order."""
        found = np.empty((0, 3), dtype=np.int64)
        for n, (_, _, first, item, low, high) in self.tables.items():
            at, place = self.hits(words, n)
            many = first[place + 1] - first[place]
            total = np.cumsum(many)
            cut = 0
            while cut < len(at):
                done = total[cut - 1] if cut else 0
                to = max(cut + 1, int(np.searchsorted(total, done + _WINDOWS, "right")))
                here = slice(cut, to)
                row = np.repeat(first[place[here]] - (total[here] - many[here] - done), many[here]) + np.arange(total[to - 1] - done)
                position, k = np.repeat(at[here], many[here]), item[row]
                slack = self.slack(k, min_score)
                start = np.maximum(position - high[row] - slack, 0)
                end = np.minimum(position - low[row] + self.sizes[k] + slack, len(words))
                found = _merge(np.concatenate((found, np.stack((k, start, end), axis=1))), len(words) + 1)
                cut = to
        return found


def _merge(windows: np.ndarray, span: int) -> np.ndarray:
    """Unions of the windows of each item that meet; ``span`` is more than any end."""
    windows = windows[np.lexsort((windows[:, 1], windows[:, 0]))]
    end = np.maximum.accumulate(windows[:, 0] * span + windows[:, 2])
    first = np.flatnonzero(np.concatenate(([True], windows[1:, 0] * span + windows[1:, 1] > end[:-1])))
    last = np.append(first[1:], len(windows)) - 1
    return np.stack((windows[first, 0], windows[first, 1], end[last] - windows[first, 0] * span), axis=1)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment score of two word sequences, and where it starts and ends in the passage.

    A cell holds score and start as one number, score first, so that both are
    carried along by the same maxima; of equal scores the later start wins.
    """
    places = np.arange(len(passage) + 1, dtype=np.int64)
    ramp = -GAP * _SCORE * places
    row = places.copy()  # score 0, starting there
    best, end = 0, 0
    for word in item.tolist():
        step = np.where(passage == U64(word), MATCH, MISMATCH) * _SCORE
        new = np.maximum(row + GAP * _SCORE, places)
        new[1:] = np.maximum(new[1:], row[:-1] + step)
        # a gap in the item: best of what is to the left, less its distance
        row = np.maximum.accumulate(new + ramp) - ramp
        row = np.where(row < _SCORE, places, row)
        top = int((row // _SCORE).argmax())
        if row[top] // _SCORE > best // _SCORE:
            best, end = int(row[top]), top
    return best // _SCORE, best % _SCORE, end


def _dense(marked: np.ndarray, width: int, least: float) -> Iterator[tuple[int, int]]:
    """Unions of the stretches of ``width`` places with at least ``least`` marked ones."""
    total = np.concatenate(([0], np.cumsum(marked)))
    width = min(width, len(marked))
    starts = np.flatnonzero(total[width:] - total[:-width] >= least)
    if len(starts):
        cuts = np.flatnonzero(np.diff(starts) > width) + 1
        for part in np.split(starts, cuts):
            yield int(part[0]), int(part[-1]) + width


def passages(words: np.ndarray, seeds: Seeds, min_score: float) -> Iterator[tuple[int, float, int, int]]:
    """(item, score, start, end) of every item a document has a passage of; the best passage each."""
    windows = seeds.windows(words, min_score)
    for cut in np.split(np.arange(len(windows)), np.flatnonzero(np.diff(windows[:, 0])) + 1) if len(windows) else ():
        k = int(windows[cut[0], 0])
        item = seeds.words[k]
        vocabulary = distinct(item)
        width = len(item) + int(seeds.slack(k, min_score))
        best = (0.0, 0, 0)
        for low, high in windows[cut, 1:].tolist():
            place = np.minimum(np.searchsorted(vocabulary, words[low:high]), len(vocabulary) - 1)
            # each item word scores at most once, and only if the passage has it
            for start, end in _dense(vocabulary[place] == words[low:high], width, min_score * len(item)):
                start, end = low + start, low + end
                score, first, stop = align(item, words[start:end])
                score /= MATCH * len(item)
                if score > best[0]:
                    best = (score, start + first, start + stop)
        if best[0] >= min_score:
            yield (k, *best)


def _locate(shared, min_score: float):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        for part in source:
            out = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                for k, score, start, end in passages(item_words(text.as_py()), seeds, min_score):
                    out.append((doc, seeds.ids[k], score, start, end))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], ["doc_id", "item_id", "score", "start_word", "end_word"])

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word``: documents with a passage of a test item.

    ``score`` is the Smith-Waterman score over words (match 2, mismatch and gap
    -1) as a share of the item's with itself; rows of at least ``min_score``
    are returned, per document and item the best passage, from the first to
    before the last word's end.  Null or wordless texts and items match nothing;
    a null id is carried along; an empty benchmark or corpus gives no rows.
    Repeated rows of ``docs`` give repeated rows.

    The benchmark is the query set: it is read in blocks, each of which costs
    two scans of the corpus.  A passage costs its length times the item's, so a
    document that is itself a long item is quadratic in that item's words.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item")).where("item is not null")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("item"))).first()[0] or 0
    blocks = max(1, -(-2 * size // block_bytes)) if size else 0  # twice as many as needed, since hashing deals unevenly
    found = None
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(blocks)) == b)
        seeds = Seeds([(r["item_id"], r["item"]) for r in block.collect()])
        if not seeds.tables:
            continue
        here = narrow.mapInArrow(_locate(spark.sparkContext.broadcast(seeds), min_score), HITS)
        found = here if found is None else found.unionByName(here)
    return found if found is not None else spark.createDataFrame([], HITS)
