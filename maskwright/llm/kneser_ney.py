"""Quality by perplexity under an interpolated modified Kneser-Ney bigram model.

All words of nine in ten trusted texts count; the tenth is kept out of the
counts and sets the thresholds.  The VOCABULARY commonest have short numbers, a bounded table
every task may hold; the others go by their hashes, and their numbers - weight
of the lower order, continuation probability - are joined by shard as the
bigrams' are.  ``train`` with a closed vocabulary makes one unknown word of
them instead.  Bigram counts stay in the cluster.

A text's log-probability is the sum over its words of the backed-off estimate,
which needs only per-word numbers (of a word without a number those of a word never met), plus a correction for every bigram the
model has seen and for every word without a number that it has.  Corrections of the FREQUENT commonest
bigrams are a bounded table every task holds and are added where the text is read; the others are joined by
shard: model rows and packed bigram keys of a chunk of documents meet in the task of their shard, model first, and leave
it as one packed row of the sums of those documents that have any.  A chunk's ids are sent once.  A fixed-size Bloom filter
keeps bigrams the model cannot have from being sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise, remove, shuffles_removed
from .textkernel import U64, WHITESPACE, mix, word_hashes

#: words with a number; more would save disk and cost memory in every task
VOCABULARY = 200_000
#: share of trusted documents kept out of the counts, for thresholds
CALIBRATION = 10
#: perplexity quantile of held-out trusted text beyond which a text is rejected, by language
QUANTILE = 0.995
#: pseudo words of average cost added to each text, so that a few words cannot decide
PRIOR_WORDS = 20
#: a language's quantile counts as that of its held-out texts and of so many texts of all languages
PRIOR_TEXTS = 30
#: stands for the null id between stages
NO_ID = -(1 << 63)
BLOOM_BITS = 26
#: tasks that fill it; each sends at most 2 ** (BLOOM_BITS - 3) bytes, compressed, so this bounds what is shuffled
BLOOM_TASKS = 512
BLOOM_BLOCKS = 64
SHARD_ROWS = 1_000_000
#: bigrams whose corrections every task holds, 12 bytes each
FREQUENT = 1 << 20
#: keys looked up at a time; a chunk ends with those that bring it to so many keys to send, or with so many documents
SIFTED_KEYS = 200_000
CHUNK_KEYS = 400_000
CHUNK_DOCS = 1 << 16
BROADCAST_LABELS = 2_000_000
#: white space, full stop and comma
SEPARATORS = bytes(0 if i in b".," else WHITESPACE[i] for i in range(256))
START, UNKNOWN = 0, 1  # word numbers; the vocabulary begins at 2
_SHIFT = U64(20)
#: set in the ids of words without a number, and in keys that have one
RARE = U64(1 << 63)
_AS_LEFT, _AS_RIGHT = U64(0x3C6EF372FE94F82B), U64(0x2545F4914F6CDD1D)
assert VOCABULARY + 2 < 1 << 20


def words_of(text: str | None) -> np.ndarray:
    return word_hashes(text.lower().encode("utf-8", "surrogatepass"), SEPARATORS) if text else np.empty(0, dtype=U64)


def keys_of_pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left << 20 | right where both are numbers, else a hash of both."""
    return np.where((left | right) >> _SHIFT == 0, left << _SHIFT | right, mix(left * U64(0xD6E8FEB86659FD93) + right) | RARE)


def keys_of_rare(words: np.ndarray, role: U64) -> np.ndarray:
    return mix(words ^ role) | RARE


class Vocabulary:
    def __init__(self, hashes: np.ndarray, is_open: bool = False):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.numbers = (order + 2).astype(U64)
        self.is_open = is_open

    def numbers_of(self, words: np.ndarray) -> np.ndarray:
        other = words | RARE if self.is_open else np.full(len(words), UNKNOWN, dtype=U64)
        if not len(self.hashes):
            return other
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, self.numbers[at], other)

    def pairs(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Left and right words of a text's bigrams, the first after a start mark."""
        right = self.numbers_of(words_of(text))
        return (np.concatenate(([U64(START)], right[:-1])) if len(right) else right), right


def keys_of_corrections(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Keys of all corrections a text may have: its bigrams', and those of its words without a number."""
    return np.concatenate((keys_of_pairs(left, right), keys_of_rare(left[left >= RARE], _AS_LEFT), keys_of_rare(right[right >= RARE], _AS_RIGHT)))


def _tally(keys: list[np.ndarray]) -> pa.RecordBatch:
    both = np.sort(np.concatenate(keys)) if keys else np.empty(0, dtype=U64)
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.empty(0, dtype=int)
    counts = np.diff(np.append(first, len(both)))
    return pa.RecordBatch.from_arrays([pa.array(both[first].view(np.int64)), pa.array(counts, pa.int64())], ["k", "n"])


def _tallied(keys_of):
    """Count keys of each text, combined over up to two million of them at a time."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, size = [], 0
        for part in source:
            for text in part.column(0):
                keep.append(keys_of(text.as_py()))
                size += len(keep[-1])
                if size >= 2_000_000:
                    yield _tally(keep)
                    keep, size = [], 0
        yield _tally(keep)

    return run


def _count_pairs(shared):
    """Count bigrams, up to two million words at a time: key of those of numbers, else 0, left and right of the others, and the count."""

    def tally(lefts: list[np.ndarray], rights: list[np.ndarray]) -> pa.RecordBatch:
        left, right = np.concatenate(lefts), np.concatenate(rights)
        k = keys_of_pairs(left, right)
        order = np.argsort(k)
        k = k[order]
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, dtype=int)
        n = np.diff(np.append(first, len(k)))
        k, order = k[first], order[first]
        left, right = (np.where(k >= RARE, x[order], U64(0)) for x in (left, right))
        k = np.where(k >= RARE, U64(0), k)  # the words tell it
        return pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in (k, left, right)), pa.array(n, pa.int64())], ["k", "l", "r", "n"])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lefts, rights, size = [], [], 0
        for part in source:
            for text in part.column(0):
                left, right = shared.value.pairs(text.as_py())
                lefts.append(left)
                rights.append(right)
                size += len(left)
                if size >= 2_000_000:
                    yield tally(lefts, rights)
                    lefts, rights, size = [], [], 0
        if size:
            yield tally(lefts, rights)

    return run


@dataclass
class Model:
    """What tasks hold: per-word numbers of the vocabulary, corrections of common bigrams, and a Bloom filter of fixed size."""

    vocabulary: Vocabulary
    backoff: np.ndarray  # log weight of the lower order after each word
    lower: np.ndarray  # log continuation probability of each word
    frequent: np.ndarray  # sorted keys of common bigrams
    gains: np.ndarray  # their corrections
    bloom: np.ndarray
    shards: int


@dataclass
class Trained:
    model: Model
    corrections: DataFrame  # packed model keys and corrections, see _FLOW


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more (Chen and Goodman)."""
    n1, n2, n3, n4 = (counts_of_counts.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) >> U64(33)) % U64(shards)


#: kind 0: model keys, values: their corrections as float32; kind 1: distinct keys of a chunk of documents, how many
#: documents have each (sizes), which (owners) and, of those that have one more than once, place and count (values);
#: kind 2: a chunk's document ids (owners), words (sizes) and log-probabilities so far (values)
_FLOW = "shard int, kind int, chunk binary, keys binary, sizes binary, owners binary, values binary"
_SUMS = "chunk binary, docs binary, sizes binary, owners binary, sums binary"


def _flow(shard: int, kind: int, *parts: bytes) -> pa.RecordBatch:
    columns = [pa.array([shard], pa.int32()), pa.array([kind], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _FLOW.split(", ")])


def _pack(values: np.ndarray) -> bytes:
    """Values by byte planes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return _pack(np.diff(keys, prepend=U64(0)).astype("<u8"))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, "<u8"), dtype=U64)


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shards that have keys, and the places of these in order."""
    shard = _shard(keys, shards)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1, dtype=U64))
    for s in range(shards):
        if cuts[s] < cuts[s + 1]:
            yield s, order[cuts[s] : cuts[s + 1]]


def _bloom_slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys ^ U64(0x5851F42D4C957F2D))
    mask = U64((1 << BLOOM_BITS) - 1)
    return (h & mask).astype(np.int64), (h >> U64(32) & mask).astype(np.int64)


def _bloom_parts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's filter, compressed in blocks."""
    bits = np.zeros(1 << BLOOM_BITS, dtype=bool)
    for part in source:
        for slots in _bloom_slots(part.column(0).to_numpy().view(U64)):
            bits[slots] = True
    blocks = np.packbits(bits, bitorder="little").reshape(BLOOM_BLOCKS, -1)
    at = np.flatnonzero(blocks.any(axis=1))
    packed = [zstandard.ZstdCompressor(level=3).compress(blocks[i].tobytes()) for i in at]
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(packed, pa.binary())], ["block", "bits"])


def _bloom_union(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of all tasks -> the filter's blocks."""
    found: dict[int, np.ndarray] = {}
    for part in source:
        for block, packed in zip(*(c.to_pylist() for c in part.columns)):
            bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
            found[block] = found[block] | bits if block in found else bits
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([b.tobytes() for b in found.values()], pa.binary())], ["block", "bits"])


def _cut(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(n > 2, d[2], np.where(n == 2, d[1], np.where(n == 1, d[0], 0.0)))


def _word_keys(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in source:
        w = part.column(0).to_numpy().view(U64)
        for role in (_AS_LEFT, _AS_RIGHT):
            yield pa.RecordBatch.from_arrays([pa.array(keys_of_rare(w, role).view(np.int64))], ["k"])


def _least_count(words: DataFrame, vocabulary: int) -> int:
    """The count from which on there are at most ``vocabulary`` words, or other rows with an ``n``."""
    total, least = 0, None
    for n, many in sorted(map(tuple, words.groupBy("n").agg(F.count("*")).collect()), reverse=True):  # different counts: few, as their sum is the corpus
        total += many
        if total > vocabulary:
            return least if least is not None else n + 1
        least = n
    return 1


def _pair_keys(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, l, r) -> keys of bigrams."""
    for part in source:
        k, left, right = (part.column(c).to_numpy().view(U64) for c in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(np.where(k == 0, keys_of_pairs(left, right), k).view(np.int64))], ["k"])


def train(texts: DataFrame, vocabulary: int = VOCABULARY, open_vocabulary: bool = False) -> Trained:
    """Model of all rows of ``texts`` (one column, text).

    Words beyond the ``vocabulary`` commonest are one unknown word, or with
    ``open_vocabulary`` words like the others, whose numbers stay in the cluster.
    """
    spark = texts.sparkSession
    with shuffles_removed(spark):
        words = materialise(texts.mapInArrow(_tallied(words_of), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")), "words", compression="zstd")
    types = words.count()
    if types <= vocabulary:
        chosen = words
    elif open_vocabulary:
        chosen = words.where(F.col("n") >= _least_count(words, vocabulary))
    else:
        chosen = words.orderBy(F.desc("n"), "k").limit(vocabulary)
    top, often = (c.to_numpy() for c in chosen.select("k", "n").toArrow().columns)
    top = top[np.lexsort((top, -often))]  # numbers follow frequency, so that common keys are small
    vocab = Vocabulary(top.view(U64), open_vocabulary)
    remove(spark, words.inputFiles()[0].rsplit("/", 1)[0])
    shared = spark.sparkContext.broadcast(vocab)
    pairs = texts.mapInArrow(_count_pairs(shared), "k long, l long, r long, n long")
    with shuffles_removed(spark):
        bigrams = materialise(pairs.groupBy("k", "l", "r").agg(F.sum("n").alias("n")), "bigrams", compression="zstd")
    total = bigrams.count()
    low = {r["n"]: r["m"] for r in bigrams.where("n <= 4").groupBy("n").agg(F.count("*").alias("m")).collect()}
    d = discounts(low)
    size = len(top) + 2
    left = F.when(F.col("k") > 0, F.shiftright("k", 20)).otherwise(F.col("l")).alias("w")
    right = F.when(F.col("k") > 0, F.col("k").bitwiseAND((1 << 20) - 1)).otherwise(F.col("r")).alias("w")
    after = bigrams.groupBy(left).agg(
        F.sum("n").alias("c"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"), F.count_if(F.col("n") > 2).alias("n3")
    )
    before = bigrams.groupBy(right).agg(F.count("*").alias("kinds"))
    if open_vocabulary:
        with shuffles_removed(spark):
            after, before = materialise(after, "after", compression="zstd"), materialise(before, "before", compression="zstd")
    few = after.where("w >= 0").toArrow()  # at most one row a vocabulary word
    few_before = before.where("w >= 0").toArrow()
    mass, backoff = np.zeros(size), np.zeros(size)
    w, c, *n = (few[k].to_numpy() for k in ("w", "c", "n1", "n2", "n3"))
    mass[w] = c
    backoff[w] = np.log((d[0] * n[0] + d[1] * n[1] + d[2] * n[2]) / c)
    kinds = np.zeros(size)
    kinds[few_before["w"].to_numpy()] = few_before["kinds"].to_numpy()
    same = {i: int((kinds == i).sum()) for i in (1, 2, 3, 4)}
    more, all_kinds, others = int((kinds > 2).sum()), int(kinds.sum()), 0
    rare = None
    if open_vocabulary:
        with shuffles_removed(spark):
            rare = materialise(before.where("w < 0").join(after.where("w < 0"), "w", "left"), "rare", compression="zstd")
        for table in (after, before):
            for file in table.inputFiles()[:1]:
                remove(spark, file.rsplit("/", 1)[0])
        counted = rare.agg(
            *(F.count_if(F.col("kinds") == i).alias(f"k{i}") for i in same), F.count_if(F.col("kinds") > 2).alias("more"),
            F.coalesce(F.sum("kinds"), F.lit(0)).alias("all"), F.count("*").alias("words"),
        ).first()
        same = {i: m + counted[f"k{i}"] for i, m in same.items()}
        more, all_kinds, others = more + counted["more"], all_kinds + counted["all"], counted["words"]
    e = discounts(same)
    gamma = (e[0] * same[1] + e[1] * same[2] + e[2] * more) / max(size + others - 1, 1)
    lower = (kinds - _cut(kinds, e) + gamma) / max(all_kinds, 1)
    # one of the unknown types, and one more for all that was never met
    spread = 1.0 if open_vocabulary else 1 / (max(types - len(top), 0) + 1)
    lower[UNKNOWN] *= spread
    lower = np.log(np.maximum(lower, 1e-300))

    def of_numbers(k: np.ndarray, n: np.ndarray, numbers) -> np.ndarray:
        """Corrections of bigrams of words with numbers."""
        mass, backoff, lower, d, spread = numbers
        a, b = k >> 20, k & (1 << 20) - 1
        base = np.exp(backoff[a] + lower[b])
        main = (n - _cut(n, d)) / mass[a]
        main = np.where(b == UNKNOWN, main * spread, main)
        return np.log(base + main) - (backoff[a] + lower[b])

    numbered = bigrams.where("k > 0")
    least = _least_count(numbered, FREQUENT)
    frequent, often = (c.to_numpy() for c in numbered.where(F.col("n") >= least).select("k", "n").toArrow().columns)
    order = np.argsort(frequent)
    frequent, often = frequent[order], often[order]
    gains = of_numbers(frequent, often, (mass, backoff, lower, d, spread)).astype("<f4")
    sent = total - len(frequent)
    shards = max(1, -(-(sent + 2 * others) // SHARD_ROWS))
    bloom = np.zeros((BLOOM_BLOCKS, (1 << BLOOM_BITS) // 8 // BLOOM_BLOCKS), dtype=np.uint8)
    if sent:
        keys = bigrams.where((F.col("k") == 0) | (F.col("n") < least)).select("k", "l", "r").mapInArrow(_pair_keys, "k long")
        if others:
            keys = keys.unionByName(rare.select("w").mapInArrow(_word_keys, "k long"))
        parts = keys.coalesce(BLOOM_TASKS).mapInArrow(_bloom_parts, "block long, bits binary").repartition("block")
        with shuffles_removed(spark):
            blocks = parts.mapInArrow(_bloom_union, "block long, bits binary").toArrow()
        for block, bits in zip(*(c.to_pylist() for c in blocks.columns)):
            bloom[block] = np.frombuffer(bits, dtype=np.uint8)
    model = Model(vocab, backoff, lower, frequent.view(U64), gains, bloom.reshape(-1), shards)
    held = spark.sparkContext.broadcast((mass, backoff, lower, d, e, gamma, all_kinds, spread, shards))

    def batched(source: Iterator[pa.RecordBatch], rows) -> Iterator[pa.RecordBatch]:
        keep: list[list[np.ndarray]] = []
        size = 0
        for part in source:
            keep.append([c.fill_null(0).to_numpy(zero_copy_only=False) for c in part.columns])
            size += part.num_rows
            if size >= 200_000:
                yield from rows(*(np.concatenate(x) for x in zip(*keep)))
                keep, size = [], 0
        if size:
            yield from rows(*(np.concatenate(x) for x in zip(*keep)))

    def send(keys: np.ndarray, delta: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(keys)
        keys, delta = keys[order], delta[order].astype("<f4")
        for s, here in _by_shard(keys, held.value[-1]):
            yield _flow(s, 0, b"", _pack_sorted(keys[here]), b"", b"", _pack(delta[here]))

    def correct(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, backoff, lower, d, _, _, _, spread, _ = held.value

        def rows(k: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield from send(k.view(U64), of_numbers(k, n, (mass, backoff, lower, d, spread)))

        yield from batched(source, rows)

    def weight(c: np.ndarray, n1: np.ndarray, n2: np.ndarray, n3: np.ndarray) -> np.ndarray:
        """Log weight of the lower order after words without a number; 0 after those that end every text they are in."""
        d = held.value[3]
        return np.where(c > 0, np.log(np.maximum(d[0] * n1 + d[1] * n2 + d[2] * n3, 1e-300) / np.maximum(c, 1)), 0.0)

    def continued(kinds: np.ndarray) -> np.ndarray:
        _, _, _, _, e, gamma, all_kinds, _, _ = held.value
        return np.log((kinds - _cut(kinds, e) + gamma) / all_kinds)

    def correct_rare(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, backoff, lower, d, *_ = held.value

        def rows(n, l, r, c, n1, n2, n3, kinds) -> Iterator[pa.RecordBatch]:
            a, b = np.where(l < 0, UNKNOWN, l), np.where(r < 0, UNKNOWN, r)
            back = np.where(l < 0, weight(c, n1, n2, n3), backoff[a])
            low = np.where(r < 0, continued(np.maximum(kinds, 1)), lower[b])
            main = (n - _cut(n, d)) / np.where(l < 0, np.maximum(c, 1), mass[a])
            yield from send(keys_of_pairs(l.view(U64), r.view(U64)), np.log(np.exp(back + low) + main) - (back + low))

        yield from batched(source, rows)

    def correct_words(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(w, kinds, c, n1, n2, n3) -> Iterator[pa.RecordBatch]:
            w = w.view(U64)
            yield from send(keys_of_rare(w, _AS_LEFT), weight(c, n1, n2, n3))
            yield from send(keys_of_rare(w, _AS_RIGHT), continued(kinds) - held.value[2][UNKNOWN])

        yield from batched(source, rows)

    corrections = numbered.where(F.col("n") < least).select("k", "n").mapInArrow(correct, _FLOW)
    if others:
        on_left = rare.select(F.col("w").alias("l"), "c", "n1", "n2", "n3")
        on_right = rare.select(F.col("w").alias("r"), "kinds")
        wide = bigrams.where("k = 0").join(on_left, "l", "left").join(on_right, "r", "left").select("n", "l", "r", "c", "n1", "n2", "n3", "kinds")
        corrections = corrections.unionByName(wide.mapInArrow(correct_rare, _FLOW))
        corrections = corrections.unionByName(rare.select("w", "kinds", "c", "n1", "n2", "n3").mapInArrow(correct_words, _FLOW))
    return Trained(model, corrections)


def _score_texts(shared):
    """(doc_id, text) -> what is known of a chunk's log-probabilities, and keys that may be in the model packed by shard."""

    def sift(model: Model, sums: list[float], keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Adds the common bigrams of the last documents to their sums; other keys that may be in the model, and whose they are."""
        start = len(sums) - len(keys)
        key, owner = np.concatenate(keys), np.repeat(np.arange(start, len(sums), dtype="<u2"), [len(k) for k in keys])
        if len(model.frequent):
            place = np.minimum(np.searchsorted(model.frequent, key), len(model.frequent) - 1)
            here = model.frequent[place] == key
            known = np.bincount(owner[here] - start, weights=model.gains[place[here]], minlength=len(keys))
            sums[start:] = (np.array(sums[start:]) + known).tolist()
            key, owner = key[~here], owner[~here]
        one, two = ((model.bloom[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool) for slots in _bloom_slots(key))
        return key[one & two], owner[one & two]

    def send(model: Model, docs: list[int], words: list[int], sums: list[float], kept: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        ids = np.array(docs, dtype="<i8").tobytes()
        chunk = xxhash.xxh3_128_digest(ids)
        yield _flow(int.from_bytes(chunk[:4]) % model.shards, 2, chunk, b"", np.array(words, dtype="<u4").tobytes(), ids, np.array(sums, dtype="<f8").tobytes())
        key, owner = (np.concatenate(x) for x in zip(*kept))
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))))
        n = np.diff(np.append(first, len(key)))
        key, owner = key[first], owner[first]
        for s, mine in _by_shard(key, model.shards):
            k, many = key[mine], n[mine]
            start = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            sizes = np.diff(np.append(start, len(k)))
            more = np.flatnonzero(many > 1)  # most counts are one and are not sent
            repeats = np.concatenate((more, many[more])).astype("<u4")
            yield _flow(s, 1, chunk, _pack_sorted(k[start]), _pack(sizes.astype("<u4")), _pack(owner[mine]), repeats.tobytes())

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        docs, words, sums, keys, kept, size = [], [], [], [], [], 0
        for part in source:
            for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                left, right = model.vocabulary.pairs(text.as_py())
                keys.append(keys_of_corrections(left, right))
                left, right = (np.where(x >= RARE, U64(UNKNOWN), x).view(np.int64) for x in (left, right))
                docs.append(doc)
                words.append(len(right))
                sums.append(float((model.backoff[left] + model.lower[right]).sum()))
                size += len(keys[-1])
                if size >= SIFTED_KEYS or len(docs) == CHUNK_DOCS:
                    kept.append(sift(model, sums, keys))
                    keys, size = [], 0
                    if len(docs) == CHUNK_DOCS or sum(len(k) for k, _ in kept) >= CHUNK_KEYS:
                        yield from send(model, docs, words, sums, kept)
                        docs, words, sums, kept = [], [], [], []
        if keys:
            kept.append(sift(model, sums, keys))
        if docs:
            yield from send(model, docs, words, sums, kept)

    return run


def _join_shard(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, model first: sums of corrections of the documents of each chunk that have any."""
    shard, table, keys, deltas = None, None, [], []
    for part in source:
        out: list[tuple] = []
        for here, kind, chunk, packed, sizes, owners, values in zip(*(c.to_pylist() for c in part.columns)):
            if here != shard:
                shard, table, keys, deltas = here, None, [], []
            if kind == 0:
                keys.append(_unpack_sorted(packed))
                deltas.append(_unpack(values, "<f4"))
            elif kind == 2:
                out.append((chunk, owners, sizes, b"", values))
            elif keys:
                if table is None:
                    k = np.concatenate(keys)
                    order = np.argsort(k)
                    table = (k[order], np.concatenate(deltas)[order].astype(np.float64))
                    keys, deltas = [k[:0]], []
                found = _unpack_sorted(packed)
                place = np.minimum(np.searchsorted(table[0], found), len(table[0]) - 1)
                gain = np.repeat(np.where(table[0][place] == found, table[1][place], 0.0), _unpack(sizes, "<u4"))
                at, n = np.frombuffer(values, dtype="<u4").reshape(2, -1)
                gain[at] *= n
                owner = _unpack(owners, "<u2")
                sums = np.bincount(owner, weights=gain)
                some = np.flatnonzero(sums)
                out.append((chunk, b"", b"", some.astype("<u2").tobytes(), sums[some].astype("<f8").tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out)], [c.split()[0] for c in _SUMS.split(", ")])


def _add_up(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk: words and log-probability of each of its documents."""
    held, ids = None, np.empty(0, dtype="<i8")
    total, words = np.zeros(CHUNK_DOCS), np.zeros(CHUNK_DOCS, dtype=np.int64)

    def done() -> pa.RecordBatch:
        columns = (x[: len(ids)].copy() for x in (ids, words, total))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc_id", "n_words", "logp"])

    for part in source:
        for chunk, docs, sizes, owners, sums in zip(*(c.to_pylist() for c in part.columns)):
            if chunk != held:
                if held is not None:
                    yield done()
                held = chunk
                total[:], words[:] = 0.0, 0
            sums = np.frombuffer(sums, dtype="<f8")
            if docs:  # chunks of the same ids, as of null ones, are one
                ids = np.frombuffer(docs, dtype="<i8")
                total[: len(ids)] += sums
                words[: len(ids)] += np.frombuffer(sizes, dtype="<u4")
            else:
                total[np.frombuffer(owners, dtype="<u2")] += sums
    if held is not None:
        yield done()


def perplexities(docs: DataFrame, trained: Trained) -> DataFrame:
    """``doc_id, n_words, logp`` of every id of ``docs`` (doc_id, text); rows of one id are one document, those of a null id too."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(trained.model)
    docs = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), docs.columns[1])
    flow = docs.mapInArrow(_score_texts(shared), _FLOW)
    parts = (
        trained.corrections.unionByName(flow)
        .repartition(trained.model.shards, "shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(_join_shard, _SUMS)
        .repartition("chunk")
        .sortWithinPartitions("chunk")
        .mapInArrow(_add_up, "doc_id long, n_words long, logp double")
    )
    summed = parts.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), F.sum("logp").alias("logp"))
    return summed.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def score_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, vocabulary: int = VOCABULARY) -> DataFrame:
    """``doc_id, lang, n_words, perplexity, score, threshold, keep`` per document id.

    Trusted are documents whose ``labels.quality`` is 1 (and toxic not 1);
    nine in ten of them, by a hash of the id, are counted, the tenth sets each
    language's threshold: the quantile of its own texts, drawn towards that of
    all texts as if it had PRIOR_TEXTS of those as well, at every size alike.  ``score`` is the cost of a word with PRIOR_WORDS
    average words added; ``keep`` is score <= threshold.  Without words the
    perplexity is null and the text is not kept; a null language is ``und``;
    without trusted text nothing is rejected.  Repeated ids are one document,
    and so are all rows of a null id; extra columns are ignored.
    """
    narrow = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text", F.coalesce("lang", F.lit("und")).alias("lang"))
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) <> 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    trusted = F.broadcast(trusted) if labels.count() <= BROADCAST_LABELS else trusted
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0
    trained = train(narrow.join(trusted, "doc_id", "left_semi").where(~held_out).select("text"), vocabulary, open_vocabulary=True)
    found = perplexities(narrow.select("doc_id", "text"), trained)
    langs = narrow.groupBy(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")).agg(F.min("lang").alias("lang"))
    found = materialise(langs.join(found, langs["doc_id"].eqNullSafe(found["doc_id"])).select(langs["doc_id"], "lang", "n_words", "logp"), "perplexity")
    checked = found.join(trusted, "doc_id", "left_semi").where(held_out & (F.col("n_words") > 0))
    mean = checked.agg((-F.sum("logp") / F.sum("n_words")).alias("m")).first()["m"]
    cost = (-F.col("logp") + PRIOR_WORDS * F.lit(mean or 0.0)) / (F.col("n_words") + PRIOR_WORDS)
    percent = F.percentile_approx(cost, quantile, 100_000)
    per_lang = checked.groupBy("lang").agg(percent.alias("t"), F.count("*").alias("n")).select("lang", "t", F.col("n").alias("texts"))
    overall = F.lit(checked.agg(percent.alias("t")).first()["t"]).cast("double")
    joined = found.join(per_lang, "lang", "left")
    own = F.coalesce("texts", F.lit(0))
    threshold = (own * F.coalesce("t", F.lit(0.0)) + PRIOR_TEXTS * overall) / (own + PRIOR_TEXTS)
    return joined.select(
        "doc_id", "lang", "n_words", F.when(F.col("n_words") > 0, F.exp(-F.col("logp") / F.col("n_words"))).alias("perplexity"),
        cost.alias("score"), threshold.alias("threshold"),
        ((F.col("n_words") > 0) & F.coalesce(cost <= threshold, F.lit(True))).alias("keep"),
    )
