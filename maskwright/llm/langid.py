"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector, made from its code point.  A letter
trigram is the product (binding) of its letters' vectors, the first rotated
twice, the second once, so that order matters.  A text is the sum (bundle) of
its trigrams' vectors.  A language's prototype is the mean of the normalised
vectors of its training texts; what all prototypes have in common is taken
away from both sides before a text is compared with them by cosine.

Bundling is linear, so a text is counted first - its distinct trigrams - and
only those are bound.  Training sums leave each task as one vector a language.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise

DIMENSIONS = 1024
UNKNOWN = "und"
#: training vectors are added up as whole numbers of this fraction, so that no order of tasks changes a prototype
UNIT = 1 << 24
#: trigram vectors remembered by a worker
CACHE_ROWS = 60_000
_SPACE = 32


def is_held_out(doc_id: int | None) -> bool:
    """Rows never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return zlib.crc32(str(doc_id).encode()) % 4 == 2 if doc_id is not None else False


class _Alphabet:
    """code point -> lower-case letter or mark, or space for all that is neither; grown as characters are met."""

    def __init__(self):
        self.table = np.full(0x110000, -1, dtype=np.int32)
        self.is_letter = np.zeros(0x110000, dtype=bool)

    def letters(self, text: str) -> np.ndarray:
        """The mapped characters of a text; none if it has no letter."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        mapped = self.table[points]
        if len(mapped) and mapped.min() < 0:
            for point in np.unique(points[mapped < 0]).tolist():
                char = chr(point)
                low = char.lower()
                self.is_letter[point] = char.isalpha()
                self.table[point] = ord(low[0]) if char.isalpha() or unicodedata.category(char)[0] == "M" else _SPACE
            mapped = self.table[points]
        return mapped if self.is_letter[points].any() else mapped[:0]


class _Trigrams:
    """Trigram code -> its vector, one row of a bounded table."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.items: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.rows: dict[int, int] = {}
        self.table = np.empty((1024, self.dimensions), dtype=np.int8)

    def item(self, letter: int) -> np.ndarray:
        if letter not in self.items:
            bits = np.random.default_rng(letter).integers(0, 2, self.dimensions, dtype=np.int8)
            self.items[letter] = bits * 2 - 1
        return self.items[letter]

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        if len(self.rows) + len(codes) > CACHE_ROWS:
            self.clear()
        rows = self.rows
        where = []
        for code in codes.tolist():
            row = rows.get(code)
            if row is None:
                row = rows[code] = len(rows)
                if row >= len(self.table):
                    self.table = np.concatenate((self.table, np.empty_like(self.table)))
                a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
                self.table[row] = np.roll(self.item(a), 2) * np.roll(self.item(b), 1) * self.item(c)
            where.append(row)
        return self.table[where]


_state: dict[int, tuple[_Alphabet, _Trigrams]] = {}


def profile(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Normalised bundle of the letter trigrams of a whole text; None without a letter."""
    if not text:
        return None
    if dimensions not in _state:
        _state[dimensions] = (_Alphabet(), _Trigrams(dimensions))
    alphabet, trigrams = _state[dimensions]
    letters = alphabet.letters(text)
    if not len(letters):
        return None
    letters = letters[np.concatenate(([True], (letters[1:] != _SPACE) | (letters[:-1] != _SPACE)))]
    padded = np.concatenate(([_SPACE], letters, [_SPACE])).astype(np.int64)
    codes = np.sort(padded[:-2] << 42 | padded[1:-1] << 21 | padded[2:])
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    counts = np.diff(np.append(first, len(codes)))
    codes = codes[first]
    total = np.zeros(dimensions, dtype=np.float32)
    for at in range(0, len(codes), 4096):
        total += np.sqrt(counts[at : at + 4096]).astype(np.float32) @ trigrams.vectors(codes[at : at + 4096]).astype(np.float32)
    norm = float(np.linalg.norm(total))
    return total / norm if norm else None


def letter_counts(text: str) -> dict[int, int]:
    """How often each letter, as a lower-case code point, occurs in a text."""
    mapped = _alphabet().letters(text)
    points, counts = np.unique(mapped[mapped != _SPACE], return_counts=True)
    return dict(zip(points.tolist(), counts.tolist()))


def _alphabet() -> _Alphabet:
    if DIMENSIONS not in _state:
        _state[DIMENSIONS] = (_Alphabet(), _Trigrams(DIMENSIONS))
    return _state[DIMENSIONS][0]


_SUMS = pa.schema([("lang", pa.string()), ("at", pa.int32()), ("v", pa.int64()), ("n", pa.int64())])


def _bundle(dimensions: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        sizes: dict[str, int] = {}
        letters: Counter = Counter()
        for part in source:
            for text, lang in zip(part.column(0), part.column(1).to_pylist()):
                vector = profile(text.as_py(), dimensions)
                if vector is not None:
                    letters.update(letter_counts(text.as_py()))
                    sums[lang] = sums.get(lang, 0) + np.rint(vector * UNIT).astype(np.int64)
                    sizes[lang] = sizes.get(lang, 0) + 1
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * dimensions, "at": list(range(dimensions)), "v": vector.tolist(), "n": [sizes[lang]] * dimensions},
                _SUMS,
            )
        # letters have no language: what they are common in is not what they are asked for
        yield pa.RecordBatch.from_pydict({"lang": [None] * len(letters), "at": list(letters), "v": list(letters.values()), "n": [0] * len(letters)}, _SUMS)

    return run


class Prototypes:
    """Language names and their centred unit vectors: languages x dimensions numbers, whatever the corpus."""

    def __init__(self, langs: list[str], vectors: np.ndarray, letters: frozenset[int] = frozenset()):
        self.langs, self.letters = langs, letters
        unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12) if len(langs) else vectors
        self.common = unit.mean(axis=0) if len(langs) > 1 else np.zeros(unit.shape[1], dtype=np.float64)
        centred = unit - self.common
        self.unit = (centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)).astype(np.float32)
        self.common = self.common.astype(np.float32)

    def known_share(self, text: str) -> float:
        """Share of a text's letters that the training texts have."""
        counts = letter_counts(text)
        return sum(n for c, n in counts.items() if c in self.letters) / max(1, sum(counts.values()))

    def predict(self, text: str | None) -> tuple[str, float]:
        vector = profile(text, self.common.shape[0])
        if vector is None or not self.langs:
            return UNKNOWN, 0.0
        vector = vector - self.common
        cosines = self.unit @ vector / max(float(np.linalg.norm(vector)), 1e-12)
        best = int(cosines.argmax())
        return self.langs[best], min(1.0, max(0.0, float(cosines[best])))


#: letters rarer than this in the training texts are strays in them
LEAST_SHARE = 1e-5
#: languages a model may have; their prototypes are this many times DIMENSIONS numbers at most
MAX_LANGUAGES = 4096


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> Prototypes:
    """Prototypes from all rows with a text and a language.

    More than MAX_LANGUAGES distinct labels are an error, told before anything
    is bundled, as such a column holds no languages.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, lang_col)
    if rows.select(lang_col).distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sums = rows.mapInArrow(_bundle(dimensions), "lang string, at int, v long, n long").groupBy("lang", "at").agg(F.sum("v").alias("v"))
    sums = materialise(sums, "language-sums")
    counts = {r["at"]: r["v"] for r in sums.where("lang is null").select("at", "v").collect()}  # a row a letter
    letters = frozenset(c for c, n in counts.items() if n >= LEAST_SHARE * sum(counts.values()))
    table = sums.where("lang is not null").groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("v")).orderBy("lang").collect()
    return Prototypes([r["lang"] for r in table], np.array([r["v"] for r in table], dtype=np.float64).reshape(len(table), dimensions), letters)


def _predict(model: Prototypes):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in source:
            found = [model.predict(text.as_py()) for text in part.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([is_held_out(d) for d in part.column(0).to_pylist()], pa.bool_()),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows a model may learn from."""
    return docs.where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2)


def identify(docs: DataFrame, model: Prototypes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no
    letter; else the nearest prototype and the cosine, cut to 0..1.  Ties go to
    the first language by name.  Extra columns are ignored.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Prototypes, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has letters and is at least ``min_score`` like some language.

    At least half of its letters must be letters the training texts have: texts
    in another script are somewhat like some language by chance.  Null and empty
    texts go; a model without languages accepts nothing.
    """

    @F.arrow_udf("boolean")
    def passes(texts: pa.Array) -> pa.Array:
        found = ((t.as_py(), *model.predict(t.as_py())) for t in texts)
        return pa.array([lang != UNKNOWN and score >= min_score and model.known_share(t) >= 0.5 for t, lang, score in found], pa.bool_())

    return docs.where(passes(F.col(text_col)))
