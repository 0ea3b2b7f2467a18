"""Repeated-line removal over levelled sorted runs of line hashes.

A *run* is a table ``h1, h2, n`` - 128-bit line keys with the number of
documents they were found in - sorted by key.  :class:`LineRuns` keeps runs in
levels as a log-structured merge store does: each ingested batch adds one run
to level 0, and when a level holds ``fanout`` runs they are merged into one run
of the level above.  Each batch is merge-anti-joined with the keys the runs
know as frequent before it adds its own; what it takes away is settled, the
rest waits for the runs of all batches.  Both sides of every merge are written
tables, so a line that a third of all documents share is dealt to several tasks
by AQE; nothing but counters is ever held on the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import materialise, remove, scratch_path

BLANKS = b" \t\n\v\f\r"
#: documents' drop lists are broadcast up to this many keys (16 bytes each), else joined by shuffle
BROADCAST_KEYS = 1_000_000
PENDING = "doc_id long, h1 long, h2 long, batch int"


def line_keys(text: str | None, min_chars: int) -> tuple[list[bytes], list[tuple[int, int] | None]]:
    """The lines of a text (null or empty: one empty line) and their keys, None for keys too short."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    keys = []
    for line in lines:
        key = line.strip(BLANKS).lower()  # bytes.lower() touches A-Z only
        if not key or (min_chars > 1 and len(key.decode("utf-8", "surrogatepass")) < min_chars):
            keys.append(None)
        else:
            h = xxhash.xxh3_128_intdigest(key)
            keys.append(((h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)))
    return lines, keys


def _extract(min_chars: int, batches: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in source:
            out: tuple[list, ...] = ([], [], [], [])
            for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                for key in {k for k in line_keys(text.as_py(), min_chars)[1] if k}:
                    for column, value in zip(out, (doc, *key, (doc or 0) * 2654435761 % 4294967291 % batches)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.int32())], ["doc_id", "h1", "h2", "batch"])

    return run


def _rewrite(min_chars: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in source:
            n_lines, n_dropped, kept = [], [], []
            for text, drops in zip(part.column(1), part.column(2).to_pylist()):
                text = text.as_py() or ""
                if not drops:
                    n_lines.append(text.count("\n") + 1)
                    n_dropped.append(0)
                    kept.append(text)
                    continue
                gone = {(d["h1"], d["h2"]) for d in drops}
                lines, keys = line_keys(text, min_chars)
                stay = [line for line, key in zip(lines, keys) if key not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string()), *part.columns[3:]],
                ["doc_id", "n_lines", "n_dropped", "kept_text", *part.schema.names[3:]],
            )

    return run


class LineRuns:
    """Levelled sorted runs of line keys below ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 4):
        self.spark, self.path, self.fanout = spark, path or scratch_path(spark, "line-runs"), fanout
        self.levels: dict[int, list[str]] = {}
        self._serial = 0

    def _write(self, counts: DataFrame, level: int) -> None:
        place = f"{self.path}/level={level}/run={self._serial:06d}"
        self._serial += 1
        counts.groupBy("h1", "h2").agg(F.sum("n").alias("n")).sortWithinPartitions("h1", "h2").write.parquet(place)
        self.levels.setdefault(level, []).append(place)

    def _read(self, places: list[str]) -> DataFrame:
        schema = "h1 long, h2 long, n long"
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def ingest(self, keys: DataFrame) -> None:
        """Add one batch of (doc_id, h1, h2), distinct per document, as a new run; compact full levels."""
        self._write(keys.select("h1", "h2", F.lit(1).cast("long").alias("n")), 0)
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            full = self.levels.pop(level)
            self._write(self._read(full), level + 1)
            for place in full:
                remove(self.spark, place)
            level += 1

    def counts(self) -> DataFrame:
        """h1, h2, n over all runs."""
        return self._read([p for runs in self.levels.values() for p in runs]).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys found in at least ``min_docs`` documents, as a table of its own."""
        return materialise(self.counts().where(F.col("n") >= min_docs).select("h1", "h2"), "frequent")

    def unseen(self, keys: DataFrame, min_docs: int = 1) -> DataFrame:
        """Merge-anti-join: the rows of ``keys`` whose line is in fewer than ``min_docs`` documents of the runs."""
        return keys.join(self.frequent(min_docs).hint("merge"), ["h1", "h2"], "left_anti")

    def seen(self, keys: DataFrame, min_docs: int = 1) -> DataFrame:
        """What :meth:`unseen` takes away."""
        return keys.join(self.frequent(min_docs).hint("merge"), ["h1", "h2"], "left_semi")

    def divide(self, keys: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
        """``unseen`` and ``seen`` of one merge, as tables."""
        if not self.levels:
            return keys, keys.limit(0)
        known = self.frequent(min_docs).withColumn("known", F.lit(True))
        marked = materialise(keys.join(known.hint("merge"), ["h1", "h2"], "left"), "divided")
        return marked.where("known is null").drop("known"), marked.where("known").drop("known")


def line_key_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, batches: int = 1) -> DataFrame:
    """``doc_id, h1, h2, batch``: the distinct line keys of each document."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(_extract(min_chars, batches), PENDING)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    runs: LineRuns | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` for every row of ``docs``.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z
    lower-cased; keys of at least ``min_chars`` code points found in at least
    ``min_docs`` documents lose all their lines everywhere.  The table is
    ingested in ``batches`` runs; pass ``runs`` to go on from earlier corpora.
    Null and empty texts are one empty line, which has no key and stays.  A null
    id is one like any other.  Repeated ids count as documents of their own; extra columns are ignored but
    for those named in ``carry``, which follow.
    """
    extra = docs.select(carry or [])
    rest = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(extra.columns)]
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    runs = runs or LineRuns(docs.sparkSession)
    place = scratch_path(docs.sparkSession, "line-keys")
    line_key_table(narrow, min_chars=min_chars, batches=batches).write.partitionBy("batch").parquet(place)
    keys = docs.sparkSession.read.schema(PENDING).parquet(place)
    waiting, settled = [], []
    for b in range(batches):
        batch = keys.where(F.col("batch") == b).select("doc_id", "h1", "h2")  # one folder
        unseen, seen = runs.divide(batch, min_docs)
        runs.ingest(batch)
        waiting.append(unseen)
        settled.append(seen)
    settled.append(runs.seen(reduce(DataFrame.unionByName, waiting), min_docs))
    drops = reduce(DataFrame.unionByName, settled).groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("drops"))
    drops = materialise(drops.withColumnRenamed("doc_id", "drop_id"), "line-drops")
    total = drops.agg(F.sum(F.size("drops") + 1)).first()[0] or 0
    drops = F.broadcast(drops) if total <= BROADCAST_KEYS else drops
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *rest)
    names = [f"carried_{i}" for i in range(len(extra.columns))]
    joined = source.join(drops, source["doc_id"].eqNullSafe(drops["drop_id"]), "left").select("doc_id", "text", "drops", *names)
    schema = "doc_id long, n_lines long, n_dropped long, kept_text string"
    schema += "".join(f", {n} {f.dataType.simpleString()}" for n, f in zip(names, extra.schema))
    return joined.mapInArrow(_rewrite(min_chars), schema).withColumnsRenamed(dict(zip(names, extra.columns)))


#: DuckDB form of op4_line_dedup
ORACLE = r"""
WITH lines AS (
  SELECT d.doc_id, g.pos, string_split(coalesce(d.text, ''), chr(10))[g.pos] AS line
  FROM documents d, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) AS pos) g
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE k IN (SELECT k FROM frequent))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE k NOT IN (SELECT k FROM frequent)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id
"""
