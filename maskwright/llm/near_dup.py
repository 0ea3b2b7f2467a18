"""MinHash near-duplicates by an LSH forest, confirmed on full shingle sets.

1. *Signatures.*  Each text becomes its set of distinct 5-word shingles, a
   digest of that set (its node) and 96 minhashes.  Texts with equal sets
   collapse to one node by an ordinary, map-side combined aggregation, so
   thousands of exact copies cost one row from here on.
2. *Forest.*  The minhashes are read in 16 orders.  A *region* is what shares a
   prefix of an order, at first of four values.  Region sizes are counted
   before anything else is sent.  Regions of at most REGION rows are compared
   whole.  Larger ones go deeper, each in a depth of its own: their rows are
   sorted by the order, range-partitioned so that no task sees a whole region,
   and linked with their longest-common-prefix neighbours.  A region that these
   links make one clump is finished, and so is one with a few strays besides a
   clump, which join it; any other is divided by two further pairs of values,
   independent of one another, so that it becomes two finer divisions of
   itself.  No row is left out of a region or forgotten in it.
   A link of similarity s is met below a region with the probability q that
   solves q = s^2 (1 - (1 - q)^2) however deep the region has to go: at 0.85
   a link is missed by all 16 trees with a probability of 7e-6 where regions
   are small and of 9e-5 where all its regions are endlessly dense; at 0.8
   these are 2e-4 and 5e-3.
3. *Clumps.*  Rows whose sketches agree far below the threshold are candidates;
   connected candidates form clumps, and every link found lies inside one.
4. *Confirmation.*  Clumps of bounded size are settled in one task each from
   the full sets, all of them.  In a larger one all members are first compared
   with its medoid; regions of the forest that then have more than one
   component are settled from full sets: small ones whole, dense ones with a
   main component and a few strays in blocks of rows together with all strays,
   the others divided as above.

Nulls and empty texts have an empty set: ``n_shingles`` 0, own component, kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import materialise
from .textkernel import U64, shingle_set

TREES, MIN_DEPTH, HASHES = 16, 4, 96
#: a dense region is divided in two ways, each by so many further values, at most LEVELS times
WAYS, STEP, LEVELS = 2, 2, 12
#: neighbours are linked and components found anew every so many divisions
RELABEL = 4
#: rows of a region compared whole
REGION = 512
#: neighbours in a dense region's order that a row is compared with
NEIGHBOURS = 3
#: how far the agreement of the minhashes of a candidate may lie below the threshold
MARGIN = 0.23
#: clumps and regions up to this many members and shingles are settled from full sets in one task
CLUMP_DOCS, CLUMP_SHINGLES = 1024, 4_000_000
#: region keys and nodes are broadcast up to this many (8 bytes each), else joined by shuffle
BROADCAST_KEYS = 500_000
#: sets of medoids and sketches of giant clumps are broadcast up to this many bytes, else joined by shuffle
BROADCAST_BYTES = 32 << 20
_MULTIPLIERS = np.random.default_rng(20240229).integers(1, 1 << 63, HASHES, dtype=np.uint64) * U64(2) + U64(1)
_LINKS = "a long, b long"


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the minima under 96 multiplicative permutations."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(low, (_MULTIPLIERS[:, None] * shingles[None, at : at + 1024]).min(axis=1), out=low)
    return (low >> U64(32)).astype(">u4")


def _node(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, signs, sketches = [], [], [], []
            for text in batch.column(2):
                shingles = shingle_set(text.as_py(), n)
                sizes.append(len(shingles))
                nodes.append(_node(shingles) if len(shingles) else None)
                signs.append(minhashes(shingles).tobytes() if len(shingles) else None)
                sketches.append(signs[-1][3::4] if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(signs, pa.binary()), pa.array(sketches, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "node", "sig", "sketch"],
            )

    return run


def _sets(n: int):
    """(node, text) -> node, shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = ((node, shingle_set(t.as_py(), n)) for node, t in zip(part.column(0).to_pylist(), part.column(1)))
                kept = [(node, s.tobytes()) for node, s in made if _node(s) == node]  # a repeated id brings its other texts too
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*kept), (pa.int64(), pa.binary()))], ["node", "shingles"])

    return run


def _find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])


def _share(equal: np.ndarray) -> np.ndarray:
    """Share of equal minhashes from that of equal bytes, less what chance gives."""
    return (equal / HASHES - 1 / 256) / (1 - 1 / 256)


def _matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(len(sketches), HASHES)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows with the same first column, which come one after the other."""
    key, rows = None, []
    for batch in batches:
        for here, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if here != key:
                if rows:
                    yield rows
                key, rows = here, []
            rows.append(rest)
    if rows:
        yield rows


def _compare(floor: float):
    """(key, node, sketch) sorted by key -> a link from each node to the first that candidates connect it with in its region."""

    def candidates(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        table = _matrix([s for _, s in rows])
        parent = list(range(len(rows)))
        for i in range(1, len(rows)):
            for j in np.flatnonzero(_share((table[:i] == table[i]).sum(axis=1)) >= floor).tolist():
                a, b = _find(parent, i), _find(parent, j)
                parent[max(a, b)] = min(a, b)
        for i in range(1, len(rows)):
            if (root := _find(parent, i)) != i:
                yield rows[i][0], rows[root][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for rows in _runs(batches):
            if len(rows) > 1:
                out += candidates(rows)
            if len(out) >= 4096:
                yield _link_batch(out)
                out = []
        if out:
            yield _link_batch(out)

    return run


def _neighbours(floor: float, by_label: bool = False):
    """(key, node, label, sketch) sorted by key and order -> links of near neighbours of different labels, a spanning forest a task.

    ``by_label`` gives the labels that a task's links connect, each with the
    smallest, instead of the pairs of nodes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        tail: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, label = (batch.column(c).to_numpy() for c in range(3))
            table = _matrix(batch.column(3).to_pylist())
            if tail is not None:
                key, node, label, table = (np.concatenate(x) for x in zip(tail, (key, node, label, table)))
            old = 0 if tail is None else len(tail[0])
            out = []
            for w in range(1, NEIGHBOURS + 1):
                at = np.arange(max(old, w), len(key))
                at = at[key[at] == key[at - w]]
                at = at[_share((table[at] == table[at - w]).sum(axis=1)) >= floor]
                for i in at.tolist():
                    x, y = int(label[i]), int(label[i - w])
                    a, b = _find(parent, parent.setdefault(x, x) and x), _find(parent, parent.setdefault(y, y) and y)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        out.append((int(node[i]), int(node[i - w])))
            if out and not by_label:
                yield _link_batch(out)
            tail = tuple(x[-NEIGHBOURS:] for x in (key, node, label, table))
        stars = [(x, root) for x in parent if (root := _find(parent, x)) != x] if by_label else []
        if stars:
            yield _link_batch(stars)

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of a bounded list of sorted distinct arrays."""
    m = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.concatenate(([0], (values[1:] != values[:-1]).astype(np.int64))))
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    total = np.zeros((m, m), dtype=np.float32)
    if len(column):
        column = np.cumsum(np.concatenate(([0], (column[1:] != column[:-1]).astype(np.int64))))
        for low in range(0, int(column[-1]) + 1, 4096):
            here = slice(*np.searchsorted(column, [low, low + 4096]))
            block = np.zeros((m, 4096), dtype=np.float32)
            block[owner[here], column[here] - low] = 1
            total += block @ block.T
    return np.rint(total).astype(np.int64)


def _settle_runs(percent: int):
    """(key, node, shingles) sorted by key -> a link from each node to the smallest it is connected with in its run."""

    def settle(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        by_node = dict(rows)  # a repeated row of a table brings its set twice
        nodes = sorted(by_node)
        sets = [np.frombuffer(by_node[d], dtype=np.uint64) for d in nodes]
        sizes = np.array([len(s) for s in sets])
        parent = list(range(len(nodes)))
        inter = intersections(sets)
        linked = np.triu(100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter), 1)
        for i, j in zip(*np.nonzero(linked)):
            a, b = _find(parent, int(i)), _find(parent, int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
        for i in range(len(nodes)):
            if (root := _find(parent, i)) != i:
                yield nodes[i], nodes[root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for rows in _runs(batches):
            if len(rows) > 1:
                out += settle(rows)
            if len(out) > 4096:
                yield _link_batch(out)
                out = []
        if out:
            yield _link_batch(out)

    return run


def _consensus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(clump, sketch) -> counts of each byte value at each position, one row per clump and batch."""
    for batch in batches:
        counts: dict[int, np.ndarray] = {}
        for clump, sketch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if clump not in counts:
                counts[clump] = np.zeros((HASHES, 256), dtype=np.int64)
            counts[clump][np.arange(HASHES), np.frombuffer(sketch, dtype=np.uint8)] += 1
        for clump, table in counts.items():
            cell = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cell), clump), pa.int64()), pa.array(cell, pa.int64()), pa.array(table.ravel()[cell], pa.int64())],
                ["clump", "cell", "n"],
            )


def _to_mode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(clump, node, sketch, mode) -> how many minhashes are the clump's commonest."""
    for batch in batches:
        same = [
            int((np.frombuffer(s, dtype=np.uint8) == np.frombuffer(bytes(m), dtype=np.uint8)).sum())
            for s, m in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.int64())], ["clump", "node", "same"])


def _confirm(percent: int):
    """(a, b, set of a, set of b) -> the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out.append((a, b))
            if out:
                yield _link_batch(out)

    return run


def _small(df: DataFrame, limit: int) -> DataFrame:
    """``df``, a written table, broadcast if it has at most ``limit`` rows."""
    return F.broadcast(df) if df.count() <= limit else df


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _first_keys(*also: str | Column) -> Column:
    """One struct (tree, key) a tree."""
    width = 4 * MIN_DEPTH
    return F.array(
        *[F.struct(F.lit(t).alias("tree"), F.xxhash64(*also, F.lit(t), F.substring("sig", t * width + 1, width)).alias("key")) for t in range(TREES)]
    )


def _finer(rows: DataFrame) -> DataFrame:
    """Each region divided in WAYS ways by STEP further values of its order.

    ``path`` numbers the divisions of a tree as a heap does; it decides which
    values are taken, so the two ways of a region use different ones, and no
    way uses again what led to it as long as there are others.
    """
    values = HASHES - MIN_DEPTH
    path = f"(path * {WAYS} + 1 + way)"
    value = lambda k: f"substring(sig, 4 * ((tree * {MIN_DEPTH} + {MIN_DEPTH} + ({path} * {7 * STEP} + {k}) % {values}) % {HASHES}) + 1, 4)"
    key = f"xxhash64(key, way, {', '.join(value(k) for k in range(STEP))})"
    ways = F.explode(F.array(*[F.lit(w) for w in range(WAYS)])).alias("way")
    return rows.select("*", ways).withColumns({"key": F.expr(key), "path": F.expr(f"cast({path} as int)")}).drop("way")


def _forest(
    rows: DataFrame,
    labels: DataFrame | None,
    limits: tuple[int, int],
    settle: Callable[[DataFrame], DataFrame],
    neighbours: Callable[[DataFrame], DataFrame],
    strays: Callable[[DataFrame], DataFrame],
    rest: Callable[[DataFrame], DataFrame],
) -> list[DataFrame]:
    """Links in all regions of ``rows`` (key, tree, node, n_shingles, sketch, sig).

    ``labels`` (node, label): what is known to be connected.  ``settle`` links
    the rows of regions within ``limits`` (rows, shingles).  In denser ones
    ``neighbours`` links rows to their neighbours; those that are then of one
    label are finished, those with few rows of other labels than the commonest
    go to ``strays`` (rows with columns ``main``, the commonest label, and
    ``alone``), the others are divided.  What LEVELS divisions leave is handed
    to ``rest``.
    """
    found: list[DataFrame] = []
    rows = rows.withColumn("path", F.lit(0))
    for level in range(LEVELS + 1):
        named = rows.withColumn("label", F.col("node"))
        if labels is not None:
            named = rows.join(_small(labels, BROADCAST_KEYS), "node", "left").withColumn("label", F.coalesce("label", "node"))
        sizes = named.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("mass"), F.min("label").alias("low"), F.max("label").alias("high"))
        dense = (F.col("n") > limits[0]) | (F.col("mass") > limits[1])
        mixed = materialise(sizes.where("low <> high").select("key", dense.alias("dense")), "regions")
        n = {r["dense"]: r["count"] for r in mixed.groupBy("dense").count().collect()}
        if n.get(False):
            few = mixed.where("not dense").select("key")
            found.append(settle(rows.join(F.broadcast(few) if n[False] <= BROADCAST_KEYS else few, "key", "left_semi")))
        if not n.get(True):
            break
        wide = mixed.where("dense").select("key")
        inner = materialise(named.join(F.broadcast(wide) if n[True] <= BROADCAST_KEYS else wide, "key", "left_semi"), "dense")
        if level == LEVELS:
            found.append(rest(inner))
            break
        if level % RELABEL == 0:
            order = F.substring(F.col("sig"), F.col("tree") * (4 * MIN_DEPTH) + (4 * MIN_DEPTH + 1), F.lit(32))
            ordered = inner.select("key", "node", "label", "sketch", order.alias("order")).repartitionByRange("key", "order")
            near = materialise(neighbours(ordered.sortWithinPartitions("key", "order", "node").select("key", "node", "label", "sketch")), "neighbours")
            if not near.isEmpty():
                found.append(near)
                links = near if labels is None else near.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
                labels = materialise(connected_components(links).select("node", F.col("component").alias("label")), "labels")
                inner = inner.drop("label").join(_small(labels, BROADCAST_KEYS), "node", "left").withColumn("label", F.coalesce("label", "node"))
        shares = inner.groupBy("key", "label").agg(F.count("*").alias("n"))
        main = shares.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("main")).where("main.n < n")
        main = materialise(main.select("key", F.col("main.label").alias("main"), (F.col("n") - F.col("main.n") <= limits[0] // 4).alias("few")), "main")
        inner = inner.join(_small(main, BROADCAST_KEYS // 2), "key")
        found.append(strays(inner.where("few").withColumn("alone", F.col("label") != F.col("main"))))
        rows = _finer(inner.where("not few").drop("label", "main", "few"))
    return found


def _candidates(unique: DataFrame, floor: float) -> DataFrame:
    """Pairs whose sketches agree in at least ``floor``, connecting all that such pairs of one region connect."""
    rows = unique.select("node", "n_shingles", "sketch", "sig", F.explode(_first_keys()).alias("e")).select("node", "n_shingles", "sketch", "sig", "e.*")

    def settle(few: DataFrame) -> DataFrame:
        return few.select("key", "node", "sketch").repartition("key").sortWithinPartitions("key", "node").mapInArrow(_compare(floor), _LINKS)

    def strays(some: DataFrame) -> DataFrame:  # into the clump, so that full sets decide
        return some.where("alone").select(F.col("node").alias("a"), F.col("main").alias("b"))

    def rest(inner: DataFrame) -> DataFrame:  # one clump each
        least = materialise(inner.groupBy("key").agg(F.min("node").alias("b")), "least")
        return inner.join(_small(least, BROADCAST_KEYS), "key").select(F.col("node").alias("a"), "b")

    found = _forest(rows, None, (REGION, 1 << 62), settle, lambda ordered: ordered.mapInArrow(_neighbours(floor, by_label=True), _LINKS), strays, rest)
    return _all(found) if found else unique.sparkSession.createDataFrame([], _LINKS)


def _settle(rows: DataFrame, key: str, percent: int) -> DataFrame:
    return rows.select(key, "node", "shingles").repartition(key).sortWithinPartitions(key, "node").mapInArrow(_settle_runs(percent), _LINKS)


def _pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.distinct().join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(_confirm(percent), _LINKS)


def _medoids(members: DataFrame) -> DataFrame:
    """clump, pivot: the member of each clump nearest to its commonest minhashes."""
    cells = members.select("clump", "sketch").mapInArrow(_consensus, "clump long, cell long, n long").groupBy("clump", "cell").agg(F.sum("n").alias("n"))
    top = cells.groupBy("clump", F.floor(F.col("cell") / 256).alias("at")).agg(F.max(F.struct("n", (F.col("cell") % 256).alias("value"))).alias("m"))
    mode = top.groupBy("clump").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "m.value"))), lambda x: x["value"].cast("int")).alias("mode"))
    mode = _small(materialise(mode, "mode"), BROADCAST_BYTES // (4 * HASHES))
    fit = members.select("clump", "node", "sketch").join(mode, "clump").mapInArrow(_to_mode, "clump long, node long, same long")
    return fit.groupBy("clump").agg(F.max_by("node", F.struct("same", "node")).alias("pivot"))


def _giant_links(members: DataFrame, percent: int, floor: float) -> DataFrame:
    """Links that connect what is connected inside clumps too large for one task.

    ``members``: clump, node, n_shingles, sketch, sig, shingles.
    """
    sets = members.select("node", "shingles")
    pivots = materialise(_medoids(members).join(members.withColumnRenamed("node", "pivot"), ["clump", "pivot"]).select("clump", "pivot", "shingles"), "pivots")
    size = pivots.agg(F.sum(F.length("shingles"))).first()[0] or 0
    pivots = pivots.select("clump", "pivot", F.col("shingles").alias("right"))
    pivots = F.broadcast(pivots) if size <= BROADCAST_BYTES else pivots
    paired = members.select("clump", "node", "shingles").join(pivots, "clump").where("node <> pivot")
    hung = materialise(paired.select(F.col("node").alias("a"), F.col("pivot").alias("b"), F.col("shingles").alias("left"), "right").mapInArrow(_confirm(percent), _LINKS), "hung")
    labels = hung.select(F.col("a").alias("node"), F.col("b").alias("label"))
    rows = members.select("node", "n_shingles", "sketch", "sig", F.explode(_first_keys("clump")).alias("e")).select("node", "n_shingles", "sketch", "sig", "e.*")

    def settle(few: DataFrame) -> DataFrame:
        return _settle(few.select("key", "node").join(sets, "node"), "key", percent)

    def neighbours(ordered: DataFrame) -> DataFrame:
        return _pairs(ordered.mapInArrow(_neighbours(floor), _LINKS), sets, percent)

    def blocks(docs: DataFrame) -> DataFrame:
        return docs.groupBy("key").agg(F.ceil(F.count("*") / 256).alias("blocks"))

    def strays(some: DataFrame) -> DataFrame:
        """The rows of a region in blocks, each together with all strays."""
        some = some.select("key", "node", "alone")
        dealt = some.join(blocks(some), "key")
        of = F.when(F.col("alone"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("blocks"))))
        met = dealt.select("key", "node", F.explode(of).alias("block"))
        return _settle(met.select(F.xxhash64("key", "block").alias("key"), "node").join(sets, "node"), "key", percent)

    def rest(inner: DataFrame) -> DataFrame:
        """The exact way for rows that share 28 values and more and yet have different components: blocks against blocks."""
        docs = inner.select("key", "node").distinct()
        dealt = docs.join(blocks(docs), "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        met = dealt.select("key", "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"), "block")
        met = met.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "node")
        return _settle(met.join(sets, "node"), "key", percent)

    return _all([hung, *_forest(rows, labels, (CLUMP_DOCS, CLUMP_SHINGLES), settle, neighbours, strays, rest)])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash`` for every row of ``docs``.

    Two texts are linked where 100 * |A and B| >= ``percent`` * |A or B| for
    their sets of distinct ``words``-word shingles.  ``component_id`` is the
    smallest id reachable over links; ``kept`` marks that document.  Rows with
    the same id but different texts are documents of their own, told apart by
    ``text_hash``, Spark's xxhash64 of the text.  A null id is never smallest: a
    component of null ids only has the id null and is kept.  Extra columns of
    ``docs`` are ignored; an empty table gives an empty result.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    signed = narrow.mapInArrow(_signatures(words), "doc_id long, text_hash long, n_shingles long, node long, sig binary, sketch binary")
    signed = materialise(signed, "signatures")
    nameless = F.when(F.col("doc_id").isNull(), F.col("text_hash"))
    unique = signed.where("n_shingles > 0").groupBy("node", "n_shingles", "sig", "sketch").agg(F.min("doc_id").alias("doc"), F.min(nameless).alias("nameless"))
    unique = materialise(unique, "unique")
    floor = percent / 100 - MARGIN
    clumps = materialise(connected_components(_candidates(unique, floor)).select("node", F.col("component").alias("clump")), "clumps")
    wanted = materialise(unique.join(clumps, "node").select("node", "clump", "n_shingles", "doc", F.when(F.col("doc").isNull(), F.col("nameless")).alias("nameless")), "wanted")
    total = wanted.count()
    near = total <= BROADCAST_KEYS
    ids = wanted.select("node", F.col("doc").alias("i"), F.col("nameless").alias("h"))
    ids = F.broadcast(ids) if near else ids
    keyed = narrow.select("doc_id", nameless.alias("nameless"), "text")
    sets = keyed.join(ids, keyed["doc_id"].eqNullSafe(ids["i"]) & keyed["nameless"].eqNullSafe(ids["h"])).select("node", "text").mapInArrow(_sets(words), "node long, shingles binary")
    weight = wanted.groupBy("clump").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("mass"))
    giants = materialise(weight.where((F.col("docs") > CLUMP_DOCS) | (F.col("mass") > CLUMP_SHINGLES)).select("clump"), "giants")
    some = giants.count()
    place = wanted.select("node", "clump")
    place = F.broadcast(place) if near else place
    if some:
        few = F.broadcast(giants) if some <= BROADCAST_KEYS else giants
        placed = materialise(sets, "sets").join(place, "node")
        large = placed.join(few, "clump", "left_semi").dropDuplicates(["node"]).join(unique.select("node", "n_shingles", "sketch", "sig"), "node")
        links = _settle(placed.join(few, "clump", "left_anti"), "clump", percent).unionByName(_giant_links(materialise(large, "giant-members"), percent, floor))
    else:
        links = _settle(sets.join(place, "node"), "clump", percent)
    component = materialise(connected_components(links), "components")
    least = unique.select("node", "doc").join(component, "node").groupBy("component").agg(F.min("doc").alias("least"))
    grouped = component.join(least, "component").select(F.col("node").alias("at"), "least")
    grouped = F.broadcast(grouped) if near else grouped
    best = unique.select(F.col("node").alias("its"), "doc").join(grouped, F.col("its") == F.col("at"), "left")
    best = best.select("its", F.when(F.col("at").isNull(), F.col("doc")).otherwise(F.col("least")).alias("smallest"))
    return (
        signed.select("doc_id", "n_shingles", "node", "text_hash")
        .join(best, F.col("node") == F.col("its"), "left")
        .select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"), "text_hash")
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")
    )
