"""Exact Jaccard join of documents on word n-grams, by trees of count vectors.

A document's shingles are hashed into groups. Two sets that are similar enough differ in so few shingles that, of
more groups than that, at least one holds exactly the same shingles in both: sets that share such a group meet as a
block. Within a block each set is a point, its shingle counts by group, and an R-tree over the points finds the
pairs whose overlap, bounded by the sum of the smaller coordinates, can reach the threshold. What hangs together by
surviving pairs is verified on the shingles themselves, tile by tile, again behind an R-tree.

Sets that are equal are one set throughout: copies are never compared with each other.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulback.llm.components import components
from haulback.llm.shingles import mixed, shingle_set
from haulback.llm.tables import batched, columns
from haulback.session import materialize

#: Shingles of the sets that one task compares with each other or with as many others, about.
TILE_SHINGLES = 400_000
TILE_SETS = 1000
#: Points of a tree's leaf.
LEAF = 32
#: Points of a block whose pairs are bounded; the points of a larger one count as hanging together, and are verified as such.
BLOCK_POINTS = 1024
#: Sets that a task remembers so as to give the keys of copies once.
KEPT_SETS = 1_000_000
#: Coordinates of a point at most, and the largest value of one; cutting counts off only loosens the bound.
MOST_GROUPS, MOST_COUNT = 256, 255


class Threshold:
    """Similar means den * intersection >= num * union, of sets of n-grams of ``size`` words."""

    def __init__(self, num: int, den: int, size: int):
        self.num, self.den, self.size = num, den, size
        self.lows = [1]
        while self.lows[-1] < 1 << 40:
            self.lows.append(max(self.lows[-1] + 1, self.lows[-1] * 5 // 4))

    def overlap(self, a, b):
        """Shingles that sets of these sizes must share: the smallest i with den * i >= num * (a + b - i)."""
        return -((-self.num * (a + b)) // (self.num + self.den))

    def classes(self, n: int) -> range:
        """Size classes in which a set of ``n`` can meet similar ones: by the size of the smaller of two."""
        smallest = -((-self.num * n) // self.den)
        return range(self._class(smallest), self._class(n) + 1)

    def _class(self, n: int) -> int:
        return int(np.searchsorted(self.lows, n, side="right")) - 1

    @functools.lru_cache(maxsize=None)
    def layout(self, k: int) -> tuple[int, int, int]:
        """Of a size class: groups whose contents are keys, how many of them may be empty, coordinates of a point."""
        high = self.lows[k + 1] - 1
        differing = high * (self.den - self.num) // self.num
        spare = 1 + differing // 8 if differing else 0
        coordinates = 16
        while coordinates < min(MOST_GROUPS, high // 8):
            coordinates *= 2
        return differing + 1 + spare, spare, coordinates

    def keys(self, shingles: np.ndarray, k: int) -> np.ndarray | None:
        """One key for each group's contents; none where only equal sets are similar.

        At most ``differing`` groups of two similar sets differ, so ``spare`` + 1 agree. Empty groups are left out,
        unless a set has more than ``spare`` of them: of two such sets both keep theirs.
        """
        groups, spare, _ = self.layout(k)
        if groups == 1:
            return None
        salt = np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        spread = mixed(shingles ^ salt)
        group = spread % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        sorted_ = group[order]
        first = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        contents = np.add.reduceat(mixed(spread[order]), first)
        keys = mixed(contents ^ mixed(sorted_[first] + salt))
        if groups - len(first) > spare:
            empty = np.setdiff1d(np.arange(groups, dtype=np.uint64), sorted_[first], assume_unique=True)
            keys = np.concatenate([keys, mixed(mixed(empty + salt))])
        return keys

    def point(self, shingles: np.ndarray, k: int) -> np.ndarray:
        coordinates = self.layout(k)[2]
        return np.minimum(np.bincount((shingles % np.uint64(coordinates)).astype(np.int64), minlength=coordinates), MOST_COUNT).astype(np.uint8)


class CountTree:
    """An R-tree over count vectors; a node knows the largest coordinates and the sizes below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, cut: np.ndarray):
        self.points, self.sizes, self.cut = points.astype(np.int32), sizes, cut
        order = np.argsort(sizes, kind="stable")
        self.root = self._node(order)

    def _node(self, rows: np.ndarray):
        box = self.points[rows].max(axis=0)
        span = (self.sizes[rows].min(), self.sizes[rows].max(), self.cut[rows].max())
        if len(rows) <= LEAF:
            return rows, box, span, ()
        points = self.points[rows]
        axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
        rows = rows[np.argsort(points[:, axis], kind="stable")]
        half = len(rows) // 2
        return rows, box, span, (self._node(rows[:half]), self._node(rows[half:]))

    def search(self, point: np.ndarray, size: int, cut: int, rule: Threshold) -> np.ndarray:
        """Rows whose overlap with the point may reach the threshold.

        ``cut`` is what cutting coordinates off has taken from a point's sum: it is added to the bound.
        """
        point = point.astype(np.int32)
        found, open_ = [], [self.root]
        while open_:
            rows, box, (low, high, most_cut), below = open_.pop()
            if min(size, high) < rule.overlap(size, low) or np.minimum(point, box).sum() + min(cut, most_cut) < rule.overlap(size, low):
                continue
            if below:
                open_ += below
                continue
            bound = np.minimum(self.points[rows], point).sum(axis=1) + np.minimum(self.cut[rows], cut)
            found.append(rows[np.minimum(bound, np.minimum(self.sizes[rows], size)) >= rule.overlap(size, self.sizes[rows])])
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


class Groups:
    """Union by smallest index."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


_SETS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("set_id", pa.int64()), ("classes", pa.list_(pa.struct([
    ("class", pa.int32()), ("keys", pa.list_(pa.int64())), ("point", pa.binary())])))])
_SETS_DDL = "doc_id bigint, text_hash bigint, n bigint, set_id bigint, classes array<struct<class:int,keys:array<bigint>,point:binary>>"


def _set_id(shingles: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(shingles.tobytes()), dtype=np.uint64).astype(np.int64))


def sets_of(docs: DataFrame, rule: Threshold) -> DataFrame:
    """Per row: doc_id, text_hash, n (shingles), set_id (64-bit hash of the set; null if empty), and keys and points by size class.

    A task gives those of a set once (``KEPT_SETS`` of them are remembered), and no classes for its copies.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            given = set()
            for doc_id, text_hash, text in columns(batches, "doc_id", "text_hash", "text"):
                shingles = shingle_set(text, rule.size)
                if not len(shingles):
                    yield doc_id, text_hash, 0, None, []
                    continue
                classes, set_id = [], _set_id(shingles)
                for k in rule.classes(len(shingles)) if set_id not in given else ():
                    keys = rule.keys(shingles, k)
                    if keys is not None:
                        classes.append({"class": k, "keys": keys.view(np.int64), "point": rule.point(shingles, k).tobytes()})
                if len(given) >= KEPT_SETS:
                    given.clear()
                given.add(set_id)
                yield doc_id, text_hash, len(shingles), set_id, classes

        yield from batched(rows(), _SETS, most=512)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(made, _SETS_DDL)


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def candidate_edges(blocks: DataFrame, rule: Threshold) -> DataFrame:
    """Edges (a, b) that hold together, within each block (key, set_id, n, point), what the bound can't part."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges():
            held_key, ids, sizes, points, hub = None, [], [], [], None
            for key, set_id, n, point in columns(batches, "key", "set_id", "n", "point"):
                if key != held_key:
                    yield from closed(ids, sizes, points)
                    held_key, ids, sizes, points, hub = key, [], [], [], None
                if hub is not None:
                    if hub != set_id:
                        yield hub, set_id
                    continue
                if ids and ids[-1] == set_id:
                    continue  # from another task
                ids.append(set_id)
                sizes.append(n)
                points.append(point)
                if len(ids) > BLOCK_POINTS:
                    hub = ids[0]
                    yield from ((hub, x) for x in ids[1:])
                    ids, sizes, points = [], [], []
            yield from closed(ids, sizes, points)

        def closed(ids, sizes, points):
            if len(ids) < 2:
                return
            sizes = np.array(sizes)
            points = np.frombuffer(b"".join(points), np.uint8).reshape(len(ids), -1)
            cut = sizes - points.sum(axis=1, dtype=np.int64)
            if len(ids) == 2:
                bound = np.minimum(points[0], points[1]).sum(dtype=np.int64) + cut.min()
                if min(bound, *sizes) >= rule.overlap(int(sizes[0]), int(sizes[1])):
                    yield ids[0], ids[1]
                return
            tree, groups = CountTree(points, sizes, cut), Groups(len(ids))
            for k in range(len(ids)):
                for other in tree.search(points[k], int(sizes[k]), int(cut[k]), rule).tolist():
                    groups.join(k, other)
            yield from ((ids[groups.find(k)], ids[k]) for k in range(len(ids)) if groups.find(k) != k)

        yield from batched(edges(), _EDGE)

    sorted_ = blocks.repartition("key").sortWithinPartitions("key", "set_id")
    return sorted_.mapInArrow(bounded, "a bigint, b bigint").distinct()


def overlaps(a: list[np.ndarray], b: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Shared shingles of the pairs (a[rows], b[cols])."""
    if len(rows) <= 4 * (len(a) + len(b)):
        return np.array([len(np.intersect1d(a[r], b[c], assume_unique=True)) for r, c in zip(rows, cols, strict=True)], dtype=np.int64)
    # dense: count all pairs at once over the shingles that both sides hold
    left, right = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(left, right)
    left_row, right_row = (np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (a, b))
    at_l, at_r = np.searchsorted(shared, left), np.searchsorted(shared, right)
    in_l = shared[np.minimum(at_l, len(shared) - 1)] == left if len(shared) else np.zeros(len(left), bool)
    in_r = shared[np.minimum(at_r, len(shared) - 1)] == right if len(shared) else np.zeros(len(right), bool)
    order_l, order_r = np.argsort(at_l[in_l], kind="stable"), np.argsort(at_r[in_r], kind="stable")
    col_l, row_l = at_l[in_l][order_l], left_row[in_l][order_l]
    col_r, row_r = at_r[in_r][order_r], right_row[in_r][order_r]
    total = np.zeros((len(a), len(b)), dtype=np.float32)
    for start in range(0, len(shared), 2048):
        x, y = np.zeros((len(a), 2048), np.float32), np.zeros((len(b), 2048), np.float32)
        for m, col, row in ((x, col_l, row_l), (y, col_r, row_r)):
            part = slice(*np.searchsorted(col, [start, start + 2048]))
            m[row[part], col[part] - start] = 1
        total += x @ y.T
    return np.rint(total[rows, cols]).astype(np.int64)


_FOUND = pa.schema([("set_id", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _compare(a: list, b: list | None, rule: Threshold) -> Iterator[tuple[int, int, int]]:
    """(set_id, root, links) for the sets of two tiles (set_id, copies, shingles), or of one, that are similar to any."""
    same = b is None
    b = a if same else b
    both = a if same else a + b
    k = rule.classes(max(len(s) for _, _, s in both)).stop - 1
    points_a = np.array([rule.point(s, k) for _, _, s in a])
    points_b = points_a if same else np.array([rule.point(s, k) for _, _, s in b])
    sizes_a, sizes_b = np.array([len(s) for _, _, s in a]), np.array([len(s) for _, _, s in b])
    cut_a, cut_b = sizes_a - points_a.sum(axis=1, dtype=np.int64), sizes_b - points_b.sum(axis=1, dtype=np.int64)
    tree = CountTree(points_b, sizes_b, cut_b)
    rows, cols = [], []
    for r in range(len(a)):
        hit = tree.search(points_a[r], int(sizes_a[r]), int(cut_a[r]), rule)
        hit = hit[hit > r] if same else hit
        rows.append(np.full(len(hit), r))
        cols.append(hit)
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    if not len(rows):
        return
    shared = overlaps([s for _, _, s in a], [s for _, _, s in b], rows, cols)
    hit = rule.den * shared >= rule.num * (sizes_a[rows] + sizes_b[cols] - shared)
    rows, cols = rows[hit], cols[hit] + (0 if same else len(a))
    copies = np.array([c for _, c, _ in both])
    links = np.bincount(rows, copies[cols], len(both)) + np.bincount(cols, copies[rows], len(both))
    groups = Groups(len(both))
    for r, c in zip(rows.tolist(), cols.tolist(), strict=True):
        groups.join(r, c)
    for x in np.flatnonzero(links).tolist():
        yield both[x][0], both[groups.find(x)][0], int(links[x])


def verified(tiled: DataFrame, rule: Threshold) -> DataFrame:
    """(set_id, root, links) of the tile pairs (part, one, two) over rows (part, one, two, tile, set_id, copies, text).

    Only the first of two tiles is compared with the second; a pair (t, t) is a tile with itself.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            held, a, b = None, [], []
            for part, one, two, tile, set_id, copies, text in columns(batches, "part", "one", "two", "tile", "set_id", "copies", "text"):
                if (part, one, two) != held:
                    if a and (b or held[1] == held[2]):
                        yield from _compare(a, b if held[1] != held[2] else None, rule)
                    held, a, b = (part, one, two), [], []
                shingles = shingle_set(text, rule.size)
                side = a if tile == one else b
                # a doc_id that is repeated may bring another text, or the same again
                if _set_id(shingles) == set_id and not (side and side[-1][0] == set_id):
                    side.append((set_id, copies, shingles))
            if a and (b or held[1] == held[2]):
                yield from _compare(a, b if held[1] != held[2] else None, rule)

        yield from batched(found(), _FOUND)

    sorted_ = tiled.repartition("part", "one", "two").sortWithinPartitions("part", "one", "two", "tile", "set_id")
    return sorted_.mapInArrow(compared, "set_id bigint, root bigint, links bigint")


def similar_groups(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, n_links, and text_hash and
    root, which tell rows of one doc_id and components of one name apart.

    Two documents link when den * intersection >= num * union of their shingles of ``size`` words. ``component_id`` is
    the smallest doc_id that links reach, ``n_links`` the number of documents linked directly, equal ones included.
    Null and empty texts, and those without words, have no shingles and link with nothing. A row without doc_id links
    like any other; the component_id is null where no row of the component has a doc_id. Rows that repeat a doc_id are
    documents of their own that share a name. An empty table gives no row; other columns aren't read.

    Sets count as equal by a 64-bit hash of their shingle hashes.
    """
    rule = Threshold(num, den, size)
    sets = materialize(sets_of(docs, rule), "sets")
    distinct = materialize(sets.filter("set_id is not null").groupBy("set_id").agg(
        F.first("n").alias("n"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("holder")), "distinct-sets")
    by_class = sets.filter("set_id is not null").select("set_id", "n", F.explode("classes").alias("c")).select("set_id", "n", "c.class", "c.keys", "c.point")
    keys = by_class.select("set_id", "class", F.explode("keys").alias("key"))
    # a key of one set only is no block
    in_key = Window.partitionBy("key")
    met = keys.withColumn("low", F.min("set_id").over(in_key)).withColumn("high", F.max("set_id").over(in_key))
    met = met.filter("low < high").select("key", "set_id", "class")
    points = by_class.groupBy("set_id", "class").agg(F.first("n").alias("n"), F.first("point").alias("point"))
    blocks = met.join(points, ["set_id", "class"]).select("key", "set_id", "n", "point")
    parts = components(candidate_edges(blocks, rule)).select(F.col("node").alias("set_id"), F.col("root").alias("part"))

    # tiles of bounded work, by size of set: similar sets have similar sizes
    in_part = Window.partitionBy("part").orderBy("n", "set_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = parts.join(distinct.select("set_id", "n", "copies", F.col("holder.doc_id").alias("holder"), F.col("holder.text_hash").alias("holder_hash")), "set_id")
    work = F.greatest(F.sum("n").over(in_part) / TILE_SHINGLES, F.row_number().over(in_part) / TILE_SETS)
    placed = materialize(placed.withColumn("tile", F.floor(work).cast("int")), "tiles")
    tiles = placed.groupBy("part", "tile").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    one = tiles.select("part", F.col("tile").alias("one"), F.col("high").alias("high_one"))
    two = tiles.select("part", F.col("tile").alias("two"), F.col("low").alias("low_two"))
    pairs = one.join(two, "part").filter((F.col("one") <= F.col("two")) & (F.lit(den) * F.col("high_one") >= F.lit(num) * F.col("low_two")))
    sides = pairs.select("part", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("tile"))
    texts = docs.select(F.col("doc_id").alias("text_id"), F.xxhash64("text").alias("text_hash"), "text")
    # of rows without a name, those of equal text are one
    texts = texts.filter("text_id is not null").unionByName(texts.filter("text_id is null").dropDuplicates(["text_hash"]))
    # merged at any size: what is compared grows with the input, so its side is never sent to all tasks
    with_text = placed.join(texts.hint("merge"), F.expr("holder <=> text_id and holder_hash = text_hash"))
    found = materialize(verified(with_text.join(sides, ["part", "tile"]), rule), "links")

    roots = components(found.select(F.col("set_id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "set_id")
    links = found.groupBy("set_id").agg(F.sum("links").alias("links"))
    groups = sets.select("doc_id", "text_hash", "n", "set_id").join(roots, "set_id", "left")
    groups = groups.select("doc_id", "text_hash", "n", "set_id", F.coalesce("root", "set_id").alias("root"))
    names = groups.filter("set_id is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    counts = sets.filter("set_id is not null").groupBy("set_id").agg((F.count("*") - 1).alias("equal"))
    counts = counts.join(links, "set_id", "left").select("set_id", (F.col("equal") + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = groups.join(names, "root", "left").join(counts, "set_id", "left")
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "text_hash", "root")


def one_of_each(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, one of each component of :func:`similar_groups`: the smallest doc_id, then text hash.

    Rows without shingles all stay; a null doc_id stays only where no row of its component has one.
    """
    found = materialize(similar_groups(docs, size, num, den), "similar")
    bare = found.filter("root is null").select("doc_id", "text_hash").distinct()
    rows = found.filter("root is not null").groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "copies")
    first = materialize(rows.groupBy("root").agg(F.min(order).alias("first")).select("first.*"), "firsts")
    once = first.filter("copies = 1").select("doc_id", "text_hash").unionByName(bare)
    repeated = first.filter("copies > 1").select("doc_id", "text_hash")
    kept = _rows_of(docs, once)
    if not repeated.isEmpty():  # rows that are equal in doc_id and text: any one of them
        kept = kept.unionByName(_rows_of(docs, repeated).dropDuplicates(["by_id", "by_hash"]))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _rows_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` as struct ``row``, with by_id and by_hash, that ``wanted`` (doc_id, text_hash) names."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("by_id"), F.xxhash64("text").alias("by_hash"))
    wanted = wanted.select(F.col("doc_id").alias("stay_id"), F.col("text_hash").alias("stay_hash"))
    return rows.join(wanted, F.expr("by_id <=> stay_id and by_hash = stay_hash"), "left_semi")
