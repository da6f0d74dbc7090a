"""N-gram Jaccard self-join: all links of a corpus, reported as one component per document.

Documents become sets of hashed word shingles.  Equal sets are one node.  Two sets of sizes a <= b link when
``den * |A & B| >= num * |A | B|``, so they differ in at most ``D(b) = 2 b (den - num) // (den + num)`` shingles.

*Tiles.*  A size band fixes a number of cells K > D(b); the hash space is cut into K cells and a tile is
(band, cell, exact content of the cell).  Two linked sets differ in at most D cells, so they agree on at least one
whole cell and meet in a tile of the band of the larger one: candidates are complete, and unrelated documents
that share a common passage do not meet unless a whole cell agrees.

*Rounds.*  Each takes the tiles whose members are not yet in one component and compares members of different components
by hashed bitmap signatures, whose bit counts bound the overlap from above, in blocks of bounded size.  A tile gives the
pairs that may link, or if these are many a spanning forest of them, so again a number linear in its members; exact
intersections of sorted arrays confirm or refute them.  Refuted pairs are kept aside and the tiles that gave a forest
come again, until every tile has given all its pairs: no link between components is lost, and pairs inside a component
are never formed.

Defined results: a text without words (or null) has an empty set and no links; fewer words than the shingle width
make one shingle; null ids and repeated rows are documents like others (an id is only reported, a component's id is
its least non-null id, null if it has none); other columns are ignored; an empty table gives an empty result.
Set identity and shingle identity are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .common import checkpointed, fresh, ship, small

_U = np.uint64
SPARE = 2  #: cells beyond D + 1, so that a few empty cells do no harm
BLOCK = 512  #: members of a tile that are compared with as many others at a time
DENSE = 2  #: pairs a member up to which a tile gives all its pairs that may link, else a forest of them


def _ladder(most: int = 1 << 40) -> np.ndarray:
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, int(out[-1] * 1.35)))
    return np.array(out, dtype=np.int64)


LADDER = _ladder()


def differing(size: np.ndarray, num: int, den: int) -> np.ndarray:
    """The most shingles in which a set of ``size`` can differ from a linked set that is not larger."""
    return 2 * size * (den - num) // (den + num)


def band(size: np.ndarray, num: int, den: int) -> np.ndarray:
    d = differing(size, num, den)
    return np.where(d == 0, 0, np.searchsorted(LADDER, d + 1 + SPARE))


def sets_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows one after another, range of each row)."""
    w = tk.words(column)
    h, ptr = tk.window_hashes(w.hashes(), w.rows, width)
    parts = [np.unique(h[a:b]) for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
    return np.concatenate([np.empty(0, dtype=_U), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])


def set_ids(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.concatenate([[_U(0)], np.cumsum(tk.mix(h + _U(0x51ED270B)), dtype=np.uint64)])
        return tk.mix(total[ptr[1:]] - total[ptr[:-1]] + np.diff(ptr).astype(np.uint64) * _U(0x9E3779B97F4A7C15)).view(np.int64)


def cell_keys(h: np.ndarray, n: int, num: int, den: int) -> list[np.ndarray]:
    """The tile keys of one set of ``n`` sorted hashes."""
    out = []
    lo, hi = band(np.array([n, n * den // num]), num, den)
    for level in range(int(lo), int(hi) + 1):
        k = int(LADDER[level]) if level else 1
        cell = ((h >> _U(32)) * _U(k)) >> _U(32)
        first = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1])
        with np.errstate(over="ignore"):
            content = np.add.reduceat(tk.mix(h), first)
            seed = _U(level * 0x9E3779B97F4A7C15 + 7 & (1 << 64) - 1)
            out.append(tk.mix(tk.mix(content) + tk.mix(cell[first] + seed)))
            if k > 1 and len(first) <= min(differing(n * den // num, num, den), k - 1 - SPARE):
                empty = np.setdiff1d(np.arange(k, dtype=np.uint64), cell[first])
                out.append(tk.mix(tk.mix(empty + seed) + _U(0xE)))
    return out


def bitmap(h: np.ndarray, per_item: float = 0.75) -> bytes:
    """A hashed signature of ``per_item`` bits an item or more, its length a power of two, so that a longer one folds onto a shorter one."""
    size = 1 << max(10, int(np.ceil(np.log2(max(len(h) * per_item, 1)))))
    bits = np.zeros(size, dtype=np.uint8)
    bits[(tk.mix(h + _U(0xB17)) & _U(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def wide_bitmap(h: np.ndarray) -> bytes:
    return bitmap(h, 2.0)


def matrix(signatures: list[bytes]) -> np.ndarray:
    """The signatures as rows of one length, longer ones folded onto the shortest."""
    size = min(map(len, signatures))
    out = np.zeros((len(signatures), size), dtype=np.uint8)
    for row, signature in zip(out, signatures, strict=True):
        np.bitwise_or.reduce(np.frombuffer(signature, dtype=np.uint8).reshape(-1, size), axis=0, out=row)
    return out.view(np.uint64)


def wide_bound(n_a: int, n_b: int, a: bytes, b: bytes) -> int:
    """``overlap_bound`` from two signatures of any lengths."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    size = 8 * max(len(a), len(b))
    while size > 8 * min(len(a), len(b)):
        size //= 2
        low = (1 << size) - 1
        x, y = (x & low) | (x >> size), (y & low) | (y >> size)
    return min((n_a + n_b - (x ^ y).bit_count()) // 2, n_a, n_b)


def overlap_bound(sizes_a: np.ndarray, sizes_b: np.ndarray, bits_a: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """Upper bound of the intersections: each differing bit is a shingle of one side only."""
    differ = np.bitwise_count(bits_a ^ bits_b).sum(axis=-1, dtype=np.int64)
    return np.minimum((sizes_a + sizes_b - differ) // 2, np.minimum(sizes_a, sizes_b))


def with_sets(docs: DataFrame, width: int, set_col: str, size_col: str, drop_text: bool = False) -> DataFrame:
    """``docs`` plus the id and size of each row's set (id 0 stands for the empty set); only ``doc_id`` stays with ``drop_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch):
                h, ptr = sets_of(part.column(part.schema.get_field_index("text")), width)
                n = np.diff(ptr)
                added = [pa.array(np.where(n > 0, set_ids(h, ptr), 0)), pa.array(n)]
                kept = [0] if drop_text else range(part.num_columns)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *added], names=[*(part.schema.names[i] for i in kept), set_col, size_col])

    if drop_text:
        docs = docs.select("doc_id", "text")
    schema = docs.schema
    if drop_text:
        schema = docs.select("doc_id").schema
    return docs.mapInArrow(run, type(schema)(list(schema.fields)).add(set_col, "long").add(size_col, "long"))


def _tile_members(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(key, node) of all tiles; a task gives each set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in tk.slices(batch):
                h, ptr = sets_of(part.column(0), width)
                ids, keys, nodes = set_ids(h, ptr), [], []
                for i, node in enumerate(ids.tolist()):
                    if ptr[i + 1] > ptr[i] and node not in seen:
                        seen.add(node)
                        own = cell_keys(h[ptr[i] : ptr[i + 1]], int(ptr[i + 1] - ptr[i]), num, den)
                        keys += own
                        nodes.append(np.full(sum(map(len, own)), node, dtype=np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))], names=["key", "node"])

    return docs.select("text").mapInArrow(run, "key long, node long")


class _Sets:
    """Signatures of the sets that share a tile, and the items of those that a signature could not tell apart.

    Items are read from the texts again when a pair first needs them, so most sets' items are never moved.
    """

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, num: int, den: int):
        self.docs, self.width, self.num, self.den = docs, width, num, den
        self.signed = checkpointed(self._read(nodes, {"bits": bitmap, "wide": wide_bitmap}))
        self.items: DataFrame | None = None

    def _read(self, wanted: DataFrame, encode: dict[str, Callable[[np.ndarray], bytes]]) -> DataFrame:
        """(node, n, the encoded columns) of the wanted nodes."""
        width, names = self.width, list(encode)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                for part in tk.slices(batch):
                    h, ptr = sets_of(part.column(0), width)
                    ids = set_ids(h, ptr).tolist()
                    rows = []
                    for i, node in enumerate(ids):
                        if ptr[i + 1] > ptr[i] and node not in seen:
                            seen.add(node)
                            rows.append(i)
                    if rows:
                        own = [h[ptr[i] : ptr[i + 1]] for i in rows]
                        yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in rows], pa.int64()), pa.array([len(x) for x in own], pa.int64()), *(pa.array([f(x) for x in own], pa.binary()) for f in encode.values())], names=["node", "n", *names])

        found = self.docs.select("text").mapInArrow(run, "node long, n long, " + ", ".join(f"{c} binary" for c in names))
        return found.join(small(wanted), "node", "left_semi").groupBy("node").agg(*(F.first(c).alias(c) for c in ["n", *names]))

    def _itemised(self, pairs: DataFrame) -> DataFrame:
        nodes = pairs.select("a").union(pairs.select("b")).toDF("node").distinct()
        new = checkpointed(nodes if self.items is None else nodes.join(self.items, "node", "left_anti"), narrow=True)
        if self.items is None or new.limit(1).count():
            more = checkpointed(self._read(new, {"items": np.ndarray.tobytes}))
            self.items = more if self.items is None else self.items.union(more)
        return self.items

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link: by the bit counts of wide signatures, which tell long texts apart, then by their items."""
        num, den = self.num, self.den

        def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n_a, n_b, wide_a, wide_b = (batch.column(i).to_pylist() for i in range(2, 6))
                good = [i for i, (x, y) in enumerate(zip(n_a, n_b, strict=True)) if wide_bound(x, y, wide_a[i], wide_b[i]) >= -(-num * (x + y) // (num + den))]
                yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))
            tk.release()

        def do(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = []
                for i in range(batch.num_rows):
                    x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in (2, 3))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if den * both >= num * (len(x) + len(y) - both):
                        good.append(i)
                yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))
            tk.release()

        side = lambda df, x, *cols: df.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in cols))
        signed = pairs.join(side(self.signed, "a", "n", "wide"), "a").join(side(self.signed, "b", "n", "wide"), "b")
        likely = checkpointed(signed.select("a", "b", "n_a", "n_b", "wide_a", "wide_b").mapInArrow(may, "a long, b long"), narrow=True)
        if likely.limit(1).count() == 0:
            return likely
        items = self._itemised(likely)
        return likely.join(side(items, "a", "items"), "a").join(side(items, "b", "items"), "b").select("a", "b", "items_a", "items_b").mapInArrow(do, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of the nodes in ``links(a, b)``; comp is the least node reachable.

    Least labels spread along the links and jump to their label's label, so the rounds grow with the logarithm
    of a component's width.
    """
    both = checkpointed(links.union(links.select("b", "a")).toDF("a", "b").distinct(), narrow=True)
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), narrow=True)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        spread = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("comp", "m").alias("new"), F.col("comp").alias("old"))
        jump = spread.select(F.col("node").alias("new"), F.col("new").alias("further"))
        moved = checkpointed(spread.join(jump, "new").select("node", F.least("new", "further").alias("comp"), "old"), narrow=True)
        labels = moved.select("node", "comp")
        if moved.filter("comp <> old").limit(1).count() == 0:
            return labels


def _open_tiles(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, comp, size) of the tiles of ``members(key, node)`` whose members are in several components."""
    placed = members.join(labels, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    sizes = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key", "size")
    return checkpointed(placed.join(sizes, "key"), narrow=True)


def _candidates(tile: dict[str, np.ndarray], bits: np.ndarray, refuted: list[list[int] | None], num: int, den: int, dense: int) -> tuple[list[tuple[int, int]], bool]:
    """Pairs of one tile across components that may link, and whether these are all.

    ``own`` is i or j, the two blocks of the tile.  Up to ``dense`` pairs a member all are given; else a forest of
    them, likeliest first, that would join the components.
    """
    node, comp, n = tile["node"], tile["comp"], tile["n"]
    left, right = np.flatnonzero(tile["own"] == tile["i"]), np.flatnonzero(tile["own"] == tile["j"])
    root = np.unique(comp, return_inverse=True)[1]
    same = tile["i"][0] == tile["j"][0]
    near: list[tuple[int, np.ndarray, np.ndarray]] = []
    for x in left.tolist():
        ys = right[root[right] != root[x]]
        if same:
            ys = ys[node[ys] > node[x]]
        ys = ys[(n[ys] * den >= n[x] * num) & (n[x] * den >= n[ys] * num)]
        if refuted[x] and len(ys):
            ys = ys[~np.isin(node[ys], np.array(refuted[x], dtype=np.int64))]
        if len(ys):
            spare = overlap_bound(n[x], n[ys], bits[x], bits[ys]) - -(-num * (n[x] + n[ys]) // (num + den))
            if (spare >= 0).any():
                near.append((x, ys[spare >= 0], spare[spare >= 0]))
    whole = sum(len(ys) for _, ys, _ in near) <= dense * len(node)
    found = []
    for x, ys, spare in near:
        for y in ys[np.argsort(-spare, kind="stable")].tolist():
            if whole or root[y] != root[x]:
                found.append((int(min(node[x], node[y])), int(max(node[x], node[y]))))
                if not whole:
                    root[root == root[y]] = root[x]
    return found, whole


def _tile_pairs(tiles: DataFrame, signed: DataFrame, refuted: DataFrame | None, num: int, den: int, dense: int) -> DataFrame:
    """(key, a, b, whole): of each tile the pairs across components that may link, or a forest of them if they are many."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = tiles.join(signed.select("node", "n", "bits"), "node")
    if refuted is None:
        dealt = dealt.withColumn("refuted", F.lit(None).cast("array<long>"))
    else:
        both = refuted.union(refuted.select("b", "a")).toDF("node", "other").groupBy("node").agg(F.collect_list("other").alias("refuted"))
        dealt = dealt.join(both, "node", "left")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp", "n", "bits", "refuted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: pa.Table) -> Iterator[tuple[int, int, int, bool]]:
            cols = {c: rows.column(c).to_numpy() for c in ("key", "i", "j", "own", "node", "comp", "n")}
            bits = rows.column("bits").to_pylist()
            gone = rows.column("refuted").to_pylist()
            edge = (cols["key"][1:] != cols["key"][:-1]) | (cols["i"][1:] != cols["i"][:-1]) | (cols["j"][1:] != cols["j"][:-1])
            cuts = np.concatenate([[0], np.flatnonzero(edge) + 1, [rows.num_rows]])
            twos = cuts[:-1][np.diff(cuts) == 2]  # tiles of two members, all together
            twos = twos[cols["comp"][twos] != cols["comp"][twos + 1]]
            na, nb = cols["n"][twos], cols["n"][twos + 1]
            likely = twos[np.minimum(na, nb) * den >= np.maximum(na, nb) * num]
            for x in likely.tolist():
                a, b = int(cols["node"][x]), int(cols["node"][x + 1])
                n_a, n_b = int(cols["n"][x]), int(cols["n"][x + 1])
                if b not in (gone[x] or ()) and wide_bound(n_a, n_b, bits[x], bits[x + 1]) >= -(-num * (n_a + n_b) // (num + den)):
                    yield int(cols["key"][x]), min(a, b), max(a, b), True
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if hi - lo == 2:
                    continue
                pairs, whole = _candidates({c: v[lo:hi] for c, v in cols.items()}, matrix(bits[lo:hi]), gone[lo:hi], num, den, dense)
                for a, b in pairs:
                    yield int(cols["key"][lo]), a, b, whole

        def out(rows: pa.Table) -> pa.RecordBatch:
            found = list(solved(rows)) if rows.num_rows else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64() if k < 3 else pa.bool_()) for k in range(4)], names=["key", "a", "b", "whole"])

        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key, i, j = (rows.column(c).to_numpy() for c in ("key", "i", "j"))
            last = np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))
            start = int(last[-1]) + 1 if len(last) else 0
            yield out(rows.slice(0, start))
            held = rows.slice(start)
        if held is not None:
            yield out(held)
        tk.release()

    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "key long, a long, b long, whole boolean")


def node_components(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(node, comp) of all linked sets of ``docs(text)``."""
    members = _tile_members(docs, width, num, den)
    shared = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key")
    members = checkpointed(members.join(small(checkpointed(shared, narrow=True)), "key").distinct())
    sets = _Sets(docs, checkpointed(members.select("node").distinct(), narrow=True), width, num, den)
    empty = docs.sparkSession.createDataFrame([], "a long, b long")
    links, labels, refuted, dense = empty, empty.toDF("node", "comp"), None, DENSE
    while True:
        tiles = _open_tiles(members, labels)
        may = checkpointed(_tile_pairs(tiles, sets.signed, refuted, num, den, dense), narrow=True)
        asked = may.select("a", "b").distinct()
        good = checkpointed(sets.verified(asked), narrow=True)
        if good.limit(1).count():
            links = links.union(good)
            labels = components(links)
        again = may.filter("not whole").select("key").distinct()
        if again.limit(1).count() == 0:
            return labels
        wrong = asked.join(good, ["a", "b"], "left_anti")
        refuted = checkpointed(wrong if refuted is None else refuted.union(wrong), narrow=True)
        members = checkpointed(tiles.join(again, "key", "left_semi").select("key", "node"), narrow=True)
        dense *= 8  # a tile whose forest was refuted gives more the next time, so rounds grow with the logarithm of its size


def linked(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies) for each row of ``docs(doc_id, text)``.

    n_copies counts the rows with the same set.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = checkpointed(with_sets(docs, width, "node", "n_shingles", drop_text=True))
    full = rows.filter("n_shingles > 0")
    nodes = full.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies"))
    comps = node_components(docs, width, num, den)
    placed = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = placed.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = placed.join(named, "comp").select("node", "component_id", "n_copies")
    out = full.join(found, "node").select("doc_id", "n_shingles", "component_id", "n_copies")
    none = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_copies"))
    return out.unionByName(none)


def one_of_each(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the least id, nulls last, then the least set.

    Rows without words all stay.  All columns of ``docs`` are returned unchanged; of a row repeated in full one stays.
    """
    ship(docs.sparkSession)
    node, size = fresh(docs, "set_id"), fresh(docs, "set_size")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = with_sets(plain, width, "node", "n", drop_text=True).filter("n > 0")
    per_set = checkpointed(rows.groupBy("node").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies")))
    comps = node_components(plain, width, num, den)
    placed = per_set.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    order = F.struct(F.col("doc").isNull(), "doc", "node")
    best = placed.groupBy("comp").agg(F.min(order).alias("best"), F.sum("copies").alias("copies")).filter("copies > 1")
    grouped = checkpointed(placed.select("comp", "node").join(best, "comp").select(F.col("node").alias(node), F.col("best.doc").alias("keep_doc"), (F.col("best.node") == F.col("node")).alias("keep_set")))
    kept_doc, kept_set = fresh(docs, "keep_doc"), fresh(docs, "keep_set")
    grouped = grouped.select(node, F.col("keep_doc").alias(kept_doc), F.col("keep_set").alias(kept_set))
    marked = with_sets(docs.withColumn("text", F.col("text").cast("string")), width, node, size).join(small(grouped), node, "left")
    alone = marked.filter(F.col(kept_set).isNull()).select(docs.columns)
    chosen = marked.filter(F.col(kept_set) & F.col("doc_id").cast("long").eqNullSafe(F.col(kept_doc)))
    return alone.unionByName(chosen.dropDuplicates([node]).select(docs.columns))
