"""N-gram Jaccard join: count-vector R-trees inside cells of rare shingles.

A document is its set of distinct five-word shingles. Equal sets are one class, named by a hash of
the set, so copies cost nothing after the first look. Shingles are hashed into groups; the counts
per group are a point, and the sum of coordinate minima of two points bounds the overlap of their
sets from above. Bounding boxes of points bound whole subtrees, which is what the R-tree prunes by.

The tree needs an outer partitioning that scales: two sets with a Jaccard of t share one of their
(1-t)n+1 first shingles in any common order. The order here is by how often a shingle's group
occurs, rarest first, so frequent passages make no cells. A cell is one such shingle with the
classes that hold it. Work in the cells goes in two steps, so that a group of near copies never
costs its square:

1. every class is compared with one of its cell only, the one that shares most of its prefix (the
   source of a group of edited copies); links found are contracted;
2. cells that still hold several components are searched by an R-tree over their points, boxes of
   one component being skipped against themselves. Large cells are dealt out in pairs of blocks.
   Two near copies meet in most of their cells: a row brings the BEFORE cells its class has in
   front of this one, and a pair that has one of them in common was found there. A pair then has
   to meet in as many cells as its sizes ask for, counted once on the cells of both.

In both steps pairs that survive the bounds are verified on their whole sets. Components need no
more links than that. With them, every pair of classes inside a component is compared on the whole
sets, in pairs of blocks, and each document gets the number of its links: its copies and the
members of all linked classes. The pairs are counted where they are found and not written.

Null or empty text, or one without words: an empty set, linked with nothing. A null id cannot
name a component: such rows get the least id of the others, or null. Repeated rows: a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rigpulse.llm.common import release, saved, sliced, text_slices
from rigpulse.llm.components import components
from rigpulse.llm.words import mix, shingles

# Links: PERCENT * union <= 100 * intersection.
SIZE, PERCENT = 5, 75
# Groups of the points, and groups whose frequencies order the shingles.
GROUPS, FREQUENCY_GROUPS = 64, 1 << 16
# Shingles of a block of a component, about; columns of a block of the counting matrix.
BLOCK_SHINGLES, COLUMNS = 1 << 21, 4096
# Points of an R-tree leaf, children of a node; classes of a block of a large cell.
LEAF, FAN_OUT, BLOCK = 16, 8, 1024
# Earlier cells of its class that a row brings into the search.
BEFORE = 8

PROFILE = "kind int, doc_id long, key long, n long, point binary"


def linked(common: np.ndarray, a, b, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of a and b shingles with so many in common link."""
    return 100 * common >= percent * (a + b - common)


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles of which any partner holds at least one, in a common order."""
    return n - -(-percent * n // 100) + 1


def points(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """(texts, GROUPS) counts of shingles per group."""
    group = (hashes >> np.uint64(58)).astype(np.int64)
    return np.bincount(text * GROUPS + group, minlength=n_texts * GROUPS).reshape(-1, GROUPS).astype(
        "<u4"
    )


def set_keys(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """A 64-bit hash of each text's whole set."""
    total = np.zeros(n_texts, np.uint64)
    np.add.at(total, text, mix(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)))
    count = np.bincount(text, minlength=n_texts).astype(np.uint64)
    return mix(total + count * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def frequency_group(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(32)) & np.uint64(FREQUENCY_GROUPS - 1)).astype(np.int64)


def profiles(docs: DataFrame) -> DataFrame:
    """kind 0: a row per document (set key, size, point); kind 1: counts of the frequency groups.

    Each task adds its group counts at its end: FREQUENCY_GROUPS rows at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(FREQUENCY_GROUPS, np.int64)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            n = part.num_rows
            h, t = shingles(part.column("text"), SIZE)
            counts[:] += np.bincount(frequency_group(h), minlength=FREQUENCY_GROUPS)
            p = points(h, t, n)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), part.column("doc_id"), pa.array(set_keys(h, t, n)),
                 pa.array(np.bincount(t, minlength=n)), pa.array([x.tobytes() for x in p], pa.binary())],
                ["kind", "doc_id", "key", "n", "point"],
            )

        yield from sliced(work)(batches)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(at), np.int32)), pa.nulls(len(at), pa.int64()), pa.array(at),
             pa.array(counts[at]), pa.nulls(len(at), pa.binary())],
            ["kind", "doc_id", "key", "n", "point"],
        )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PROFILE)


def frequencies(made: DataFrame) -> np.ndarray:
    """Occurrences per frequency group; at most FREQUENCY_GROUPS rows reach the driver."""
    rows = made.where(F.col("kind") == 1).groupBy("key").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FREQUENCY_GROUPS, np.int64)
    for r in rows:
        out[r["key"]] = r["n"]
    return out


def cells(docs: DataFrame, frequency: np.ndarray) -> DataFrame:
    """(cell, key): every class under the shingles of its prefix, rarest groups first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies enter once for a task: at most a key for each of its rows

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            n = part.num_rows
            h, t = shingles(part.column("text"), SIZE)
            keys = set_keys(h, t, n)
            once = np.zeros(n, bool)
            for i in np.unique(keys, return_index=True)[1]:
                once[i] = (key := int(keys[i])) not in seen
                seen.add(key)
            h, t = h[once[t]], t[once[t]]
            order = np.lexsort((h, frequency[frequency_group(h)], t))
            h, t = h[order], t[order]
            count = np.bincount(t, minlength=n)
            place = np.arange(len(t)) - (np.cumsum(count) - count)[t]
            chosen = place < prefix_length(count)[t]
            return pa.RecordBatch.from_arrays(
                [pa.array(h[chosen].view(np.int64)), pa.array(keys[t[chosen]])], ["cell", "key"]
            )

        yield from sliced(work)(batches)

    return docs.select("text").mapInArrow(run, "cell long, key long")


def bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of coordinate minima of points (or of upper corners of boxes)."""
    return np.minimum(a, b).sum(axis=-1, dtype=np.int64)


class Tree:
    """An R-tree of points, packed bottom up from points sorted by component, size and coordinates.

    A node keeps the upper corner of its box, the least size below it and the one component below
    it, or -1. Equal levels are arrays, so that a step compares all children at once.
    """

    def __init__(self, p: np.ndarray, label: np.ndarray):
        size = p.sum(axis=1, dtype=np.int64)
        self.order = np.lexsort((p[:, 0], size, label))
        p, size, label = p[self.order], size[self.order], label[self.order]
        self.levels = [(p, size, size, label, label)]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            top, low, high, first, last = self.levels[-1]
            at = np.arange(0, len(low), width)
            self.levels.append(
                (np.maximum.reduceat(top, at), np.minimum.reduceat(low, at),
                 np.maximum.reduceat(high, at), np.minimum.reduceat(first, at),
                 np.maximum.reduceat(last, at))
            )
            width = FAN_OUT

    def _width(self, level: int) -> int:
        return LEAF if level == 1 else FAN_OUT


def search(x: Tree, y: Tree, percent: int = PERCENT, step: int = 4096) -> Iterator[tuple]:
    """(i, j) arrays of pairs of different labels whose bound lets them link; trees of equal height.

    Node pairs are tested from the roots down, ``step`` at a time.
    """

    def passes(level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        tx, lx, hx, fx, gx = x.levels[min(level, len(x.levels) - 1)]
        ty, ly, hy, fy, gy = y.levels[min(level, len(y.levels) - 1)]
        differ = ~((fx[i] == gx[i]) & (fy[j] == gy[j]) & (fx[i] == fy[j]))
        sizes = (100 * hy[j] >= percent * lx[i]) & (100 * hx[i] >= percent * ly[j])
        ok = differ & sizes
        most = np.zeros(len(i), np.int64)
        most[ok] = bound(tx[i[ok]], ty[j[ok]])
        return ok & linked(most, lx[i], ly[j], percent)

    def children(tree: Tree, level: int, node: int) -> np.ndarray:
        if level >= len(tree.levels):
            return np.array([node])
        w = tree._width(level)
        return np.arange(node * w, min((node + 1) * w, len(tree.levels[level - 1][1])))

    top = max(len(x.levels), len(y.levels)) - 1
    stack = [(top, np.array([0]), np.array([0]))]
    while stack:
        level, i, j = stack.pop()
        if len(i) > step:
            stack += [(level, i[k : k + step], j[k : k + step]) for k in range(0, len(i), step)]
            continue
        ok = passes(level, i, j)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if not level:
            yield x.order[i], y.order[j]
            continue
        met = [
            np.meshgrid(children(x, level, a), children(y, level, b), indexing="ij")
            for a, b in zip(i, j, strict=True)
        ]
        stack.append((level - 1, np.concatenate([m[0].ravel() for m in met]),
                      np.concatenate([m[1].ravel() for m in met])))


PAIR = "a long, b long"


def _leaf_pairs(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs inside runs of at most LEAF rows, each run a tree of one leaf."""
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m in range(2, LEAF + 1):
        a, b = np.triu_indices(m, 1)
        at = first[count == m][:, None]
        i.append((at + a).ravel())
        j.append((at + b).ravel())
    return np.concatenate(i), np.concatenate(j)


def _cell_pairs(key, label, side, x, y, cell, p) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Surviving pairs of whole (cell, x, y) tasks that lie one after another."""
    new = np.ones(len(cell), bool)
    new[1:] = (cell[1:] != cell[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(cell)))
    size = p.sum(axis=1, dtype=np.int64)
    small = (count <= LEAF) & (x[first] == y[first])
    i, j = _leaf_pairs(first[small], count[small])
    ok = (label[i] != label[j]) & (100 * np.minimum(size[i], size[j]) >= PERCENT * np.maximum(size[i], size[j]))
    i, j = i[ok], j[ok]
    for at in range(0, len(i), 1 << 15):
        a, b = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
        near = linked(bound(p[a], p[b]), size[a], size[b])
        yield a[near], b[near]
    for at, n in zip(first[~small], count[~small], strict=True):
        rows = np.arange(at, at + n)
        same = x[at] == y[at]
        ia, ib = rows[side[rows] == 0], rows[side[rows] == 1]
        if not len(ia) or not (same or len(ib)):
            continue
        tx = Tree(p[ia], label[ia])
        ty = tx if same else Tree(p[ib], label[ib])
        for a, b in search(tx, ty):
            a, b = ia[a], (ia if same else ib)[b]
            # A tree against itself meets every pair twice.
            yield (a[a < b], b[a < b]) if same else (a, b)


def _padded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, BEFORE) values, short lists filled with their last one, and which lists have any."""
    n = lists.value_lengths().to_numpy()
    has = n > 0
    at = lists.offsets.to_numpy()[:-1, None] + np.minimum(np.arange(BEFORE), n[:, None] - 1)
    out = np.zeros((len(n), BEFORE), np.int64)
    out[has] = lists.values.to_numpy()[at[has]]
    return out, has


def _met_before(before: np.ndarray, has: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j have a cell in front of this one in common."""
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 15):
        a, b = i[at : at + (1 << 15)], j[at : at + (1 << 15)]
        same = (before[a][:, :, None] == before[b][:, None, :]).any(axis=(1, 2))
        out[at : at + (1 << 15)] = same & has[a] & has[b]
    return out


def _searched(rows: DataFrame) -> DataFrame:
    """(a, b, na, nb): distinct surviving pairs of different components."""
    names = ("key", "label", "side", "x", "y")

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = [table[n].to_numpy() for n in names]
        key = columns[0]
        p = np.frombuffer(b"".join(table["point"].to_pylist()), "<u4").reshape(-1, GROUPS)
        before, has = _padded(pa.concat_arrays(table["before"].chunks))
        size = p.sum(axis=1, dtype=np.int64)
        for i, j in _cell_pairs(*columns, table["cell"].to_numpy(), p):
            new = ~_met_before(before, has, i, j)
            i, j = i[new], j[new]
            if len(i):
                swap = key[i] > key[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (key[i], key[j], size[i], size[j])], ["a", "b", "na", "nb"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch["cell"].to_numpy()
            last = int(np.searchsorted(cell, cell[-1], "left"))
            # All but the last cell is complete; that one may go on in the next batch.
            if last:
                yield from work(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from work(pa.Table.from_batches(held))

    tasks = rows.repartition("cell", "x", "y").sortWithinPartitions("cell", "x", "y")
    found = tasks.select("cell", *names, "point", "before").mapInArrow(run, f"{PAIR}, na long, nb long")
    return found.distinct()


def _before(rows: DataFrame) -> DataFrame:
    """Rows (cell, key, ...) with the BEFORE cells that come before theirs in the class, by number."""
    by = Window.partitionBy("key").orderBy("cell")
    return rows.withColumn("before", F.collect_list("cell").over(by.rowsBetween(-BEFORE, -1)))


def _enough_met(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs that meet in enough cells to be able to link; rows: (cell, key) of the search.

    Of two sets, take the one whose prefix ends first in the common order: what they share lies in
    cells of both, or behind that prefix. So the overlap is at most the cells met plus the longer
    of the two rests.
    """
    # A class has at most as many cells as its prefix has shingles.
    own = rows.groupBy("key").agg(F.collect_list("cell").alias("cells"))
    side = lambda c: own.select(F.col("key").alias(c), F.col("cells").alias(f"c{c}"))
    met = F.size(F.array_intersect("ca", "cb"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", met.alias("met"))
    rest = lambda n: F.ceil(F.col(n) * PERCENT / 100) - 1
    most = F.col("met") + F.greatest(rest("na"), rest("nb"))
    enough = 100 * most >= PERCENT * (F.col("na") + F.col("nb") - most)
    return pairs.where(enough).select("a", "b")


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose points let them link; classes: key, n, point."""
    side = lambda c: classes.select(
        F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("point").alias(f"p{c}")
    )
    near = (100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").where(near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                pa_, pb_ = (
                    np.frombuffer(b"".join(part[c].to_pylist()), "<u4").reshape(-1, GROUPS)
                    for c in ("pa", "pb")
                )
                na, nb = part["na"].to_numpy(), part["nb"].to_numpy()
                ok = pa.array(linked(bound(pa_, pb_), na, nb))
                yield pa.RecordBatch.from_arrays(
                    [part["a"].filter(ok), part["b"].filter(ok)], ["a", "b"]
                )

    return met.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, PAIR)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that link; texts: key, ztext (compressed whole text of one member)."""
    side = lambda c: texts.select(F.col("key").alias(c), F.col("ztext").alias(f"z{c}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdDecompressor()
        zs = part["za"].to_pylist() + part["zb"].to_pylist()
        place = {z: i for i, z in enumerate(dict.fromkeys(zs))}
        h, t = shingles(pa.array([squeeze.decompress(z).decode() for z in place], pa.string()), SIZE)
        sets = np.split(h, np.searchsorted(t, np.arange(1, len(place))))
        ok = []
        n = part.num_rows
        for i in range(n):
            a, b = sets[place[zs[i]]], sets[place[zs[n + i]]]
            common = len(np.intersect1d(a, b, assume_unique=True))
            ok.append(bool(linked(np.int64(common), len(a), len(b))))
        keep = pa.array(ok, pa.bool_())
        return pa.RecordBatch.from_arrays([part["a"].filter(keep), part["b"].filter(keep)], ["a", "b"])

    # Slices by the compressed texts, which are a third of the texts or less.
    return met.select("a", "b", "za", "zb").mapInArrow(sliced(work, "za"), PAIR)


def _member_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(key, ztext) of one document of each class; members: key, member."""

    def squeezed(part: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True)
        z = [squeeze.compress((t or "").encode()) for t in part["text"].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part["doc_id"], pa.array(z, pa.binary())], ["doc_id", "ztext"]
        )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        # Rows that share an id may differ in text: only the one whose set is meant counts.
        squeeze = zstandard.ZstdDecompressor()
        texts = [squeeze.decompress(z).decode() for z in part["ztext"].to_pylist()]
        h, t = shingles(pa.array(texts, pa.string()), SIZE)
        meant = pa.array(set_keys(h, t, part.num_rows) == part["key"].to_numpy())
        return pa.RecordBatch.from_arrays(
            [part["key"].filter(meant), part["ztext"].filter(meant)], ["key", "ztext"]
        )

    # Compressed before the join, which has to shuffle every text.
    small = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sliced(squeezed), "doc_id long, ztext binary"
    )
    met = small.join(members, F.col("doc_id").eqNullSafe(F.col("member")))
    return met.select("key", "ztext").mapInArrow(
        sliced(work, "ztext"), "key long, ztext binary"
    )


def _labels(members: DataFrame, found: DataFrame) -> DataFrame:
    """cell rows with the component of each class so far."""
    own = found.select(F.col("node").alias("key"), F.col("component").alias("_c"))
    return members.join(own, "key", "left").withColumn("label", F.coalesce("_c", "key")).drop("_c")


def _tasks(rows: DataFrame) -> DataFrame:
    """Deal the rows of each cell to tasks (cell, x, y): blocks of about BLOCK with each other."""
    size = rows.groupBy("cell").agg(F.count("*").alias("_n"))
    dealt = rows.join(size, "cell").withColumns(
        {"_blocks": F.ceil(F.col("_n") / BLOCK).cast("int")}
    ).withColumn("_block", F.pmod(F.xxhash64("key"), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return dealt.select("*", other).select(
        "cell", F.least("_block", "_other").alias("x"), F.greatest("_block", "_other").alias("y"),
        (F.col("_block") > F.col("_other")).cast("int").alias("side"), "key", "label", "point",
        "before",
    )


def _common(h: np.ndarray, t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(len(a), len(b)) numbers of common shingles of texts a and b; h, t: distinct shingles."""
    _, column, count = np.unique(h, return_inverse=True, return_counts=True)
    kept = count > 1
    column = np.where(kept, np.cumsum(kept) - 1, -1)[column]
    order = np.argsort(column, kind="stable")
    order = order[np.searchsorted(column[order], 0):]
    column, text = column[order], t[order]
    out = np.zeros((len(a), len(b)), np.int64)
    n = int(max(a.max(), b.max())) + 1
    for at in range(0, int(kept.sum()), COLUMNS):
        i, j = np.searchsorted(column, (at, at + COLUMNS))
        held = np.zeros((n, COLUMNS), np.float32)
        held[text[i:j], column[i:j] - at] = 1
        out += (held[a] @ held[b].T).astype(np.int64)
    return out


def _dealt(rows: DataFrame) -> DataFrame:
    """Deal the classes of each component (key, component, n, copies) to tasks (component, x, y)."""
    size = rows.groupBy("component").agg(F.count("*").alias("_m"), F.sum("n").alias("_s"))
    blocks = F.ceil(F.greatest(F.col("_m") / BLOCK, F.col("_s") / BLOCK_SHINGLES)).cast("int")
    dealt = rows.join(size, "component").withColumn("_blocks", blocks).withColumn(
        "_block", F.pmod(F.xxhash64("key"), F.col("_blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return dealt.select("*", other).select(
        "component", F.least("_block", "_other").alias("x"), F.greatest("_block", "_other").alias("y"),
        (F.col("_block") > F.col("_other")).cast("int").alias("side"), "key", "n", "copies",
    )


def link_counts(found: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, others): documents of other classes that each class links with.

    found: node, component; classes: key, n, copies; texts: key, ztext. All links lie inside a
    component, and each pair of classes meets in one task.
    """
    rows = classes.join(found.select(F.col("node").alias("key"), "component"), "key")

    def work(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        side, n, copies = (table[c].to_numpy() for c in ("side", "n", "copies"))
        same = table["x"][0].as_py() == table["y"][0].as_py()
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
        others = np.zeros(len(n), np.int64)
        if len(a) and len(b) and (not same or len(a) > 1):
            squeeze, hs, ts, at = zstandard.ZstdDecompressor(), [], [], 0
            for part in table.select(["ztext"]).combine_chunks().to_batches():
                for piece in text_slices(part, "ztext"):
                    texts = [squeeze.decompress(z).decode() for z in piece["ztext"].to_pylist()]
                    h, t = shingles(pa.array(texts, pa.string()), SIZE)
                    hs.append(h)
                    ts.append(t + at)
                    at += piece.num_rows
            ok = linked(_common(np.concatenate(hs), np.concatenate(ts), a, b), n[a][:, None], n[b][None])
            if same:
                np.fill_diagonal(ok, False)
            others[a] += ok @ copies[b]
            if not same:
                others[b] += copies[a] @ ok
        return table["key"].to_numpy(), others

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch[c].to_numpy() for c in ("component", "x", "y")]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            out = []
            for i, j in zip(starts, starts[1:]):
                task = tuple(int(c[i]) for c in columns)
                if held and task != now:
                    out.append(work(pa.Table.from_batches(held)))
                    held = []
                now = task
                held.append(batch.slice(i, j - i))
            if out:
                yield counted(out)
        if held:
            yield counted([work(pa.Table.from_batches(held))])

    def counted(out: list) -> pa.RecordBatch:
        key, others = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(others)], ["key", "others"])

    # Small rows are dealt before they meet the texts, of which a repeated id leaves several.
    met = _dealt(rows).join(texts.dropDuplicates(["key"]), "key").repartition("component", "x", "y").sortWithinPartitions(
        "component", "x", "y"
    )
    each = met.select("component", "x", "y", "side", "key", "n", "copies", "ztext").mapInArrow(
        run, "key long, others long"
    )
    return each.groupBy("key").agg(F.sum("others").alias("others"))


def classified(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key (of the set) and component_key of every document."""
    return _classified(docs)[0]


def _classified(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of classified(), the components (node, component), and texts of the classes."""
    made = saved(profiles(docs), "profiles")
    rows = made.where(F.col("kind") == 0)
    classes = rows.where(F.col("n") > 0).groupBy("key").agg(
        F.max("n").alias("n"), F.max("point").alias("point"), F.min("doc_id").alias("member")
    )
    # One exchange by cell: cells of one class vanish.
    in_cell = Window.partitionBy("cell")
    shared = saved(
        cells(docs, frequencies(made))
        .withColumns({"_low": F.min("key").over(in_cell), "_high": F.max("key").over(in_cell)})
        .where(F.col("_low") != F.col("_high")).select("cell", "key").distinct(),
        "cells",
    )
    spark = docs.sparkSession
    release(spark)
    # How much of its prefix a class shares: the source of a group of edited copies shares most.
    weight = shared.groupBy("key").agg(F.count("*").alias("w"))
    classes = classes.join(weight, "key").withColumn(
        "w", F.floor(F.col("w") * 1000 / (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1))
    )
    classes = saved(classes, "classes")
    texts = saved(_member_texts(docs, classes.select("key", "member")), "texts")

    release(spark)
    # Step 1: each class against the one of its cell that shares most.
    pivots = (
        shared.join(classes.select("key", "w"), "key").groupBy("cell")
        .agg(F.max(F.struct("w", "key"))["key"].alias("pivot"))
    )
    stars = (
        shared.join(pivots, "cell").where(F.col("key") != F.col("pivot"))
        .select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).distinct()
    )
    # Pairs are written before they are verified, so that the shuffles that found them can go first.
    near = saved(_bounded(stars, classes), "pairs")
    release(spark)
    links = saved(_verified(near, texts), "links")
    release(spark)
    found = components(links)
    release(spark)

    # Step 2: cells that still hold more than one component.
    labelled = _labels(shared.select("cell", "key"), found)
    several = labelled.groupBy("cell").agg(
        F.min("label").alias("_least"), F.max("label").alias("_most"), F.count("*").alias("_m")
    ).where((F.col("_least") != F.col("_most")) & (F.col("_m") > 2)).select("cell")
    open_ = saved(labelled.join(several, "cell", "left_semi"), "open")
    release(spark)
    met = _searched(_tasks(_before(open_).join(classes.select("key", "point"), "key")))
    more = saved(_enough_met(met, open_), "pairs")
    release(spark)
    later = saved(_verified(more, texts), "links")
    found = components(links.unionAll(later))
    keyed = found.select(F.col("node").alias("key"), F.col("component").alias("component_key"))
    made = rows.select("doc_id", "n", "key").join(keyed, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "key",
        F.coalesce("component_key", "key").alias("component_key"),
    )
    return made, found, texts


def joined(docs: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, n_shingles, component_id (the least id of the component)."""
    return _named(classified(docs)).select("doc_id", "n_shingles", "component_id")


def linked_documents(docs: DataFrame) -> DataFrame:
    """joined() with class_id (of equal sets) and n_links, the number of rows a row links with."""
    rows, found, texts = _classified(docs)
    release(docs.sparkSession)
    classes = rows.where(F.col("n_shingles") > 0).groupBy("key").agg(
        F.max("n_shingles").alias("n"), F.count("*").alias("copies")
    )
    counts = saved(link_counts(found, classes, texts), "counts")
    release(docs.sparkSession)
    links = classes.join(counts, "key", "left").select(
        F.col("key").alias("_class"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("_links")
    )
    return _named(rows).join(links, F.col("key") == F.col("_class"), "left").select(
        "doc_id", "n_shingles", "component_id", F.col("key").alias("class_id"),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _named(rows: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key and component_id of classified rows."""
    has = F.col("n_shingles") > 0
    least = rows.where(has).groupBy(F.col("component_key").alias("_k")).agg(
        F.min("doc_id").alias("_least")
    )
    return rows.join(least, has & (F.col("component_key") == F.col("_k")), "left").select(
        "doc_id", "n_shingles", "key",
        F.when(has, F.col("_least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


