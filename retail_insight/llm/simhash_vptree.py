"""SimHash near-duplicates by vantage-point trees.

A text's fingerprint has 64 bits, each 1 if it is set in over half the XXH64
hashes of the text's word shingles. Fingerprints link at a Hamming distance
of at most ``radius``.

A tree node holds a vantage point v and a distance r. Fingerprints at a
distance of at most r go inside, the others outside. By the triangle bound,
of a linked pair that the node parts the inner one is farther than r - radius
from v; such inner ones visit the outside as well. So every linked pair is
together on one side, at each node, and at last in a shard: shards are
searched on their own, by smaller trees of the same kind and exact compares
in their leaves.

The upper tree is fitted on a bounded sample and only routes: whatever the
sample, no pair is lost. Equal fingerprints are one node from the start. A
leaf returns each linked group as a star, not all its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as tx
from ._components import components
from ._stage import staged

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints of a shard, and the most that are sampled to fit the upper tree.
SHARD_ROWS = 16_384
SAMPLE_ROWS = 65_536
#: A set of so many is compared directly; one that no vantage point parts up to DENSE_ROWS, then by flips.
LEAF_ROWS = 192
DENSE_ROWS = 32_768
_FEW = 24          # sampled fingerprints of an upper tree's leaf, at least
_TRIES = 4
_LOWER = bytes(tx.LOWER)
_SHINGLES_AT_ONCE = 1 << 16


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of lower-cased words, repeats included; of the whole sequence if it is shorter."""
    words = text.translate(_LOWER).split()
    joined, n = b" ".join(words), len(words)
    if n <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if n else [], np.uint64)
    length = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(length + 1) - 1
    start = (end - length)[:n - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start, end[size - 1:].tolist())), np.uint64, len(start))


def majority(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The fingerprint of each text from the hashes of all, ``n[i]`` of them for text i."""
    bits = np.zeros((len(n), 64), np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    for lo in range(0, len(hashes), _SHINGLES_AT_ONCE):
        at = owner[lo:lo + _SHINGLES_AT_ONCE]
        raw = np.unpackbits(hashes[lo:lo + _SHINGLES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        bits[at[first]] += np.add.reduceat(raw, first, axis=0, dtype=np.int64)
    return np.packbits(2 * bits > n[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row: fp is the fingerprint as a signed long, zero without words."""
    source = tx.pick(docs, id=id_col, text=text_col)

    def run(block: tx.Block):
        hashes = [shingle_hashes(block.text_bytes(i), size) for i in range(block.n)]
        n = np.fromiter(map(len, hashes), np.int64, len(hashes))
        return tx.record_batch(id=block.column("id"), fp=majority(np.concatenate(hashes), n).view(np.int64))

    return tx.map_blocks(source, "text", run, f"id {source.schema['id'].dataType.simpleString()}, fp long")


# -- trees -------------------------------------------------------------------
def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


@dataclass
class Node:
    point: np.uint64 = np.uint64(0)
    r: int = -1
    inside: "Node | None" = None
    outside: "Node | None" = None
    shard: int = -1


def vantage(points: np.ndarray, radius: int) -> tuple[int, int, int] | None:
    """(index, r, rows of the larger side) of the split that leaves the larger side least; None if none shrinks it.

    A few spread candidates are tried, the last of them the point farthest from the first.
    """
    best = None
    tries = list(range(0, len(points), max(1, len(points) // (_TRIES - 1))))[:_TRIES - 1]
    tries.append(int(np.argmax(distance(points, points[0]))))
    for at in tries:
        below = np.cumsum(np.bincount(distance(points, points[at]), minlength=65))
        r = np.arange(65)
        beyond = np.where(r >= radius, below[np.maximum(r - radius, 0)], 0)      # inner ones that stay inside
        larger = np.maximum(below, len(points) - beyond)
        k = int(np.argmin(larger))
        if best is None or larger[k] < best[2]:
            best = (at, k, int(larger[k]))
    return best if best and best[2] < len(points) - len(points) // 16 else None


def sides(points: np.ndarray, at_point: np.uint64, r: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Who goes inside, and who goes or visits outside."""
    d = distance(points, at_point)
    return d <= r, d > r - radius


def fit(sample: np.ndarray, shards: int, radius: int) -> tuple[Node, int]:
    """The upper tree over a sample, with about ``shards`` leaves; their number."""
    count = 0
    least = max(_FEW, len(sample) // max(1, shards))

    def grow(points: np.ndarray) -> Node:
        nonlocal count
        split = vantage(points, radius) if len(points) > 2 * least else None
        if split is None:
            count += 1
            return Node(shard=count - 1)
        inner, outer = sides(points, points[split[0]], split[1], radius)
        return Node(points[split[0]], split[1], grow(points[inner]), grow(points[outer]))

    return grow(sample), count


def route(node: Node, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, index) of every place of every point: one at least, more near boundaries."""
    found, todo = [], [(node, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node.shard >= 0:
            found.append((node.shard, at))
            continue
        inner, outer = sides(points[at], node.point, node.r, radius)
        todo += [(node.inside, at[inner]), (node.outside, at[outer])]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.repeat([s for s, _ in found], [len(a) for _, a in found]), np.concatenate([a for _, a in found])


class Groups:
    """Union-find over the points of one shard."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite a[i] with b[i] for all i: the least root of either side is hung on, until all agree."""
        while len(a):
            x, y = self.roots(a), self.roots(b)
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))

    def roots(self, at: np.ndarray) -> np.ndarray:
        now = self.parent[at]
        while True:
            up = self.parent[now]
            if np.array_equal(up, now):
                self.parent[at] = now
                return now
            now = up


def search(points: np.ndarray, radius: int, leaf: int = LEAF_ROWS, dense: int = DENSE_ROWS) -> np.ndarray:
    """The least linked index of every point's group (``points`` distinct, sorted), by a tree and exact compares."""
    groups = Groups(len(points))
    todo = [np.arange(len(points))]
    while todo:
        at = todo.pop()
        split = vantage(points[at], radius) if len(at) > leaf else None
        if split is not None:
            inner, outer = sides(points[at], points[at[split[0]]], split[1], radius)
            todo += [at[inner], at[outer]]
        elif len(at) <= dense:
            step = max(1, (1 << 22) // max(1, len(at)))
            for lo in range(0, len(at), step):
                near = distance(points[at[lo:lo + step], None], points[at][None, :]) <= radius
                i, j = np.nonzero(near)
                groups.join(at[lo + i], at[j])
        else:
            for mask in flips(radius):
                other = points[at] ^ mask
                k = np.minimum(np.searchsorted(points[at], other), len(at) - 1)
                hit = points[at][k] == other
                groups.join(at[hit], at[k[hit]])
    return groups.roots(np.arange(len(points)))


def flips(radius: int) -> list[np.uint64]:
    """All masks of one to ``radius`` bits."""
    one = [1 << i for i in range(64)]
    masks, last = set(one), set(one)
    for _ in range(radius - 1):
        last = {m | b for m in last for b in one if not m & b}
        masks |= last
    return [np.uint64(m) for m in sorted(masks)] if radius else []


# -- the operator ------------------------------------------------------------
def links(nodes: DataFrame, *, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, sample_rows: int = SAMPLE_ROWS,
          leaf_rows: int = LEAF_ROWS, dense_rows: int = DENSE_ROWS) -> DataFrame:
    """Stars (a, b) that connect what is linked among the distinct fingerprints of ``nodes`` (column fp)."""
    total = nodes.count()
    # the sample: the fingerprints of least hash, the same ones at every run
    picked = (nodes.select("fp").withColumn("h", F.xxhash64(F.col("fp"))).orderBy("h", "fp").limit(sample_rows)
              .toArrow().column("fp").to_numpy().astype(np.int64).view(np.uint64))
    tree, shards = fit(picked, -(-total // shard_rows), radius)

    def place(batches):
        for batch in batches:
            points = batch.column(0).to_numpy().view(np.uint64)
            shard, at = route(tree, points, radius)
            yield tx.record_batch(shard=shard.astype(np.int64), fp=points[at].view(np.int64))

    def compare(_, table):
        points = np.unique(table.column("fp").to_numpy().view(np.uint64))
        root = search(points, radius, leaf_rows, dense_rows)
        linked = np.flatnonzero(root != np.arange(len(points)))
        return pa.table({"a": points[linked].view(np.int64), "b": points[root[linked]].view(np.int64)})

    placed = nodes.select("fp").mapInArrow(place, "shard long, fp long")
    return placed.groupBy("shard").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    radius: int = RADIUS, **options) -> DataFrame:
    """Fingerprint and component of every row of ``docs``: id, fingerprint, component_id.

    component_id is the least id reachable by links. A null, empty or blank
    text has the fingerprint zero and is linked like any other. A row with a
    null id has links (others reach each other through it) and the component
    of its group, null if the group has no id. Rows that share an id have the
    fingerprints of their own texts and are one document: the links of each
    hold for all. An empty table gives no rows. Other columns are not read.
    """
    rows = staged(fingerprints(docs, id_col=id_col, text_col=text_col, size=size), "simhash-rows")
    nodes = staged(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")), "simhash-nodes")
    edges = links(nodes, radius=radius, **options)
    several = (rows.filter("id is not null").groupBy("id").agg(F.min("fp").alias("b"), F.max("fp").alias("top"))
               .filter("b <> top").select("id", "b"))
    same_id = rows.join(several, "id").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    root = components(edges.unionByName(same_id), "simhash-components")
    grouped = nodes.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    label = staged(grouped.join(least, "root").select("fp", "copies", "component_id"), "simhash-labels")
    # At most a thousand fingerprints hold a thousandth of all rows each: these are broadcast, the others joined.
    total = rows.count()
    often = F.col("copies") * 1000 >= total
    hot = label.filter(often).select("fp", F.lit(True).alias("hot"), "component_id")
    marked = rows.join(F.broadcast(hot), "fp", "left")
    rest = marked.filter("hot is null").select("id", "fp").join(label.filter(~often).select("fp", "component_id"), "fp")
    both = marked.filter("hot").select("id", "fp", "component_id").unionByName(rest.select("id", "fp", "component_id"))
    return both.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
