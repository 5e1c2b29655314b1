"""Merkle manifest of a table: a tree of SHA-256 digests whose parents keep midstates.

A row's leaf is the digest of its fields. The leaves of one tree value (a
language, say), in the order of their ids, are joined eight at a time until
one digest, the subroot, is left; the subroots are joined likewise to the
root. A digest enters its parent as 64 hexadecimal characters.

Hashing a parent, the state of the hash is copied before each child goes in.
To see what root a changed row would give, the copy before its slot resumes
with the new digest and the siblings to the right; what lies to the left is
not hashed again. The siblings of all levels are the row's proof.

Trees are cut into chunks of ``ARITY ** HEIGHT`` neighbours, each a bounded
task: chunks give the nodes HEIGHT levels up, theirs in turn those above, so
10^10 leaves take three passes. On the way down a chunk learns the steps
above its own top; those few states are hashed once a chunk and copied for
each of its rows, since a hash state cannot leave its process.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text as tx
from ._rank import ranked
from ._stage import staged

ARITY = 8
HEIGHT = 4
_DIGEST = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass
class Parent:
    """A run of up to ARITY digests, with the hash states before each."""

    run: bytes
    states: list = field(default_factory=list)
    digest: bytes = b""

    def __post_init__(self):
        h = sha256()
        for at in range(0, len(self.run), _DIGEST):
            self.states.append(h.copy())
            h.update(self.run[at:at + _DIGEST])
        self.digest = h.hexdigest().encode()

    def siblings(self, slot: int) -> tuple[bytes, bytes]:
        return self.run[:slot * _DIGEST], self.run[(slot + 1) * _DIGEST:]

    def fold(self, slot: int, digest: bytes) -> bytes:
        return resume(self.states[slot], digest, self.run[(slot + 1) * _DIGEST:])


def resume(state, digest: bytes, right: bytes) -> bytes:
    """The parent's digest from the state before a child, the child and its right siblings."""
    h = state.copy()
    h.update(digest)
    h.update(right)
    return h.hexdigest().encode()


class Subtree:
    """The levels above a chunk of neighbouring digests: ``height`` of them, or until one digest is left."""

    def __init__(self, digests: list[bytes], height: int | None = None):
        self.levels: list[list[Parent]] = []
        while len(digests) > 1 if height is None else len(self.levels) < height:
            parents = [Parent(b"".join(digests[i:i + ARITY])) for i in range(0, len(digests), ARITY)]
            self.levels.append(parents)
            digests = [p.digest for p in parents]
        self.top = digests[0]

    def steps(self, at: int) -> list[tuple[Parent, int]]:
        """(parent, slot) from a digest up to the top."""
        out = []
        for level in self.levels:
            at, slot = divmod(at, ARITY)
            out.append((level[at], slot))
        return out


def _subtree(table: pa.Table) -> tuple[Subtree, pa.Table]:
    """The chunk's subtree and its rows in order. The last chunk of a tall tree climbs as many levels as the others."""
    table = table.sort_by("pos")
    alone = table.column("n")[0].as_py() <= ARITY ** HEIGHT
    return Subtree([d.encode() for d in table.column("digest").to_pylist()], None if alone else HEIGHT), table


def _chunk() -> Column:
    return F.floor(F.col("pos") / ARITY ** HEIGHT).cast("long")


def _climb(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, pos, n, digest) to those at the top of each chunk."""

    def top(key, table):
        subtree, _ = _subtree(table)
        n = -(-table.column("n")[0].as_py() // ARITY ** HEIGHT)
        return pa.table({"tree": [key[0].as_py()], "pos": [key[1].as_py()], "n": [n], "digest": [subtree.top.decode()]})

    chunks = nodes.select("tree", "pos", "n", "digest", _chunk().alias("chunk")).groupBy("tree", "chunk")
    return staged(chunks.applyInArrow(top, "tree string, pos long, n long, digest string"), "merkle-nodes")


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The nodes, those HEIGHT levels above, and so on to one node a tree."""
    out = [nodes]
    while True:
        out.append(_climb(out[-1]))
        if (out[-1].agg(F.max("n")).first()[0] or 0) <= 1:
            return out


_PATH = "subroot string, before array<string>, after array<string>"


def _descend(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The path (siblings before and after at each level up to the root) of every node from those of the chunks."""

    def down(_, table, above):
        subtree, table = _subtree(table)
        up = above.to_pylist()[0]
        out = {"tree": table.column("tree"), "pos": table.column("pos"), "subroot": [], "before": [], "after": []}
        for i in range(table.num_rows):
            sides = [parent.siblings(slot) for parent, slot in subtree.steps(i)]
            out["subroot"].append(up["subroot"])
            out["before"].append([b.decode() for b, _ in sides] + up["before"])
            out["after"].append([a.decode() for _, a in sides] + up["after"])
        return pa.table(out).cast(pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("subroot", pa.string()),
                                             ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))

    chunks = nodes.select("tree", "pos", "n", "digest", _chunk().alias("chunk")).groupBy("tree", "chunk")
    above = paths.withColumnRenamed("pos", "chunk").groupBy("tree", "chunk")
    return staged(chunks.cogroup(above).applyInArrow(down, f"tree string, pos long, {_PATH}"), "merkle-paths")


def _paths_of_chunks(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """From the paths of the trees' tops (tree, pos, subroot, before, after) to those of the lowest chunks."""
    paths = tops
    for nodes in reversed(levels[1:-1]):
        paths = _descend(nodes, paths)
    return paths


def _digest(fields: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields: ``-`` for null, else UTF-8 bytes, a colon, the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


def manifest(docs: DataFrame, *, changed: dict[str, Column] | None = None, columns: tuple[str, ...] = COLUMNS,
             id_col: str = "doc_id", tree_col: str = "lang") -> DataFrame:
    """Every row of ``docs`` with its place in the tree and the root its changed form gives.

    ``columns`` enter the leaf in their order. ``changed`` maps a column to an
    expression over ``docs``: folded_root is the root after replacing this
    row alone by its changed form, verified tells whether it is the root.
    proof_sha256 is the digest of the siblings of all levels, left to right.

    A null id sorts before all others; rows of one id follow their leaves, and
    equal rows are leaves of their own. A null tree value is a tree of its
    own, the first. A tree of one leaf has it as its subroot, and one subroot
    is the root. An empty table gives no rows. Columns not named are not read.
    """
    changed = changed or {}
    plain = [F.col(f"`{c}`") for c in columns]
    swapped = [changed.get(c, F.col(f"`{c}`")) for c in columns]
    value = F.col(f"`{tree_col}`").cast("string")
    # "-" sorts before "=": the tree of nulls comes first, the others by their bytes
    tree = F.when(value.isNull(), "-").otherwise(F.concat(F.lit("="), value))
    rows = staged(docs.select(F.col(f"`{id_col}`").alias("id"), tree.alias("tree"), _digest(plain).alias("digest"),
                              (_digest(swapped) if changed else _digest(plain)).alias("candidate"),
                              F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    leaves = staged(ranked(rows, ["tree"], ["id", "digest", "row"], "merkle-ranges"), "merkle-ranked")
    trees = _levels(leaves)
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    subroots = staged(ranked(subroots, ["tree"], ["of"], "merkle-subranges"), "merkle-subroots")
    summit = _levels(subroots)
    empty = F.array().cast("array<string>")
    tops = summit[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"),
                             empty.alias("before"), empty.alias("after"))
    first = summit[-1].first()
    root = first["digest"] if first else ""
    above = _descend(subroots, _paths_of_chunks(summit, tops))
    tops = (subroots.select("pos", "of", "digest").join(above.drop("subroot", "tree"), "pos")
            .select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"),
                    "before", "after"))
    paths = _paths_of_chunks(trees, tops)
    id_type = rows.schema["id"].dataType.simpleString()

    def fold(_, table, up):
        subtree, table = _subtree(table)
        path = up.to_pylist()[0]
        before, after = ([s.encode() for s in path[side]] for side in ("before", "after"))
        states = [(sha256(b), a) for b, a in zip(before, after)]
        rest = b"".join(b + a for b, a in zip(before, after))
        proofs, folded = [], []
        for i, digest in enumerate(table.column("candidate").to_pylist()):
            proof, digest = sha256(), digest.encode()
            for parent, slot in subtree.steps(i):
                for side in parent.siblings(slot):
                    proof.update(side)
                digest = parent.fold(slot, digest)
            proof.update(rest)
            for state, right in states:
                digest = resume(state, digest, right)
            proofs.append(proof.hexdigest())
            folded.append(digest.decode())
        return pa.table([table.column("id"), table.column("digest"), pa.array([path["subroot"]] * len(proofs), pa.string()),
                         pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
                        names=["id", "leaf", "subroot", "proof_sha256", "folded_root"])

    chunks = leaves.drop("row").withColumn("chunk", _chunk()).groupBy("tree", "chunk")
    found = chunks.cogroup(paths.withColumnRenamed("pos", "chunk").groupBy("tree", "chunk")).applyInArrow(
        fold, f"id {id_type}, leaf string, subroot string, proof_sha256 string, folded_root string")
    return found.select(F.col("id").alias(id_col), "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256",
                        "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"))


def lower_case_some(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """The tampering of the registered query: A-Z lower-cased where 3 divides crc32 of the decimal id."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.encode(F.col(f"`{id_col}`").cast("string"), "UTF-8")) % 3 == 0
    text = F.col(f"`{text_col}`")
    return {text_col: F.when(hit, F.translate(text, upper, upper.lower())).otherwise(text)}
