"""op12 against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from retail_insight.llm import simhash_vptree as sv
from util import docs_frame, edge_docs, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def literal_print(text):
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in (text or "").translate(LOWER)).split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def literal(rows, radius=2):
    prints = [literal_print(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if same or bin(prints[i] ^ prints[j]).count("1") <= radius:
                part[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((d, f"{p:016x}", least.get(root(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def near_copies():
    rng, rows = random.Random(5), []
    for g in range(12):
        words = prose(100 + g, 400).split()
        for _ in range(rng.randint(1, 8)):
            changed = list(words)
            for _ in range(rng.randint(0, 3)):
                changed[rng.randrange(len(changed))] = "CHANGED"
            rows.append((len(rows) + 20, " ".join(changed)))
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_rows": 4, "sample_rows": 64, "leaf_rows": 2},
                                     {"sample_rows": 1}, {"radius": 6, "shard_rows": 8, "leaf_rows": 3}])
def test_components_are_those_of_all_pairs(spark, options):
    rows = edge_docs() + near_copies()
    out = sv.near_duplicates(docs_frame(spark, rows, ("fp", "least", "root", "hot", "shard", "copies")), **options)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == literal(rows, options.get("radius", 2))


def test_empty_table(spark):
    assert sv.near_duplicates(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("leaf,dense", [(2, 4), (8, 1 << 20), (192, 32_768)])
def test_search_finds_the_groups_of_all_pairs(leaf, dense):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (60, 6, 2)).astype(np.uint64)).sum(axis=2, dtype=np.uint64)
    points = np.unique(np.concatenate([centres, (centres[:, None] ^ flips).ravel()]))
    root = sv.search(points, 2, leaf, dense)
    want = np.arange(len(points))
    near = sv.distance(points[:, None], points[None, :]) <= 2
    for _ in range(len(points)):
        new = np.array([want[row].min() for row in near])
        if np.array_equal(new, want):
            break
        want = new
    assert np.array_equal(root, want)


def test_no_linked_pair_is_parted_by_the_upper_tree():
    rng = np.random.default_rng(4)
    points = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    linked = points ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
    tree, shards = sv.fit(points[:800], 20, 2)
    assert shards > 5
    places = [set() for _ in range(6000)]
    for shard, at in zip(*sv.route(tree, np.concatenate([points, linked]), 2)):
        places[at].add(int(shard))
    assert all(places[i] & places[i + 3000] for i in range(3000))
