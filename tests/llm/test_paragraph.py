"""Paragraph dedup against all pairs of paragraphs."""

import random

import pytest
from util import docs_frame, edge_docs, prose, rows_of

from retail_insight.llm import paragraph_dedup as pd


def shingles(line):
    w = line.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    paras = []
    for k, (i, t) in enumerate(rows):
        at = 0
        for line in (t or "").split("\n"):
            if len(line.split()) >= 20:
                paras.append((-2**63 if i is None else i, at, k, shingles(line)))
            at += len(line.encode()) + 1
    parent = list(range(len(paras)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(paras)):
        for b in range(a):
            x, y = paras[a][3], paras[b][3]
            if 100 * len(x & y) >= 75 * len(x | y):
                parent[find(a)] = find(b)
    first = {}
    for k, p in enumerate(paras):
        first[find(k)] = min(first.get(find(k), p[:2]), p[:2])
    out = []
    for k, (i, t) in enumerate(rows):
        own = [j for j, p in enumerate(paras) if p[2] == k]
        gone = [j for j in own if first[find(j)] != paras[j][:2]]
        out.append((i, len(own), len(gone), sorted({first[find(j)][0] for j in gone})))
    return sorted(out, key=repr)


def line(seed, n):
    return prose(seed, n).replace("\n", " ")


def cases():
    rng, rows = random.Random(2), [(i, t) for i, t in edge_docs() if i != 8]
    base = [line(600 + k, 60) for k in range(6)]
    for k in range(40):
        parts = []
        for _ in range(rng.randint(1, 3)):
            words = rng.choice(base).split(" ")
            for _ in range(rng.choice([0, 0, 1, 2, 12])):
                words[rng.randrange(len(words))] = f"q{rng.randrange(10**6)}"
            parts.append(" ".join(words))
        rows.append((100 + k, "\n".join([line(7000 + k, 25), *parts, "short line"])))
    return rows


def test_matches_all_pairs(spark):
    rows = cases()
    got = pd.remove_paragraphs(docs_frame(spark, rows))
    assert rows_of(got.select("doc_id", "n_paragraphs", "n_removed", "first_doc_ids")) == brute(rows)
    for r in got.collect():
        text = next(t for i, t in rows if i == r.doc_id and len((t or "").encode()) == r.n_bytes) or ""
        assert len(r.kept_text.encode()) == r.n_bytes - r.removed_bytes
        assert r.n_removed or r.kept_text == text


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a"), (2, "")], [(2, line(1, 30)), (2, line(1, 30)), (None, line(1, 30))]])
def test_small_tables(spark, rows):
    got = pd.remove_paragraphs(docs_frame(spark, rows))
    want = [0, 1, 1] if len(rows) == 3 else [0] * len(rows)
    assert sorted(r.n_removed for r in got.collect()) == want
