"""N-gram components against all pairs."""

import random
import re
from collections import defaultdict

import pytest
from util import docs_frame, edge_docs, prose, rows_of

from retail_insight.llm import ngram_join


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=75):
    sets = [shingle_set(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            where[g].append(k)
    seen = set()
    for ks in where.values():
        for a in ks:
            for b in ks:
                if a < b and (a, b) not in seen and None not in (rows[a][0], rows[b][0]):
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                        x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                        parent[y] = x
    return sorted([(i, len(s), find(i) if i is not None and s else i) for (i, _), s in zip(rows, sets)], key=repr)


def mutated(text, seed, share):
    rng, words = random.Random(seed), text.split(" ")
    return " ".join("zz%d" % rng.randrange(10**6) if rng.random() < share else w for w in words)


def cases():
    rng = random.Random(5)
    rows = edge_docs()
    base = [prose(400 + k, rng.randint(20, 200)) for k in range(12)]
    passage = prose(999, 60)
    n = 1000
    for k, b in enumerate(base):
        for j in range(rng.randint(1, 9)):
            rows.append((n, mutated(b, n, rng.choice([0, .01, .02, .04, .06]))))
            n += 1
    for j in range(30):
        rows.append((n, prose(5000 + j, 30) + " " + passage))     # a passage that many share
        n += 1
    chain = prose(77, 120).split(" ")
    for j in range(15):                                           # a long chain of links
        rows.append((n, " ".join(chain[3 * j:3 * j + 60])))
        n += 1
    rows += [(n + 1, "one two"), (n + 2, "ONE  two"), (n + 3, "one two three four five"), (n + 4, "two one")]
    rows += [(1003, prose(9000, 40)), (n + 5, prose(9000, 40))]   # an id with two texts
    return rows


@pytest.mark.parametrize("hub_rounds", [0, 2])
def test_components(spark, hub_rounds):
    rows = cases()
    got = ngram_join.jaccard_components(docs_frame(spark, rows), hub_rounds=hub_rounds)
    assert rows_of(got) == brute(rows)


def test_frequent_tokens_are_salted(spark, monkeypatch):
    import numpy as np

    rows = cases()
    monkeypatch.setattr(ngram_join, "frequent", lambda *a: np.arange(1 << 17) % 2 == 0)
    assert rows_of(ngram_join.jaccard_components(docs_frame(spark, rows))) == brute(rows)


def test_keep_one_of_each(spark):
    rows = cases()
    df = docs_frame(spark, rows)
    left = ngram_join.keep_one_of_each(df)
    assert left.columns == df.columns
    found = brute(rows)
    got = sorted([r.doc_id for r in left.collect()], key=repr)
    ids = {i for i, n, c in found if i is not None and n and i == c}
    want = list(ids) + [i for i, n, c in found if i is None or not n]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a b c d e f")], [(2, ""), (1, "a b"), (1, "a b")]])
def test_small_tables(spark, rows):
    assert rows_of(ngram_join.jaccard_components(docs_frame(spark, rows))) == brute(rows)
    assert ngram_join.keep_one_of_each(docs_frame(spark, rows)).count() == min(len(rows), 2)
