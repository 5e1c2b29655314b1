"""Substring dedup against all windows."""

import hashlib

import numpy as np
import pytest
from util import docs_frame, edge_docs, prose, rows_of

from retail_insight.llm import substring_dedup as sd


def brute(rows):
    first = {}
    texts = [(-2**63 if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if w not in first or (i, s) < first[w]:
                first[w] = (i, s)
    out = []
    for (orig, _), (i, b) in zip(rows, texts):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if first[b[s:s + 100]] < (i, s):
                gone[s:s + 100] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((orig, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def cases():
    rows = [(i, t[:8000] if t and i != 7 else (t and t[:3000])) for i, t in edge_docs()]
    share = prose(900, 60)
    for k in range(25):
        a = prose(1000 + k, 30 + 7 * k % 90)
        rows.append((100 + k, a + share[k:len(share) - k] + prose(2000 + k, 25)))
    long = prose(901, 300)
    for k in range(12):
        rows.append((200 - k, prose(3000 + k % 3, 12) + long[37 * k:37 * k + 300] + prose(3000 + k, 9)))
    rows += [(300, "ab" * 400), (301, "x" + "ab" * 200), (302, prose(5, 40) + prose(5, 40)), (303, share[:99]), (304, share[:100])]
    return rows


@pytest.mark.parametrize("often", [None, 2])
def test_matches_all_windows(spark, monkeypatch, often):
    if often:
        monkeypatch.setattr(sd, "frequent_cells", lambda *a: np.arange(1 << 17) % often == 0)
    rows = cases()
    got = rows_of(sd.remove_repeats(docs_frame(spark, rows)).drop("kept"))
    assert got == brute(rows)


def test_suffix_sort():
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 99, (200, 12)).astype(np.uint8)
    length = rng.integers(1, 13, 200)
    rows[np.arange(12)[None, :] >= length[:, None]] = 0
    s = sd.Suffixes(rows, length)
    first, size = np.repeat([0, 50, 53], [50, 3, 147]), np.repeat([50, 3, 147], [50, 3, 147])
    text = [bytes(r[:n]) for r, n in zip(rows, length)]
    by = s.sort(first, size)
    for lo, n in ((0, 50), (50, 3), (53, 147)):
        assert [text[i] for i in by[lo:lo + n]] == sorted(text[lo:lo + n])
    assert s.neighbours(by, first)[1]


def test_rows_are_sorted_by_bytes_where_hashes_collide(monkeypatch):
    """A hash that sees one byte in two makes many rows look equal."""
    monkeypatch.setattr(sd.tx, "BYTE_CODE", sd.tx.BYTE_CODE[np.arange(256) // 2])
    rng = np.random.default_rng(4)
    rows = rng.integers(96, 100, (120, 6)).astype(np.uint8)
    length = rng.integers(1, 7, 120)
    rows[np.arange(6)[None, :] >= length[:, None]] = 0
    s = sd.Suffixes(rows, length)
    first, size = np.repeat([0, 70], [70, 50]), np.repeat([70, 50], [70, 50])
    assert not s.neighbours(s.sort(first, size), first)[1]
    by, common = s.ranked(first, size)
    text = [bytes(r[:n]) for r, n in zip(rows, length)]
    for lo, n in ((0, 70), (70, 50)):
        assert [text[i] for i in by[lo:lo + n]] == sorted(text[lo:lo + n])
        assert common[lo] == -1
    for i in range(1, 120):
        if i != 70:
            a, b = text[by[i - 1]], text[by[i]]
            assert common[i] == next((k for k in range(6) if a[k:k + 1] != b[k:k + 1] or k >= len(a)), 6)


def test_null_ids_are_told_apart_by_their_texts(spark):
    """Two texts of one 32-bit hash (found by the birthday of 200,000 texts)."""
    words = spark.range(200_000).selectExpr("concat(id, ' ', sha2(cast(id as string), 256), repeat(sha2(cast(id as string), 512), 2)) AS text")
    pair = (words.selectExpr("hash(text) AS t", "text").groupBy("t").agg({"text": "collect_list"}).toDF("t", "texts")
            .filter("size(texts) > 1").orderBy("t").first()["texts"][:2])
    assert len(set(pair)) == 2
    share = prose(77, 60)
    rows = [(None, pair[0]), (None, pair[1]), (None, share), (4, pair[0] + share), (5, share + pair[1])]
    assert rows_of(sd.remove_repeats(docs_frame(spark, rows)).drop("kept")) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a"), (2, "")]])
def test_small_tables(spark, rows):
    assert rows_of(sd.remove_repeats(docs_frame(spark, rows)).drop("kept")) == brute(rows)
