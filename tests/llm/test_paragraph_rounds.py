"""What paragraph dedup writes: turns, rounds of components, and rows that stand once."""

import random

import pytest
from test_paragraph import line
from util import docs_frame

from retail_insight.llm import _components as co
from retail_insight.llm import paragraph_dedup as pd


@pytest.fixture
def written(monkeypatch):
    """(name, table) of all that is staged."""
    out = []

    def record(module):
        kept = module.staged

        def staged(df, name):
            out.append((name, kept(df, name)))
            return out[-1][1]

        monkeypatch.setattr(module, "staged", staged)

    record(pd)
    record(co)
    return out


def near(seed):
    """Lines that meet in bands, none similar enough."""
    words = line(seed, 200).split(" ")
    return [" ".join([*words[:20 * k], *line(seed + 1 + k, 20).split(" "), *words[20 * k + 20:]]) + line(seed + 20 + k, 15)
            for k in range(8)]


def test_small_open_groups_take_one_more_turn(spark, written):
    rows = list(enumerate(near(2000), 1))
    pd.remove_paragraphs(docs_frame(spark, rows)).collect()
    assert 1 <= [n for n, _ in written].count("paragraph-pairs") <= 2


@pytest.mark.parametrize("ratio", [0, 10**6])
def test_all_ways_through_the_turns_agree(spark, monkeypatch, written, ratio):
    monkeypatch.setattr(pd, "PAIRS_A_ROW", ratio)
    texts = near(2100)
    for k in range(6):
        words = texts[k].split(" ")
        texts.append(" ".join([*words[:7 + k], "x", *words[8 + k:]]))
    rows = list(enumerate(texts, 1))
    got = {r.doc_id: r.n_removed for r in pd.remove_paragraphs(docs_frame(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == [0] * 8 + [1] * 6
    assert [n for n, _ in written].count("paragraph-pairs") == (2 if ratio else 3)


def test_pieces_that_stand_once_are_not_dealt_out(spark, written):
    passage = line(2200, 60)
    rows = [(1, f"{line(2201, 400)} {passage}"), (2, f"{passage} {line(2202, 400)}"), (3, line(2203, 400))]
    got = pd.remove_paragraphs(docs_frame(spark, rows), run_words=pd.RUN_WORDS, piece_words=pd.PIECE_WORDS)
    assert {r.doc_id: r.n_removed > 0 for r in got.collect()} == {1: False, 2: True, 3: False}
    tables = dict(written)
    lines = tables["paragraph-lines"]
    assert lines.count() == 2 * lines.select("node").distinct().count() < tables["paragraphs"].filter("short").count() / 4
    assert tables["paragraph-placed"].count() == 0     # no paragraph goes


def test_stars_need_no_round(spark, written):
    edges = spark.createDataFrame([(1, k) for k in range(2, 30)] + [(-5, 40)], "a long, b long")
    got = {r.node: r.root for r in co.components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 30), 1), -5: -5, 40: -5}
    assert len(written) == 1


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(-30, 60), rng.randrange(-30, 60)) for _ in range(60)] + [(k, k + 1) for k in range(100, 140)]
    least = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in least:
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    got = co.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(least) and {r.node: r.root for r in got} == least
