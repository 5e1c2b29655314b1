"""Paragraph dedup of passages inside long lines, and its pairing."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_paragraph import brute, line
from util import docs_frame, rows_of

from retail_insight.llm import _text as tx
from retail_insight.llm import paragraph_dedup as pd

OPTIONS = {"run_words": pd.RUN_WORDS, "piece_words": pd.PIECE_WORDS}


def removed(spark, rows):
    return {r.doc_id: r for r in pd.remove_paragraphs(docs_frame(spark, rows), **OPTIONS).collect()}


def test_passage_inside_other_lines(spark):
    passage = line(950, 120)
    rows = [(1, f"{line(951, 90)} {passage} {line(952, 70)}"), (2, f"title\n{line(953, 60)} {passage} {line(954, 110)}\nend"),
            (3, line(955, 300)), (4, f"{line(956, 30)} {passage}\nnext line"), (5, "")]
    got = removed(spark, rows)
    assert got[1].n_removed == got[3].n_removed == got[5].n_removed == 0
    for i, text in rows:
        r = got[i]
        assert len(r.kept_text.encode()) == r.n_bytes - r.removed_bytes
        if i in (2, 4):
            assert r.n_removed and r.first_doc_ids == [1]
            gone = len(text.split()) - len(r.kept_text.split())
            assert pd.PIECE_WORDS <= gone <= 120
    assert got[2].kept_text.startswith("title\n") and got[2].kept_text.endswith("\nend")
    # the break after a line of which something stays is not lost
    assert "\nnext line" in got[4].kept_text
    assert [got[i].n_paragraphs for i in range(1, 6)] == [1, 1, 1, 1, 0]


def test_piece_of_a_removed_paragraph_is_not_the_one_that_stays(spark):
    words = line(960, 90).split(" ")
    near = [*words[:45], "changed", *words[46:]]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, f"{line(961, 80)} {' '.join(near[20:70])} {line(962, 80)}")]
    got = removed(spark, rows)
    assert got[2].kept_text == "" and got[2].first_doc_ids == [1]
    assert "changed" in got[3].kept_text.split()     # its piece stands nowhere else now


@pytest.mark.parametrize("texts", [[""], ["a"], ["", "word " * 300, "", "a b"], [line(970, 500), "x", line(971, 39)]])
def test_pieces_are_whole_and_long_enough(texts):
    table = pa.record_batch([pa.array(texts)], names=["text"])
    for block in tx.blocks(table, "text"):
        p = pd.Paragraphs(block, 20, 100)
        start, end, doc, node = p.pieces(20)
        assert len(start) == len(end) == len(doc) == len(node)
        for a, z in zip(start.tolist(), end.tolist()):
            assert len(block.data[a:z].tobytes().split()) >= 20
        for k in range(len(p.start)):
            own = np.flatnonzero((start >= p.start[k]) & (end <= p.end[k]))
            if len(own):
                assert start[own[0]] == p.start[k] and end[own[-1]] == p.end[k]
                assert (start[own[1:]] == end[own[:-1]]).all()


def test_pairs_between_stars_do_not_grow_with_the_square(spark, monkeypatch):
    """Paragraphs that share over half of their words, and link with few: candidates stay few."""
    rng, common, rows = random.Random(5), line(980, 40).split(" "), []
    for k in range(120):
        rows.append((k, " ".join([*common, *line(9000 + k, 24).split(" ")])))
    rows += [(500 + k, rows[rng.randrange(120)][1] + " more") for k in range(20)]
    sizes = []
    staged = pd.staged

    def counted(df, name):
        out = staged(df, name)
        if name == "paragraph-pairs":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(pd, "staged", counted)
    got = pd.remove_paragraphs(docs_frame(spark, rows))
    assert rows_of(got.select("doc_id", "n_paragraphs", "n_removed", "first_doc_ids")) == brute(rows)
    assert sum(sizes) < 4 * len(rows)


def test_options_that_overlap(spark):
    with pytest.raises(ValueError):
        pd.remove_paragraphs(docs_frame(spark, [(1, "a")]), short_words=5, piece_words=20)


def test_most_passages_of_60_words_are_found(spark):
    """Each second text repeats 60 words in the middle of its one line."""
    rows = []
    for k in range(40):
        passage = line(20_000 + k, 60)
        rows += [(2 * k, f"{line(21_000 + k, 70)} {passage} {line(22_000 + k, 50)}"),
                 (2 * k + 1, f"{line(23_000 + k, 45)} {passage} {line(24_000 + k, 80)}")]
    got = removed(spark, rows)
    assert not any(got[2 * k].n_removed for k in range(40))
    found = [k for k in range(40) if got[2 * k + 1].removed_bytes]
    assert len(found) >= 36
    for k in found:
        gone = len(rows[2 * k + 1][1].split()) - len(got[2 * k + 1].kept_text.split())
        assert pd.REPEAT_WORDS <= gone <= 60 and got[2 * k + 1].first_doc_ids == [2 * k]


def test_pieces_go_only_in_runs_of_enough_words():
    raw = b"one two three four five six seven eight nine"

    def span(lo, hi, short=True):
        return {"lo": lo, "hi": hi, "short": short, "first": 1}

    paragraph, a, b, apart = span(0, 4, False), span(4, 14), span(14, 24), span(28, 34)
    assert pd._long_runs(raw, [paragraph, a, b, apart], 4) == [paragraph, a, b]
    assert pd._long_runs(raw, [paragraph, a, apart], 4) == [paragraph]
    assert pd._long_runs(raw, [], 4) == []


def test_rounds_without_new_pairs_are_skipped(spark, monkeypatch):
    """Links are followed again only after a round that found some."""
    rows = [(k, f"{line(990, 40)} {line(25_000 + k, 9)}") for k in range(12)]
    calls, components = [], pd.components
    monkeypatch.setattr(pd, "components", lambda *a: calls.append(1) or components(*a))
    pairs, staged = [], pd.staged

    def counted(df, name):
        out = staged(df, name)
        if name in ("paragraph-pairs", "paragraph-links"):
            pairs.append((name, out.count()))
        return out

    monkeypatch.setattr(pd, "staged", counted)
    got = pd.remove_paragraphs(docs_frame(spark, rows))
    assert rows_of(got.select("doc_id", "n_paragraphs", "n_removed", "first_doc_ids")) == brute(rows)
    links = [n for name, n in pairs if name == "paragraph-links"]
    assert len(calls) == max(1, sum(n > 0 for n in links))
    assert len(links) == max(1, sum(n > 0 for name, n in pairs if name == "paragraph-pairs"))
