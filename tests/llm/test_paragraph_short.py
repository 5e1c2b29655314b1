"""Paragraph dedup of short lines and of wrapped passages, as the registered query runs it."""

from util import docs_frame, prose

from retail_insight.llm import paragraph_dedup as pd


def wrap(words, width):
    return "\n".join(" ".join(words[i:i + width]) for i in range(0, len(words), width))


def removed(spark, rows):
    got = pd.remove_paragraphs(docs_frame(spark, rows), short_words=pd.SHORT_WORDS, run_words=pd.RUN_WORDS)
    return {r.doc_id: r for r in got.collect()}


def test_short_and_wrapped(spark):
    words = prose(900, 60).split()
    long = prose(901, 400).split()
    near = [*words[:30], "changed", *words[31:]]
    line = "seven words stand in this short line"
    alone = "an own line of six words"
    rows = [(1, wrap(words, 12)), (2, "Intro of it\n\n" + wrap(words, 9) + "\n\nend of it"),
            (3, wrap(near, 11)), (4, " ".join(words)), (5, f"head here\n{line}\n"), (6, f"{line}\nno four words here"),
            (7, f"x y\n\n{line.upper()}"), (8, f"{alone}\n\nshort one\n\nshort one"), (9, "short one"),
            (10, wrap(long, 12)), (11, wrap(prose(902, 45).split() + long, 10))]
    got = removed(spark, rows)
    assert got[1].n_removed == 0 and got[1].kept_text == rows[0][1]
    assert got[2].kept_text == "Intro of it\n\n\nend of it" and got[2].first_doc_ids == [1]
    assert got[3].kept_text == "" and got[4].kept_text == ""
    assert got[5].n_removed == 0
    assert got[6].kept_text == "no four words here" and got[6].first_doc_ids == [5]
    assert got[7].kept_text == "x y\n\n"
    assert got[8].n_removed == 0 == got[9].n_removed
    # cut by content: another width and other words before it, and most of a long run is still found
    assert len(got[11].kept_text.split()) < 45 + 130
    for r in got.values():
        assert len(r.kept_text.encode()) == r.n_bytes - r.removed_bytes


def test_line_of_a_removed_passage_is_not_the_one_that_stays(spark):
    words = prose(903, 120).split()
    line = "this line is in the second text only"
    rows = [(1, wrap(words[:84], 12)), (2, wrap(words[:48], 12) + f"\n{line}\n" + wrap(words[48:84], 12)), (3, f"{line}\n\nother")]
    got = removed(spark, rows)
    assert got[2].kept_text == "" and got[3].kept_text == rows[2][1]
