"""The whole corpus pipeline against a literal version of its stages."""

import re
import zlib
from collections import defaultdict

import corpus_pipeline
import pytest
from test_ngram_join import brute as components, mutated
from tokenizers import Tokenizer
from util import edge_docs, prose

from retail_insight.llm import packing, pii, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, token string, `__hits` string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def inside(w, size, later):
    """Indices in windows of ``size`` words that occur twice (``later``: only those that occur earlier)."""
    at = defaultdict(list)
    for i in range(len(w) - size + 1):
        at[tuple(w[i:i + size])].append(i)
    return {j for ks in at.values() if len(ks) > 1 for i in ks[1 if later else 0:] for j in range(i, i + size)}


def passes_rules(text):
    w = words(text)
    if len(w) < 50 or 100 * len(inside(w, 3, False)) > 50 * len(w):
        return False
    chars = sum(map(len, w))
    seen, lines, again = set(), 0, []
    for line in (text or "").split("\n"):
        if words(line):
            lines += 1
            if line in seen:
                again.append(line)
            seen.add(line)
    if len(again) > quality.LINE_SHARE * lines or sum(len(x) for a in again for x in words(a)) > quality.LINE_CHAR_SHARE * chars:
        return False
    return all(sum(len(w[j]) for j in inside(w, n, True)) <= share * chars for n, share in quality.NGRAM_LIMITS.items())


def bench_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contaminated(text, bench):
    w, hit = bench_words(text), set()
    for _, item in bench:
        b = bench_words(item)
        size = min(13, len(b))
        grams = {tuple(b[i:i + size]) for i in range(len(b) - size + 1)} if size else set()
        hit |= {j for i in range(len(w) - size + 1) if tuple(w[i:i + size]) in grams for j in range(i, i + size)}
    return bool(hit) and 20 * len(hit) >= len(w)


def literal(rows, bench):
    """(doc_id, text) that the filters keep, with surrogates."""
    rows = [(i, t) for i, t in rows if passes_rules(t)]
    root = {i: c for i, _, c in components(rows)}
    first, left = set(), []
    for i, t in rows:
        if i is None or root[i] == i and i not in first:
            left.append((i, t))
            first.add(i)
    return [(i, pii.replace(t, pii.DEMO_KEY)[0]) for i, t in left if not contaminated(t, bench)]


def pieces(rows):
    import public_tokenizers

    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for i, t in rows:
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, packing.END]
        for piece, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[at:at + packing.CAPACITY]
            out.append((i, piece, at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    return sorted(out, key=repr)


def corpus():
    bench = [("q1", prose(901, 40)), ("q2", "Short item of six words here"), ("q3", None), (None, prose(902, 20)), ("q4", "...")]
    rows = [r for r in edge_docs() if r[0] not in (7, 8)]
    base = [prose(300 + k, 70 + 9 * k, vocabulary=900) for k in range(6)]
    for k, b in enumerate(base):
        rows += [(100 + 10 * k + j, mutated(b, 100 + 10 * k + j, share)) for j, share in enumerate((0, 0, .01, .03, .3))]
    clean = [prose(700 + k, 90, vocabulary=900) for k in range(5)]
    rows += [(200, clean[0] + " " + bench[0][1]), (201, clean[1] + " SHORT item of six, words here " * 2),
             (202, clean[2] + " mail tbopht.05@mail8.example.com or call +1 (386) 555-1832"),
             (203, clean[3] + "\n" + clean[4]), (204, prose(77, 4_000, vocabulary=4_000)),
             (205, "\n".join([clean[0].replace("\n", " ")] * 5))]
    return rows, bench


def written(spark, folder, rows, bench):
    spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "x", "y") for i, t in rows],
                          SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, t, "z") for i, t in bench], "item_id string, text string, n_words string"
                          ).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def placed_well(got):
    """Sequences hold at most CAPACITY tokens, their offsets without gaps."""
    at = defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY


def test_whole_chain(spark, tmp_path):
    rows, bench = corpus()
    got = corpus_pipeline.run(spark, written(spark, tmp_path, rows, bench)).collect()
    kept = literal(rows, bench)
    # the cases do what they are there for
    ids = {i for i, _ in kept}
    assert {100, 104, 202, 203, 204} <= ids and not ids & {101, 102, 200, 205}
    assert "tbopht.05@" not in dict(kept)[202]
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=repr) == pieces(kept)
    placed_well(got)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, None)], [(2, ""), (2, " ")]])
def test_nothing_left(spark, tmp_path, rows):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, rows, [])).count() == 0


def test_stages_keep_columns(spark, tmp_path):
    rows, bench = corpus()
    folder = written(spark, tmp_path, rows, bench)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
