"""What the tokenizer's word table holds, and that dropping words changes no ids."""

import pyarrow as pa
import pytest

from retail_insight.llm import _text as tx
from retail_insight.llm import packing


def table(texts):
    return pa.record_batch([pa.array(texts)], names=["text"])


def texts():
    own = [" ".join(f"w{k}x{i} {k * 7919 + i}," for i in range(40)) for k in range(60)]
    return [None, "", "İstanbul, <|endoftext|> Well..", *(f"{t} The same words, again! {t[:20]}" for t in own)]


def test_dropped_words_change_no_ids(monkeypatch):
    rows = texts() * 2
    whole, bounds = packing.Tokens(None).encode(next(tx.blocks(table(rows), "text")))
    monkeypatch.setattr(packing, "CACHE_IDS", 4000)
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    coder, got, most = packing.Tokens(None), [], 0
    for at in range(0, len(rows), 5):
        block = next(tx.blocks(table(rows[at:at + 5]), "text"))
        ids, cut = coder.encode(block)
        got += [ids[a:b].tolist() for a, b in zip(cut, cut[1:])]
        most = max(most, len(coder.ids))
    assert got == [whole[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    # a block's own ids may come on top; the words of all blocks have more
    every = packing.Tokens(None)
    monkeypatch.setattr(packing, "CACHE_IDS", 1 << 30)
    every.encode(next(tx.blocks(table(rows), "text")))
    assert most < 8000 < len(every.ids)


def test_words_of_several_blocks_stay(monkeypatch):
    coder = packing.Tokens(None)
    for k in range(3):
        coder.encode(next(tx.blocks(table([f"often met only{k}"]), "text")))
    asked = []
    words = coder._words
    monkeypatch.setattr(coder, "_words", lambda w: asked.append(sorted(w)) or words(w))
    monkeypatch.setattr(packing, "CACHE_IDS", len(coder.ids) - 1)
    ids, _ = coder.encode(next(tx.blocks(table(["often met only0"]), "text")))
    assert asked == [["only0"]]
    assert ids.tolist() == packing.Tokens(None).encode(next(tx.blocks(table(["often met only0"]), "text")))[0].tolist()


@pytest.mark.parametrize("coded", [1, 300, 1 << 20])
def test_places_do_not_depend_on_how_texts_are_coded(spark, monkeypatch, coded):
    from util import docs_frame

    df = docs_frame(spark, list(enumerate(texts()))).coalesce(1)
    want = packing.pack(df).collect()
    monkeypatch.setattr(packing, "CODED_BYTES", coded)
    assert packing.pack(df).collect() == want
