"""Added tokens of the tokenizer count only as they are written."""

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from retail_insight.llm import packing
from retail_insight.llm import _text as tx


@pytest.mark.parametrize("text", ["a <|ENDOFTEXT|> b", "<|EndOfText|>. <|endoftext|>", "<|STARTOFTEXT|> x", "A1 B-2 IT'S"])
def test_case_of_added_tokens(text):
    import pyarrow as pa

    coder = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    (block,) = tx.blocks(pa.record_batch([pa.array([text])], names=["text"]), "text")
    ids, _ = packing.Tokens(None).encode(block)
    assert np.asarray(ids).tolist() == coder.encode(text, add_special_tokens=False).ids
