"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find, in each whole text, the n-grams
and lines that occur earlier in the same text; a text goes when too large a
share of its characters lies inside them. Texts never meet, so the operator
is one scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _text as tx

#: n-gram length -> largest share of word characters inside repeated n-grams
#: (published Gopher thresholds).
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_SHARE = 0.30        # repeated lines / lines with a word
LINE_CHAR_SHARE = 0.20   # word characters in repeated lines / word characters
MIN_WORDS = 50
BASE_WINDOW = 3
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _covered(later_at: np.ndarray, size: int, n_words: int) -> np.ndarray:
    """Words inside any window of ``size`` words starting at ``later_at``."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, later_at, 1)
    np.add.at(edge, later_at + size, -1)
    return np.cumsum(edge)[:n_words] > 0


def measure(block: tx.Block, lengths) -> dict[str, np.ndarray]:
    """Counts per text of a block; ``dup_chars_<n>`` for each n-gram length."""
    n = block.n
    words = tx.spans(block.data, block.offsets, tx.NOT_SPACE)
    points = tx.code_points(block.data)
    chars = points[words.end] - points[words.start]
    total = lambda mask, weight: np.bincount(
        words.doc, weights=np.where(mask, weight, 0), minlength=n).astype(np.int64)
    every = np.ones(len(words.start), bool)
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[block.data])])
    out = {"n_words": words.per_doc(n), "word_chars": total(every, chars),
           "n_symbols": np.diff(symbols[block.offsets])}

    lines = tx.spans(block.data, block.offsets, tx.NOT_NEWLINE)
    first_word = np.searchsorted(words.start, lines.start)
    end_word = np.searchsorted(words.start, lines.end)
    real = end_word > first_word
    doc_salt = tx.mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    _, later = tx.repeated(lines.hash[real] ^ doc_salt[lines.doc[real]])
    line_doc = lines.doc[real]
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=n)
    running = np.concatenate([[0], np.cumsum(chars)])
    line_chars = running[end_word[real]] - running[first_word[real]]
    out["dup_line_chars"] = np.bincount(line_doc, weights=np.where(later, line_chars, 0),
                                        minlength=n).astype(np.int64)

    at, key = tx.windows(words.hash, words.doc, BASE_WINDOW)
    twice, _ = tx.repeated(key ^ doc_salt[words.doc[at]])
    inside = _covered(at[twice], BASE_WINDOW, len(words.start))
    out["n_repeat_words"] = total(inside, 1)
    # A repeated longer n-gram starts with a repeated 3-word window.
    may = np.zeros(len(words.start), bool)
    may[at[twice]] = True
    for size in lengths:
        at, key = tx.windows(words.hash, words.doc, size)
        if size >= BASE_WINDOW:
            at, key = at[may[at]], key[may[at]]
        _, later = tx.repeated(key ^ doc_salt[words.doc[at]])
        out[f"dup_chars_{size}"] = total(_covered(at[later], size, len(words.start)), chars)
    return out


def verdict(found: dict[str, np.ndarray], limits: Mapping[int, float], min_words: int) -> None:
    """Adds ``base_failed`` and ``kept`` to the measures of :func:`measure`."""
    found["base_failed"] = (found["n_words"] < min_words) | (
        100 * found["n_repeat_words"] > 50 * found["n_words"])
    repetitive = (found["n_dup_lines"] > LINE_SHARE * found["n_lines"]) | (
        found["dup_line_chars"] > LINE_CHAR_SHARE * found["word_chars"])
    for size, share in limits.items():
        repetitive |= found[f"dup_chars_{size}"] > share * found["word_chars"]
    found["kept"] = ~(found["base_failed"] | repetitive)


def repetition_coverage(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                        ngram_limits: Mapping[int, float] | None = None,
                        min_words: int = MIN_WORDS) -> DataFrame:
    """Repetition measures and the verdict for every row of ``docs``.

    Returns id_col and the counts (long), ``base_failed`` and ``kept``. Null
    and empty texts have zero counts and fail the base rule; a null id is
    carried; equal rows give equal rows; an empty table gives none. Columns
    of ``docs`` other than the two named are not read.
    """
    limits = dict(NGRAM_LIMITS if ngram_limits is None else ngram_limits)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
              "dup_line_chars", *[f"dup_chars_{s}" for s in limits]]
    source = tx.pick(docs, id=id_col, text=text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def run(block: tx.Block):
        found = measure(block, list(limits))
        verdict(found, limits, min_words)
        return tx.record_batch(id=block.column("id"), **{k: found[k].astype(np.int64) for k in counts},
                               base_failed=found["base_failed"], kept=found["kept"])

    return tx.map_blocks(source, "text", run, f"id {id_type}, " + ", ".join(f"{k} long" for k in counts)
                         + ", base_failed boolean, kept boolean").withColumnRenamed("id", id_col)


def drop_repetitive(docs: DataFrame, *, text_col: str = "text",
                    ngram_limits: Mapping[int, float] | None = None,
                    min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs``, all their columns, that the rules keep (see
    :func:`repetition_coverage`; rows with a null text go)."""
    limits = dict(NGRAM_LIMITS if ngram_limits is None else ngram_limits)

    def run(block: tx.Block):
        found = measure(block, list(limits))
        verdict(found, limits, min_words)
        return block.rows.filter(pa.array(found["kept"]))

    return tx.map_blocks(docs, text_col, run, docs.schema)
