"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded (hashed words and
style), gated attention weighs the passages, and the weighted representation
is scored. Only document labels are learned from, on a bounded sample whose
size is a parameter; the scoring pass covers every whole text without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as tx
from .quality import SYMBOLS, measure

PASSAGE_WORDS = 64
WORD_CELLS = 192
#: Most labelled documents that a model is fitted on.
SAMPLE = 3000
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY = 32, 16, 40, 64, 3e-3, 1e-4
_STYLE_BYTES = (tx.byte_set((65, 90)), tx.byte_set((48, 57)), SYMBOLS, tx.byte_set((0x80, 0xFF)),
                np.isin(np.arange(256), list(b".,;:!?")), np.isin(np.arange(256), list(b"!?")),
                tx.byte_set((97, 122)), np.isin(np.arange(256), list(b"()[]{}_=+-/\\~^`@\"'")))
N_FEATURES = WORD_CELLS + len(_STYLE_BYTES) + 6


def encode(block: tx.Block) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of a block's texts, and each passage's text.
    A text without words is one passage of zeros."""
    words = tx.spans(tx.LOWER[block.data], block.offsets, tx.NOT_SPACE)
    n_words = words.per_doc(block.n)
    n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.cumsum(n_passages) - n_passages
    doc = np.repeat(np.arange(block.n), n_passages)
    within = np.arange(len(words.doc)) - (np.cumsum(n_words) - n_words)[words.doc]
    passage = first[words.doc] + within // PASSAGE_WORDS
    total = len(doc)
    count = np.bincount(passage, minlength=total)
    scale = 1.0 / np.maximum(1, count)
    cell = (words.hash % np.uint64(WORD_CELLS)).astype(np.int64)
    x = np.zeros((total, N_FEATURES), np.float32)
    x[:, :WORD_CELLS] = np.bincount(passage * WORD_CELLS + cell, minlength=total * WORD_CELLS
                                    ).reshape(total, WORD_CELLS) * scale[:, None]
    length = np.bincount(passage, weights=words.end - words.start, minlength=total)
    for k, member in enumerate(_STYLE_BYTES, WORD_CELLS):
        running = np.concatenate([[0], np.cumsum(member[block.data])])
        x[:, k] = np.bincount(passage, weights=running[words.end] - running[words.start], minlength=total
                              ) / np.maximum(1, length)
    found = measure(block, ())
    size = np.maximum(1, found["n_words"])
    order = np.lexsort((words.hash, passage))
    p, h = passage[order], words.hash[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (h[1:] != h[:-1])
    k = WORD_CELLS + len(_STYLE_BYTES)
    x[:, k] = np.bincount(p[new], minlength=total) * scale
    x[:, k + 1] = length * scale / 10
    x[:, k + 2] = np.log1p(count)
    x[:, k + 3] = (np.log1p(found["n_words"]) / 5)[doc]
    x[:, k + 4] = (found["n_repeat_words"] / size)[doc]
    x[:, k + 5] = (found["n_dup_lines"] / np.maximum(1, found["n_lines"]))[doc]
    return x, doc


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    """Passage encoder w, gated attention v and u with weights a, and the score c."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x, first, doc):
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        s = (t * g) @ p["a"]
        s = np.exp(s - np.maximum.reduceat(s, first)[doc])
        weight = s / np.add.reduceat(s, first)[doc]
        bag = np.add.reduceat(weight[:, None] * h, first, axis=0)
        return h, t, g, weight, bag, _sigmoid(bag @ p["c"] + p["c0"][0])

    def gradient(self, x, first, doc, y):
        p = self.p
        h, t, g, weight, bag, out = self.forward(x, first, doc)
        d = (out - y) / len(y)
        d_bag = np.outer(d, p["c"])[doc]
        d_h = weight[:, None] * d_bag
        d_weight = (d_bag * h).sum(1)
        d_s = weight * (d_weight - np.add.reduceat(weight * d_weight, first)[doc])
        d_tg = np.outer(d_s, p["a"])
        d_t, d_g = d_tg * g * (1 - t * t), d_tg * t * g * (1 - g)
        d_h = (d_h + d_t @ p["v"].T + d_g @ p["u"].T) * (1 - h * h)
        return {"w": x.T @ d_h + DECAY * p["w"], "b": d_h.sum(0), "v": h.T @ d_t, "u": h.T @ d_g,
                "a": (t * g).T @ d_s, "c": bag.T @ d + DECAY * p["c"], "c0": np.array([d.sum()])}

    def score(self, x, doc, n):
        if not n:
            return np.zeros(0)
        first = np.searchsorted(doc, np.arange(n))
        return self.forward((x - self.mean) / self.scale, first, doc)[-1]


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Model:
    """Adam over mini-batches of documents; deterministic for one sample."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), every.std(0) + 0.02
    init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    model = Model(mean, scale, {"w": init(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "v": init(HIDDEN, GATE),
                                "u": init(HIDDEN, GATE), "a": init(GATE), "c": init(HIDDEN), "c0": np.zeros(1)})
    bags = [(b - mean) / scale for b in bags]
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    s = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for lo in range(0, len(bags), BATCH):
            pick = order[lo:lo + BATCH]
            size = np.array([len(bags[i]) for i in pick])
            first, doc = np.cumsum(size) - size, np.repeat(np.arange(len(pick)), size)
            grad = model.gradient(np.concatenate([bags[i] for i in pick]), first, doc, labels[pick])
            step += 1
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for k, gk in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * gk
                s[k] = 0.999 * s[k] + 0.001 * gk * gk
                model.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def held_out(id_col: str):
    """The fold that is never learned from: crc32 of the id's text, mod 5, is 0."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` labelled documents outside the held-out fold,
    those of the least id hash. None without a usable label."""
    rows = (tx.pick(labels, id=id_col, y=label_col).filter("id is not null and y in (0, 1)")
            .filter(~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
            .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = tx.pick(docs, id=id_col, text=text_col).join(F.broadcast(rows), "id").select("text", "y")

    def run(block: tx.Block):
        x, doc = encode(block)
        cut = np.searchsorted(doc, np.arange(block.n + 1))
        return tx.record_batch(x=pa.array([x[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary()),
                               y=pa.array([float(v) for v in block.column("y").to_pylist()]))

    got = tx.map_blocks(texts, "text", run, "x binary, y double").orderBy(F.xxhash64("x")).limit(sample).collect()
    if len({r.y for r in got}) < 2:
        return None
    return fit([np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in got], np.array([r.y for r in got]))


def score(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """Score of every row: id, held_out, score, predicted.

    A null or empty text is a bag of one passage without words. Without a
    model every score is 0.5. A null id is not held out. Rows may repeat;
    other columns are not read.
    """
    source = tx.pick(docs, id=id_col, text=text_col)
    id_type = source.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(block: tx.Block):
        m = shared.value
        out = np.full(block.n, 0.5) if m is None else m.score(*encode(block), block.n)
        return tx.record_batch(id=block.column("id"), score=out)

    return (tx.map_blocks(source, "text", run, f"id {id_type}, score double")
            .select(F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
