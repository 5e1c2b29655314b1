"""Paragraph dedup by MinHash banding.

Paragraphs are lines of some length and, if asked for, runs of shorter lines;
single shorter lines are then compared too, by equality. Equal shingle sets are one node;
MinHash bands, tuned so that a pair at the threshold is missed about once in four
thousand, bring similar nodes together, every colliding pair that parity sketches
of both sets allow is compared exactly, and of each connected component only the
first paragraph stays. Colliding groups are first joined as stars, around one node
of each band and then, where groups are large, around others; pairs that the stars
leave in different components are then all compared. If asked for, what stays of long paragraphs is
cut into pieces by content, and runs of pieces that are equal to earlier ones go too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text as tx
from ._components import components
from ._sketch import SKETCH, sketch_of, sketches_allow
from ._stage import staged

MIN_WORDS = 20
SHINGLE = 5
PERCENT = 75
#: Registered query: lines from SHORT_WORDS words are compared, runs of short lines are cut above RUN_WORDS.
SHORT_WORDS, RUN_WORDS = 5, 100
#: Registered query: paragraphs are cut into pieces of this many words and more, after pairs of
#: words whose hash is the least among so many pairs on either side; pieces go where so many words do, side by side.
PIECE_WORDS, REACH, REPEAT_WORDS = 8, 7, 16
#: In a long run a paragraph ends after one word in so many, chosen by the word and the one before it.
CUT_EVERY = 32
BANDS, ROWS = 10, 2      # a pair at 0.75 meets with probability 1 - (1 - 0.75**2)**10 = 0.9997
#: Turns of stars: around the least node of each band, then around so many that are others for each band.
STARS, HUBS = 2, 2
#: All pairs of open groups are compared at once if their join makes at most so many rows for each of theirs.
PAIRS_A_ROW = 128
BITS = tuple(f"bits{i}" for i in range(SKETCH))
#: (id, spans) rows that may be broadcast to fetch texts.
BROADCAST_ROWS = 50_000
_SEEDS = tx.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Paragraphs:
    """Paragraphs of a block, and their shingle sets.

    These are lines with at least ``min_words`` words. With ``run_words`` also runs of
    consecutive shorter lines, up to a blank or a long line, that have ``min_words`` words
    together; a run of more than ``run_words`` words is cut after words chosen by content,
    so that neither the line width nor what stands before a passage moves the cuts.
    ``whole``: each text is one paragraph.
    """

    def __init__(self, block: tx.Block, min_words: int, run_words: int = 0, whole: bool = False):
        data = tx.LOWER[block.data]
        lines = tx.spans(data, block.offsets, ~tx.byte_set() if whole else tx.NOT_NEWLINE, hashed=False)
        words = self.words = tx.spans(data, block.offsets, tx.NOT_SPACE)
        self.lines = lines
        first, end = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
        self.line_words = first, end
        least = max(min_words, SHINGLE)
        long = end - first >= least
        self.start, self.end, self.doc = lines.start[long], lines.end[long], lines.doc[long]
        if run_words:
            runs = self._runs(first, end, long, least, max(run_words, 2 * least))
            order = np.argsort(np.concatenate([self.start, runs[0]]), kind="stable")
            self.start, self.end, self.doc, first, end = (
                np.concatenate(x)[order] for x in zip((self.start, self.end, self.doc, first[long], end[long]), runs))
        else:
            first, end = first[long], end[long]
        self.words_at = first, end
        size = end - first
        line = np.repeat(np.arange(len(size)), size)
        word = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        at, key = tx.windows(words.hash[word], line, SHINGLE)
        at = line[at]
        order = np.lexsort((key, at))
        at, key = at[order], key[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (key[1:] != key[:-1])
        self.line, self.key = at[new], key[new]
        self.n = np.bincount(self.line, minlength=len(size))
        self.first = np.cumsum(self.n) - self.n

    def _runs(self, first, end, long, least, most) -> tuple[np.ndarray, ...]:
        """Runs of short lines: start, end, text, first word, end word."""
        lines, words = self.lines, self.words
        short = (end > first) & ~long
        follows = np.zeros(len(short), bool)
        follows[1:] = short[1:] & short[:-1] & (lines.start[1:] == lines.end[:-1] + 1) & (lines.doc[1:] == lines.doc[:-1])
        head = np.flatnonzero(short & ~follows)
        tail = np.flatnonzero(short & ~np.append(follows[1:], False)) if len(short) else head
        enough = end[tail] - first[head] >= least
        head, tail = head[enough], tail[enough]
        out = []
        for h, t in zip(head.tolist(), tail.tolist()):
            a, z = int(first[h]), int(end[t])
            cuts = [a]
            if z - a > most:
                pair = tx.mix(words.hash[a:z - 1] * np.uint64(3) + words.hash[a + 1:z])
                for c in (a + 2 + np.flatnonzero(pair % np.uint64(CUT_EVERY) == 0)).tolist():
                    if c - cuts[-1] >= least and z - c >= least:
                        cuts.append(c)
            cuts.append(z)
            for lo, hi in zip(cuts, cuts[1:]):
                out.append((lines.start[h] if lo == a else words.start[lo], lines.end[t] if hi == z else words.end[hi - 1],
                            lines.doc[h], lo, hi))
        return tuple(np.array(out, np.int64).reshape(-1, 5).T)

    def short_lines(self, short_words: int, min_words: int) -> tuple[np.ndarray, ...]:
        """Lines of ``short_words`` words and more that are shorter than a paragraph: start, end, text, hash of the words."""
        first, end = self.line_words
        size = end - first
        at = np.flatnonzero((size >= max(short_words, 1)) & (size < max(min_words, SHINGLE)))
        return self.lines.start[at], self.lines.end[at], self.lines.doc[at], self._hashes(first[at], size[at])

    def _hashes(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A hash of each run of ``size`` words from ``first`` on."""
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        value = tx.mix(self.words.hash[np.repeat(first, size) + place] + (place + 1).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        total = np.add.reduceat(value, np.cumsum(size) - size) if len(size) else np.zeros(0, np.uint64)
        return tx.mix(total ^ (size.astype(np.uint64) + np.uint64(0xE7037ED1A0B428DB))).view(np.int64)

    def pieces(self, piece_words: int) -> tuple[np.ndarray, ...]:
        """Paragraphs of two pieces and more, cut by content: start, end, text, hash of the words.

        A piece ends where the next one starts, so pieces that go side by side leave nothing between.
        """
        first, end = self.words_at
        words = self.words
        size = np.where(end - first >= 2 * piece_words, end - first, 0)
        of_word = np.full(len(words.start) + 1, -1)
        of_word[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))] = np.repeat(np.arange(len(size)), size)
        inside = (of_word[:-1] >= 0) & (of_word[:-1] == of_word[1:])
        inside = inside[:-1] if len(inside) else inside
        pair = tx.mix(words.hash[:-1] * np.uint64(3) + words.hash[1:])
        least = inside.copy()
        for k in range(1, REACH + 1):
            other = ~(inside[k:] & inside[:-k])
            least[k:] &= other | (pair[k:] < pair[:-k])
            least[:-k] &= other | (pair[:-k] < pair[k:])
        cut = np.flatnonzero(least) + 1
        paragraph = of_word[cut]
        out = []
        for p in np.unique(paragraph).tolist():
            lo, hi = np.searchsorted(paragraph, (p, p + 1))
            a, z = int(first[p]), int(end[p])
            cuts = [a]
            for c in cut[lo:hi].tolist():
                if c - cuts[-1] >= piece_words and z - c >= piece_words:
                    cuts.append(c)
            cuts.append(z)
            out += [(p, x, y) for x, y in zip(cuts, cuts[1:])] if len(cuts) > 2 else []
        p, x, y = np.array(out, np.int64).reshape(-1, 3).T
        start = np.where(x == first[p], self.start[p], words.start[x])
        stop = np.where(y == end[p], self.end[p], words.start[np.minimum(y, max(len(words.start) - 1, 0))]) if len(p) else x
        return start, stop, self.doc[p], self._hashes(x, y - x)

    def nodes(self) -> np.ndarray:
        if not len(self.n):
            return np.zeros(0, np.int64)
        total = np.add.reduceat(tx.mix(self.key + np.uint64(0x5851F42D4C957F2D)), self.first)
        return tx.mix(total + self.n.astype(np.uint64)).view(np.int64)

    def bands(self) -> np.ndarray:
        """A hash for each paragraph and band."""
        out = np.zeros((len(self.n), BANDS), np.uint64)
        for b in range(BANDS if len(self.n) else 0):
            for r in range(ROWS):
                least = np.minimum.reduceat(tx.mix(self.key ^ _SEEDS[b * ROWS + r]), self.first)
                out[:, b] = out[:, b] * np.uint64(0xD6E8FEB86659FD93) + least
            out[:, b] = tx.mix(out[:, b] + np.uint64(b))
        return out.view(np.int64)


def _signatures(source: DataFrame, min_words: int, short_words: int | None, run_words: int,
                piece_words: int | None) -> DataFrame:
    """One row a paragraph, short line or piece: id, t, lo, hi (bytes in the text), short (all but paragraphs),
    in_text (paragraphs and short lines of its text), node, n, bands and sketch (none where short)."""

    def run(block: tx.Block):
        p = Paragraphs(block, min_words, run_words)
        bands = p.bands()
        start, end, doc, node, n = p.start, p.end, p.doc, p.nodes(), p.n
        if short_words is not None or piece_words is not None:
            more = p.short_lines(short_words, min_words) if piece_words is None else p.pieces(piece_words)
            start, end, doc, node = (np.concatenate(x) for x in zip((start, end, doc, node), more))
            n = np.concatenate([n, np.zeros(len(more[0]), n.dtype)])
        in_text = np.bincount(doc if piece_words is None else p.doc, minlength=block.n)[doc]
        bits = sketch_of(p.line, p.key, len(p.n))
        none = pa.nulls(len(n) - len(p.n), pa.int64())
        banded = np.minimum(np.arange(len(n) + 1, dtype=np.int32), np.int32(len(p.n))) * np.int32(BANDS)
        return tx.record_batch(
            id=block.column("id").to_numpy()[doc], t=block.column("t").to_numpy()[doc],
            lo=(start - block.offsets[doc]).astype(np.int32), hi=(end - block.offsets[doc]).astype(np.int32),
            short=np.arange(len(n)) >= len(p.n), in_text=in_text.astype(np.int32), node=node, n=n.astype(np.int32),
            bands=pa.ListArray.from_arrays(pa.array(banded), pa.array(bands.ravel())),
            **{c: pa.concat_arrays([pa.array(bits[:, k].copy()), none]) for k, c in enumerate(BITS)})

    sketch = "".join(f", {c} long" for c in BITS)
    return staged(tx.map_blocks(source, "text", run, "id long, t long, lo int, hi int, short boolean, in_text int, "
                                f"node long, n int, bands array<long>{sketch}"), "paragraphs")


def _texts(source: DataFrame, where: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, words) of the pairs' nodes, cut from the documents; few documents are broadcast."""
    wanted = (where.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
              .groupBy("id", "t").agg(F.collect_list(F.struct("node", "lo", "hi")).alias("spans")))
    wanted = staged(wanted, "paragraph-wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def run(block: tx.Block):
        node, text = [], []
        for i, spans in enumerate(block.column("spans").to_pylist()):
            raw = block.text_bytes(i)
            node += [s["node"] for s in spans]
            text += [raw[s["lo"]:s["hi"]].decode() for s in spans]
        return tx.record_batch(node=pa.array(node, pa.int64()), text=pa.array(text, pa.string()))

    found = source.join(wanted, ["id", "t"]).select("text", "spans")
    return staged(tx.map_blocks(found, "text", run, "node long, text string").dropDuplicates(["node"]), "paragraph-texts")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for rows in tx.pair_blocks(batch):
                yield _compare(rows, percent)

    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _compare(rows: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    a, b = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    ids, first = np.unique(np.concatenate([a, b]), return_index=True)
    words = rows.column(2).to_pylist() + rows.column(3).to_pylist()
    table = pa.record_batch([pa.array([words[i] for i in first], pa.large_string())], names=["text"])
    sets = []
    for block in tx.blocks(table, "text"):
        p = Paragraphs(block, SHINGLE, whole=True)
        sets += np.split(p.key, p.first[1:])
    good = []
    for k, (i, j) in enumerate(zip(np.searchsorted(ids, a).tolist(), np.searchsorted(ids, b).tolist())):
        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            good.append(k)
    return rows.select(["a", "b"]).take(pa.array(good, pa.int64()))


def _may_link(percent: int):
    """Can the sets of x and y reach the threshold, by their sizes and sketches?"""
    sizes = 100 * F.least("n_x", "n_y").cast("long") >= percent * F.greatest("n_x", "n_y").cast("long")
    return sizes & sketches_allow(percent, "x", "y", BITS, ("n_x", "n_y"))


def _roots(source: DataFrame, paragraphs: DataFrame, percent: int) -> DataFrame:
    """(node, root) of nodes that stand more than once or link with another."""
    first = F.min(F.struct("id", "lo", "hi", "t"))
    nodes = staged(paragraphs.groupBy("node").agg(first.alias("at"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"),
                                                  F.min("bands").alias("bands"), *[F.max(c).alias(c) for c in BITS]), "paragraph-nodes")
    # Only groups of several nodes; a window's one shuffle carries 16 bytes a row.
    group = Window.partitionBy("band")
    band = staged(nodes.select("node", F.explode("bands").alias("band"))
                  .withColumn("hub", F.min("node").over(group)).withColumn("last", F.max("node").over(group))
                  .filter("hub <> last").select("band", "node", "hub"), "paragraph-bands")
    profiles = staged(nodes.join(band.select("node").distinct(), "node", "left_semi")
                      .select("node", "at.id", "at.t", "at.lo", "at.hi", "n", "bands", *BITS), "paragraph-profiles")
    where = profiles.select("node", "id", "t", "lo", "hi")

    def side(name: str, *more: str) -> list:
        return [F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", *BITS, *more)]]

    ends = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    tried = root = None
    for turn in range(STARS + 1):
        all_pairs = turn == STARS
        if turn:
            now = band.join(root, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
            open_ = (now.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("size"))
                     .filter("r0 <> r1").select("band", "size"))
            now = staged(now.join(open_, "band"), "paragraph-open")
            rows, joined = now.agg(F.count(F.lit(1)), F.sum("size")).first()
            if not rows:
                break
            all_pairs = all_pairs or joined <= PAIRS_A_ROW * rows
        if all_pairs:
            of_band = now.join(profiles, "node")
            # a pair leaves the join once, in the first band that both share
            here = F.array_intersect("bands_x", "bands_y")[0] == F.col("band")
            pairs = (of_band.select("band", *side("x", "root", "bands")).join(of_band.select("band", *side("y", "root", "bands")), "band")
                     .filter(F.expr("x < y and root_x <> root_y") & _may_link(percent) & here))
        else:
            if turn:
                ranks = [F.xxhash64("band", "node", F.lit(k)).alias("rank") for k in range(1, HUBS + 1)]
                hubs = now.groupBy("band").agg(F.array(*[F.min(F.struct(r, "node", "root")) for r in ranks]).alias("hubs"))
                others = F.filter("hubs", lambda h: h["root"] != F.col("root"))
                stars = now.join(hubs, "band").select(F.col("node").alias("x"), F.explode(F.transform(others, lambda h: h["node"])).alias("y"))
            else:
                stars = band.filter("node <> hub").select(F.col("node").alias("x"), F.col("hub").alias("y"))
            pairs = (stars.distinct().join(profiles.select(*side("x")), "x").join(profiles.select(*side("y")), "y")
                     .filter(_may_link(percent)))
        pairs = pairs.select(*ends)
        # the least node of a band is on a fixed side, and a pair leaves the other join once
        pairs = pairs if all_pairs or not turn else pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, "paragraph-pairs")
        if root is None or not pairs.isEmpty():
            found = staged(_verified(pairs, _texts(source, where, pairs), percent), "paragraph-links")
            tried = pairs if tried is None else tried.unionByName(pairs)
            if root is None or not found.isEmpty():
                # what is linked so far goes on as stars
                known = found if root is None else found.unionByName(root.select(F.col("node").alias("a"), F.col("root").alias("b")))
                root = staged(components(known, "paragraph-components"), "paragraph-roots")
        if all_pairs:
            break
    return staged(nodes.select("node", "copies").join(root, "node", "left").filter("copies > 1 or root is not null")
                  .select("node", F.coalesce("root", "node").alias("root")), "paragraph-moved")


def _long_runs(raw: bytes, spans: list, least: int) -> list:
    """The spans of ``raw`` without the pieces that have fewer than ``least`` words with the pieces they touch."""
    out, run = [], []
    for s in [*spans, None]:
        if run and (s is None or not s["short"] or s["lo"] != run[-1]["hi"]):
            if len(raw[run[0]["lo"]:run[-1]["hi"]].split()) >= least:
                out += run
            run = []
        if s is not None:
            (run if s["short"] else out).append(s)
    return out


def remove_paragraphs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS, percent: int = PERCENT,
                      short_words: int | None = None, run_words: int = 0,
                      piece_words: int | None = None, repeat_words: int = REPEAT_WORDS) -> DataFrame:
    """Each row without paragraphs that are equal or similar to an earlier one.

    With ``run_words``, consecutive lines below ``min_words`` words are paragraphs
    together, cut by content above ``run_words`` words. With ``short_words``, single
    lines from that many words to below ``min_words`` go too if an equal line (case and
    white space aside) stays earlier; lines that a removed paragraph touches don't count.
    With ``piece_words``, paragraphs of twice as many words and more that stay are cut by
    content into pieces of that many and more, and pieces go likewise where they have
    ``repeat_words`` words with the pieces beside them that go, so a passage inside
    paragraphs that otherwise differ is found. Either of the two may be given.

    Returns id, n_paragraphs (lines of ``min_words`` words and more, runs and short lines),
    n_removed, n_bytes, removed_bytes, first_doc_ids (where the paragraphs
    that stay for the removed ones stand), removed (list of byte spans) and
    kept_text. Of a component the paragraph of the least (id, start) stays. Null
    texts are empty, a null id is smaller than any and stands as null in the
    lists; rows that share an id and a text are one row's copies: all keep
    the paragraph that stays. Ids are integers; an empty table gives no rows.
    """
    if short_words is not None and piece_words is not None:
        raise ValueError("short_words and piece_words overlap: give one of them")
    text = F.coalesce(F.col("text"), F.lit(""))
    source = (tx.pick(docs, id=id_col, text=text_col)
              .select(F.coalesce(F.col("id").cast("long"), F.lit(-2**63)).alias("id"), F.xxhash64(text).alias("t"),
                      text.alias("text")))
    every = _signatures(source, min_words, short_words, run_words, piece_words)
    paragraphs = every.filter("not short")
    # paragraphs that stand once and link with none stay, so only the others are placed
    placed = staged(paragraphs.select("id", "t", "lo", "hi", "short", "node").join(_roots(source, paragraphs, percent), "node"),
                    "paragraph-placed")
    place = F.struct("id", "lo", "t")
    first = staged(placed.groupBy("root").agg(F.min(place).alias("first")), "paragraph-first")
    span = F.struct("lo", "hi", "short", F.col("first.id").alias("first")).alias("span")
    spans = placed.join(first, "root").filter(place != F.col("first")).select("id", "t", span)
    if short_words is not None or piece_words is not None:
        spans = staged(spans, "paragraph-spans")
        lines = every.filter("short").select("id", "t", "lo", "hi", "short", "node")
        # as with paragraphs, those that stand once stay
        twice = staged(lines.groupBy("node").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("node"),
                       "paragraph-twice")
        # A line can only stand for others if it stays: those in removed paragraphs are out first.
        gone = spans.groupBy("id", "t").agg(F.collect_set("span").alias("gone"))
        left = staged(lines.join(twice.hint("shuffle_hash"), "node").join(gone, ["id", "t"], "left")
                      .filter(~F.coalesce(F.exists("gone", lambda s: (s["lo"] < F.col("hi")) & (F.col("lo") < s["hi"])), F.lit(False)))
                      .drop("gone"), "paragraph-lines")
        first = left.groupBy("node").agg(F.min(place).alias("first"))
        again = left.join(first.hint("shuffle_hash"), "node").filter(place != F.col("first"))
        spans = spans.unionByName(again.select("id", "t", span))
    # a piece is part of a paragraph
    counts = (every if piece_words is None else paragraphs).groupBy("id", "t").agg(F.max("in_text").cast("long").alias("n_paragraphs"))
    of_doc = staged(counts.join(spans.groupBy("id", "t").agg(F.collect_set("span").alias("spans")), ["id", "t"], "left"),
                    "paragraph-removals")

    def run(block: tx.Block):
        rows = {k: [] for k in ("n_removed", "n_bytes", "removed_bytes", "first_doc_ids", "removed", "kept_text")}
        for i, spans in enumerate(block.column("spans").to_pylist()):
            raw, out, at, whole = block.text_bytes(i), [], 0, False
            spans = sorted(spans or (), key=lambda s: s["lo"])
            if piece_words is not None:
                spans = _long_runs(raw, spans, repeat_words)
            for s in spans:
                # a line break goes with what stands before it in its line, all of it
                whole = whole and at == s["lo"] or s["lo"] == 0 or raw[s["lo"] - 1:s["lo"]] == b"\n"
                out.append(raw[at:s["lo"]])
                at = s["hi"] + (whole and raw[s["hi"]:s["hi"] + 1] == b"\n")
            kept = b"".join([*out, raw[at:]])
            rows["n_removed"].append(len(spans))
            rows["n_bytes"].append(len(raw))
            rows["removed_bytes"].append(len(raw) - len(kept))
            rows["first_doc_ids"].append(sorted({s["first"] for s in spans}))
            rows["removed"].append([[s["lo"], s["hi"]] for s in spans])
            rows["kept_text"].append(kept.decode())
        return tx.record_batch(
            id=block.column("id"), n_paragraphs=block.column("n_paragraphs"),
            **{k: pa.array(v, pa.list_(pa.int64()) if k == "first_doc_ids" else pa.list_(pa.list_(pa.int64()))
                           if k == "removed" else pa.string() if k == "kept_text" else pa.int64()) for k, v in rows.items()})

    joined = source.join(of_doc, ["id", "t"], "left").withColumn("n_paragraphs", F.coalesce("n_paragraphs", F.lit(0).cast("long")))
    out = tx.map_blocks(joined, "text", run, "id long, n_paragraphs long, n_removed long, n_bytes long, removed_bytes long, "
                        "first_doc_ids array<long>, removed array<array<long>>, kept_text string")
    real = lambda c: F.when(c != -2**63, c)
    return (out.withColumn("id", real(F.col("id"))).withColumn("first_doc_ids", F.transform("first_doc_ids", real))
            .withColumnRenamed("id", id_col))
