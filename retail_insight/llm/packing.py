"""Bounded-space online best-fit packing of tokenised documents.

Each task tokenises its documents and packs the pieces as they come: a fixed
number of sequences is open, a bitset keyed by free space finds the one a
piece fits best, and when another must be opened the fullest closes first.
A piece's place never changes, so nothing is shuffled or held back; a task
remembers the open sequences' free space and a bounded table of words only.
Of that table the words that come again stay when it is full.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import _text as tx

CAPACITY = 2048
OPEN_SEQUENCES = 512
END = 0
#: What a worker remembers before it drops words met once: ids, and words of letters.
CACHE_IDS = 3_000_000
CACHE_WORDS = 100_000
#: Words that the tokenizer gets at once: it holds some hundred bytes for each id until they are read.
CALL_WORDS = 500
#: Pieces are placed together by the first, texts are coded together by the second.
BLOCK_BYTES, CODED_BYTES = 4 << 20, 512 << 10
_TAILS = (".", ",", "!!", "!", "?", ";", ":", "###", "***", "$$$", "%%%", "&&&", ".,", "!!,")
_IN_WORD = ~tx.byte_set((0x20, 0x20), (0x0A, 0x0A))


class Tokens:
    """Ids of whole texts. White space separates words for this vocabulary and
    is dropped, so ids are found word by word: a block's words are hashed and
    made distinct, and only those not met before go through the tokenizer."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.letters: dict[str, bytes] = {"": b""}
        self.hash = np.zeros(0, np.uint64)      # sorted; with the place of each word's ids
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.met = np.zeros(0, np.int32)        # blocks that hold the word, since words were last dropped
        self.ids = np.zeros(0, "<u4")

    def _drop_rare(self):
        """Words of several blocks stay, unless their ids alone take half the room."""
        stays = self.met > 1
        if 2 * int(self.length[stays].sum()) > CACHE_IDS:
            stays[:] = False
        length = self.length[stays]
        start = np.cumsum(length) - length
        self.ids = self.ids[np.repeat(self.start[stays] - start, length) + np.arange(int(length.sum()))]
        self.hash, self.start, self.length = self.hash[stays], start, length
        self.met = np.zeros(len(start), np.int32)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for at in range(0, len(texts), CALL_WORDS)
                for e in self.tokenizer.encode_batch_fast(texts[at:at + CALL_WORDS], add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only, coded together: each ends in one word-end id."""
        data = b"".join(self._ids([" ".join(words[at:at + CALL_WORDS])])[0] for at in range(0, len(words), CALL_WORDS))
        cut = np.flatnonzero(self.ends_word[np.frombuffer(data, "<u4")]) + 1
        if len(cut) != len(words):
            return self._ids(words)
        at = [0, *(4 * cut).tolist()]
        return [data[i:j] for i, j in zip(at, at[1:])]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space; letters are coded apart from the signs behind them."""
        if len(self.letters) > CACHE_WORDS:
            self.letters = {"": b""}
        known, parts = self.letters, []
        for w in words:
            core, tail = w, ""
            if not w.isalpha():
                for t in _TAILS:     # letters and ASCII signs never join into one piece
                    if w.endswith(t) and w[:-len(t)].isalpha():
                        core, tail = w[:-len(t)], t
                        break
            if "\u0130" in core:     # the one letter whose lower case ends in a mark
                core, tail = w, ""
            elif core.isascii() and core.isalpha():    # added tokens are matched as they are written
                core = core.lower()
            parts.append((core, tail))
        wanted = {x for pair in parts for x in pair}.difference(known)
        first = [w for w in wanted if w.isalpha() and "\u0130" not in w]
        rest = list(wanted.difference(first))
        known.update(zip(first, self._letters(first)))
        # Signs and numbers in words rarely come again; the tails do.
        own = dict(zip(rest, self._ids(rest)))
        known.update((t, own[t]) for t in _TAILS if t in own)
        return [(own[core] if core in own else known[core]) + known[tail] for core, tail in parts]

    def encode(self, block: tx.Block) -> tuple[np.ndarray, np.ndarray]:
        """Unsigned 32-bit ids of a block's texts end to end, and where each text's begin."""
        words = tx.spans(block.data, block.offsets, _IN_WORD)
        hashes, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.ids) > CACHE_IDS:
            self._drop_rare()
        new = ~np.isin(hashes, self.hash, assume_unique=True)
        raw = block.data.tobytes()
        at = first[new]
        coded = self._words([raw[i:j].decode() for i, j in zip(words.start[at].tolist(), words.end[at].tolist())])
        length = np.array([len(c) // 4 for c in coded], np.int64)
        start = len(self.ids) + np.cumsum(length) - length
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(coded), "<u4")])
        merged = np.concatenate([self.hash, hashes[new]])
        order = np.argsort(merged, kind="stable")
        self.hash = merged[order]
        self.start = np.concatenate([self.start, start])[order]
        self.length = np.concatenate([self.length, length])[order]
        self.met = np.concatenate([self.met, np.zeros(len(length), np.int32)])[order]
        entry = np.searchsorted(self.hash, hashes)
        self.met[entry] += 1
        entry = entry[which]
        length = self.length[entry]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        out = self.ids[np.repeat(self.start[entry] - (ends - length), length) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(words.doc, np.arange(block.n + 1))]
        return out, bounds


_loaded: dict[str | None, Tokens] = {}


def tokens(path: str | None) -> Tokens:
    """One per worker process, which Spark uses for many tasks."""
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]


class BestFit:
    """A fixed number of open bins in a bitset keyed by free space."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.open = 0
        self.opened = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        return number

    def put(self, size: int) -> tuple[int, int]:
        """(bin, offset) of a piece of ``size``, 1 to capacity."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if size < self.capacity:
                if self.open == self.most:      # the fullest closes first
                    self._take((self.bits & -self.bits).bit_length() - 1)
                    self.open -= 1
                self.open += 1
            number, free = self.opened, self.capacity
            self.opened += 1
        left = free - size
        if left:
            self.by_free[left].append(number)
            self.bits |= 1 << left
        elif free < self.capacity:
            self.open -= 1
        return number, self.capacity - free


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, open_sequences: int = OPEN_SEQUENCES) -> DataFrame:
    """Pieces of every row of ``docs``, each with its place in a sequence.

    A row's ids are its text's (null: none) and the end id; only a longer one
    is cut, into pieces of ``capacity``. Rows of equal id are packed each on
    its own. sequence_id is unique over all tasks; offsets run from 0 without
    gaps. An empty table gives no rows. Other columns are not read.
    """
    source = tx.pick(docs, id=id_col, text=text_col)
    id_type = source.schema["id"].dataType.simpleString()
    names = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")

    def run(batches):
        coder, bins = tokens(tokenizer), BestFit(capacity, open_sequences)
        base = TaskContext.get().partitionId() << 36
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for block in tx.blocks(batch, "text", BLOCK_BYTES):
                row, values, i = [], [], 0
                for coded in tx.blocks(block.rows, "text", CODED_BYTES):
                    stream, bounds = coder.encode(coded)
                    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                        ids = stream[a:b].tobytes() + end
                        for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                            part = ids[at:at + 4 * capacity]
                            row.append(i)
                            values.append((piece, at // 4, len(part) // 4, zlib.crc32(part)))
                        i += 1
                # Pieces that arrived together are placed longest first.
                length = np.array([v[2] for v in values])
                placed = [None] * len(values)
                for k in np.argsort(-length, kind="stable").tolist():
                    number, offset = bins.put(int(length[k]))
                    placed[k] = (base + number, offset)
                columns = list(zip(*[(*v, *p) for v, p in zip(values, placed)]))
                yield pa.RecordBatch.from_arrays(
                    [block.column("id").take(pa.array(row)),
                     *[pa.array(c, pa.int32() if n == "piece" else pa.int64()) for n, c in zip(names, columns)]],
                    names=["id", *names])

    return source.mapInArrow(run, f"id {id_type}, piece int, start long, length long, ids_crc32 long, "
                             "sequence_id long, offset long").withColumnRenamed("id", id_col)
