"""Cheapest repair of conversations by Four-Russians block tables.

A conversation is to read ``(s?(ua)+)?`` in the initials of its roles. Rows
may be kept (0), given the role user or assistant (3) or deleted (4; blank
and repeated rows must be); empty rows of user or assistant may be inserted
anywhere (3); a truncated row that stays costs 3 more. Each row is one of
nine symbols and the rest of a conversation one vector of four costs, one for
each state that the repaired part may be in.

Inserting joins the states, so the costs of a vector differ by a bounded
amount: less its least cost, a vector is one of a few (``Tables.vectors``).
For every block of BLOCK symbols and every vector behind it a table gives the
vector before it and the cost between: a conversation is read by one lookup a
block, from its last row to its first. Then each block is expanded against
that direction, row by row from its known vector, and traced from the first
row on: taking the least letter among the cheapest edits at each row gives
the ASCII-least trail, ties included.

Conversations are cut into chunks of ``CHUNK_ROWS`` rows. A chunk's map of
vectors is found without knowing its end, and its trail for each state it
may start in, so the chunks of one conversation run in different tasks; only
a few numbers a chunk are passed along the conversation.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._rank import ranked
from ._stage import staged

BLOCK = 4
CHUNK_ROWS = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# States of the repaired part: nothing, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or an assistant row: the one of them that may follow.
_FORCED = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state after keeping a role of this initial (s, u, a, other), if it may follow.
_KEPT = {(EMPTY, 0): SYSTEM, (EMPTY, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
INITIALS = "sua"
#: Symbols: twice the initial's place (others 3), plus 1 if truncated; DROP must go.
DROP = 8
SYMBOLS = 9
LEGAL = ("su", "ua", "au")
_WORD = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def _edits(symbol: int, state: int):
    """(letter, cost, next state) of the edits that consume a row."""
    yield "D", DELETE, state
    if symbol != DROP:
        initial, truncated = divmod(symbol, 2)
        if (state, initial) in _KEPT:
            yield "K", KEEP + TRUNCATED * truncated, _KEPT[state, initial]
        yield "R", REROLE + TRUNCATED * truncated, _FORCED[state]


def _with_inserts(cost: list[int]) -> tuple[int, ...]:
    for _ in range(3):
        cost = [min(c, INSERT + cost[_FORCED[s]]) for s, c in enumerate(cost)]
    return tuple(cost)


def _before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """The costs before a row from those behind it."""
    return _with_inserts([min(w + behind[to] for _, w, to in _edits(symbol, s)) for s in range(4)])


class Tables:
    """Normalised cost vectors, their transitions for single symbols and for blocks, and the edits they imply."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = _with_inserts([0, 99, 99, 0])
        self.vectors, number = [end], {end: 0}
        step, cost = [], []
        for v in self.vectors:          # grows while it is walked
            rows = []
            for symbol in range(SYMBOLS):
                raw = _before(symbol, v)
                least = min(raw)
                normal = tuple(c - least for c in raw)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                rows.append((number[normal], least))
            step.append([n for n, _ in rows])
            cost.append([c for _, c in rows])
        self.step, self.cost = np.array(step, np.int16).T, np.array(cost, np.int32).T      # [symbol, vector]
        self.moves = [[[self._move(symbol, v, s) for s in range(4)] for v in range(len(self.vectors))]
                      for symbol in range(SYMBOLS)]
        # blocks: the first symbol is the highest digit, and the last to be read
        self.block_step, self.block_cost = self.step, self.cost
        for _ in range(block - 1):
            behind, paid = self.block_step, self.block_cost
            self.block_step = np.concatenate([self.step[c][behind] for c in range(SYMBOLS)])
            self.block_cost = np.concatenate([paid + self.cost[c][behind] for c in range(SYMBOLS)])
        self.places = SYMBOLS ** np.arange(block - 1, -1, -1)

    def _move(self, symbol: int, behind: int, state: int) -> tuple[str, int]:
        """The least letters that take the row at least cost, and the state after them."""
        raw, after, letters = _before(symbol, self.vectors[behind]), self.vectors[behind], ""
        while True:
            options = [(letter, to) for letter, w, to in _edits(symbol, state) if w + after[to] == raw[state]]
            if INSERT + raw[_FORCED[state]] == raw[state]:
                options.append(("I", _FORCED[state]))
            letter, state = min(options)
            letters += letter
            if letter != "I":
                return letters, state

    def cut(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whole blocks as numbers, the symbols left over at the end)."""
        whole = len(symbols) // self.block * self.block
        return symbols[:whole].reshape(-1, self.block) @ self.places, symbols[whole:]

    def read(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind the symbols, the vector before them and the cost between."""
        numbers, left = self.cut(symbols)
        at = np.arange(len(self.vectors))
        paid = np.zeros(len(at), np.int64)
        for symbol in left[::-1]:
            paid += self.cost[symbol][at]
            at = self.step[symbol][at]
        for number in numbers[::-1]:
            paid += self.block_cost[number][at]
            at = self.block_step[number][at]
        return at, paid

    def behind(self, symbols: np.ndarray, end: int) -> list[int]:
        """The vector behind each symbol: block ends by lookup, then each block expanded."""
        numbers, left = self.cut(symbols)
        ends, at = [], end
        for symbol in left[::-1]:
            at = self.step[symbol, at]
        for number in numbers[::-1]:
            ends.append(at)
            at = self.block_step[number, at]
        out = np.zeros(len(symbols), np.int64)
        for start, size, at in [(i * self.block, self.block, e) for i, e in enumerate(reversed(ends))] + [
                (len(symbols) - len(left), len(left), end)]:
            for i in range(start + size - 1, start - 1, -1):
                out[i] = at
                at = self.step[symbols[i], at]
        return out.tolist()

    def trace(self, symbols: np.ndarray, behind: list[int], state: int, last: bool) -> tuple[str, int]:
        """The ASCII-least cheapest trail from ``state``, and the state it ends in."""
        letters = []
        for symbol, v in zip(symbols.tolist(), behind):
            move, state = self.moves[symbol][v][state]
            letters.append(move)
        while last and state not in (EMPTY, ASSISTANT):
            letters.append("I")
            state = _FORCED[state]
        return "".join(letters), state


@lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def _symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8).astype(np.int64) - ord("0")


def _illegal(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


def apply_trail(trail: str, symbols: str, state: int) -> list[tuple[list[str], str, str | None]]:
    """For each row of a trail, and the place behind the last: roles inserted before it, its letter, the role given."""
    out, inserted, left = [], [], iter(symbols)
    for letter in trail:
        if letter == "I":
            state = _FORCED[state]
            inserted.append(_ROLE[state])
            continue
        symbol = int(next(left))
        if letter == "R":
            state = _FORCED[state]
        elif letter == "K":
            state = _KEPT[state, symbol // 2]
        out.append((inserted, letter, _ROLE[state] if letter == "R" else None))
        inserted = []
    return [*out, (inserted, "", None)]


# -- the operator ------------------------------------------------------------
def _classified(rows: DataFrame, name: str) -> DataFrame:
    """Rows (key, conv, turn, role, text) with pos, n, fault and the initial's class."""
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    numbered = staged(ranked(staged(numbered, f"{name}-rows"), ["key"], ["turn", "role", "text", "row"], f"{name}-ranges"),
                      f"{name}-ranked")
    blank = ~F.col("text").rlike(_WORD)
    said = F.sha2("text", 256).alias("said")
    first = (numbered.filter(~blank).select("key", "role", said, "pos").groupBy("key", "role", "said")
             .agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("is_first")))
    fault = (F.when(blank, "blank").when(F.col("is_first").isNull(), "duplicate")
             .when(~F.col("text").rlike(_ENDED), "truncated"))
    initial = F.substring("role", 1, 1)
    return (numbered.join(first, ["key", "pos"], "left").withColumn("fault", fault)
            .withColumn("initial", F.when(initial.isin(*INITIALS), initial).otherwise("-")).drop("is_first", "row"))


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """(key, chunk, last, symbols, initials): one row for each run of ``chunk_rows`` rows."""
    place = F.instr(F.lit(INITIALS), F.col("initial"))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), DROP).otherwise(
        2 * F.when(place > 0, place - 1).otherwise(len(INITIALS)) + F.when(F.col("fault") == "truncated", 1).otherwise(0))
    light = rows.select("key", F.floor(F.col("pos") / chunk_rows).cast("long").alias("chunk"), "pos", "n",
                        symbol.cast("string").alias("symbol"), "initial")
    whole = light.groupBy("key", "chunk").agg(F.max("n").alias("n"),
                                              F.array_sort(F.collect_list(F.struct("pos", "symbol", "initial"))).alias("r"))
    return whole.select("key", "chunk", ((F.col("chunk") + 1) * chunk_rows >= F.col("n")).alias("last"),
                        F.array_join("r.symbol", "").alias("symbols"), F.array_join("r.initial", "").alias("initials"))


def _table(rows: list[tuple], names: str, types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types)], names=names.split())


def _read_chunks(chunks: DataFrame, block: int) -> DataFrame:
    """Each chunk with its map of vectors (before, paid) and the illegal pairs inside it."""

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                before, paid = tables(block).read(_symbols(r["symbols"]))
                rows.append((r["key"], r["chunk"], r["last"], r["symbols"], r["initials"][0], r["initials"][-1],
                             _illegal(r["initials"]), before.tolist(), paid.tolist()))
            yield _table(rows, "key chunk last symbols head tail illegal before paid",
                         [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(),
                          pa.list_(pa.int16()), pa.list_(pa.int64())])

    return chunks.mapInArrow(run, "key string, chunk long, last boolean, symbols string, head string, tail string, "
                                  "illegal long, before array<smallint>, paid array<long>")


def _walk_back(chunks: DataFrame, block: int) -> DataFrame:
    """Along each conversation from its end: the vector behind each chunk; costs and illegal pairs so far."""

    def run(batches):
        key, vector, paid, head, illegal = None, 0, 0, "", 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["key"] != key:
                    key, vector, paid, head, illegal = r["key"], 0, 0, "", 0
                illegal += r["illegal"] + (_illegal(r["tail"] + head) if head else 0)
                end, head = vector, r["head"]
                paid += r["paid"][vector]
                vector = r["before"][vector]
                total = paid + tables(block).vectors[vector][EMPTY]
                rows.append((key, r["chunk"], r["last"], r["symbols"], end, total, illegal))
            yield _table(rows, "key chunk last symbols end cost illegal", [
                pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int64()])

    ordered = chunks.repartition("key").sortWithinPartitions("key", F.col("chunk").desc())
    return ordered.mapInArrow(run, "key string, chunk long, last boolean, symbols string, end long, cost long, illegal long")


def _trace_chunks(chunks: DataFrame, block: int) -> DataFrame:
    """Each chunk's trail and last state for every state it may start in (the first chunk: nothing so far)."""

    def run(batches):
        t = tables(block)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                symbols = _symbols(r["symbols"])
                behind = t.behind(symbols, r["end"])
                found = [t.trace(symbols, behind, s, r["last"]) for s in (range(4) if r["chunk"] else (EMPTY,))]
                rows.append((r["key"], r["chunk"], r["symbols"], [f[0] for f in found], [f[1] for f in found]))
            yield _table(rows, "key chunk symbols trails states", [
                pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())])

    return (chunks.repartition("key", "chunk").select("key", "chunk", "last", "symbols", "end")
            .mapInArrow(run, "key string, chunk long, symbols string, trails array<string>, states array<long>"))


def _walk_on(traced: DataFrame) -> DataFrame:
    """Along each conversation from its start: the state each chunk starts in, and its trail from there."""

    def run(batches):
        key, state = None, EMPTY
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["key"] != key:
                    key, state = r["key"], EMPTY
                rows.append((key, r["chunk"], r["symbols"], state, r["trails"][state]))
                state = r["states"][state]
            yield _table(rows, "key chunk symbols state trail", [
                pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()])

    ordered = traced.repartition("key").sortWithinPartitions("key", "chunk")
    return ordered.mapInArrow(run, "key string, chunk long, symbols string, state long, trail string")


def _row_edits(trails: DataFrame, chunk_rows: int) -> DataFrame:
    """(key, pos, inserted, letter, given) of every row, and of the place behind the last row."""

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                for i, (inserted, letter, given) in enumerate(apply_trail(r["trail"], r["symbols"], r["state"])):
                    if letter or inserted:
                        rows.append((r["key"], r["chunk"] * chunk_rows + i, inserted, letter, given))
            yield _table(rows, "key pos inserted letter given", [pa.string(), pa.int64(), pa.list_(pa.string()),
                                                                  pa.string(), pa.string()])

    return trails.repartition("key", "chunk").mapInArrow(
        run, "key string, pos long, inserted array<string>, letter string, given string")


def key_of(column: str) -> Column:
    """A conversation id as a string without nulls."""
    value = F.col(f"`{column}`").cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.lit("="), value))


def repair(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", block: int = BLOCK, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(report, repaired): what is wrong with each conversation, and its rows after the cheapest edits.

    report: key, conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit. repaired: key, conv_id, pos, at, role, text, in the order of (pos, at);
    inserted rows have an empty text.

    Rows go by turn, nulls first; rows of one turn by role, then text. A null
    role or text reads as one space. A row's first fault counts: blank,
    duplicate (role and text seen earlier), truncated (the last character but
    white space is none of ``.!?``). Null ids are one conversation. An empty
    table gives two empty tables. Other columns are not read.
    """
    space = F.lit(" ")
    rows = conversations.select(
        key_of(conv_col).alias("key"), F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), space).alias("role"), F.coalesce(F.col(f"`{text_col}`"), space).alias("text"))
    rows = staged(_classified(rows, "repair"), "repair-classified")
    read = staged(_read_chunks(_chunks(rows, chunk_rows), block), "repair-read")
    back = staged(_walk_back(read, block), "repair-back")
    trails = staged(_walk_on(_trace_chunks(back, block)), "repair-trails")

    def faults(kind: str) -> Column:
        return F.count(F.when(F.col("fault") == kind, 1)).alias(kind)

    turns = (rows.groupBy("key", "turn").agg(F.first("conv").alias("conv"), *[faults(k) for k in ("blank", "duplicate", "truncated")])
             .groupBy("key").agg(F.first("conv").alias("conv"),
                                 F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
                                 *[F.sum(k).cast("long").alias(k) for k in ("blank", "duplicate", "truncated")]))
    found = back.filter("chunk = 0").select("key", "illegal", "cost")
    audit = trails.groupBy("key").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "trail"))), lambda c: c["trail"]), "").alias("audit"))
    report = (turns.join(found, "key").join(audit, "key")
              .select("key", F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))

    edits = _row_edits(trails, chunk_rows)
    line = "struct<role:string,text:string>"
    added = F.transform("inserted", lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    own = F.when(F.col("letter").isin("K", "R"), F.array(F.struct(
        F.coalesce("given", "role").alias("role"), F.col("text").alias("text")))).otherwise(F.array().cast(f"array<{line}>"))
    lines = edits.join(rows.select("key", "pos", "role", "text"), ["key", "pos"], "left")
    repaired = (lines.select("key", "pos", F.posexplode(F.concat(added.cast(f"array<{line}>"), own)).alias("at", "line"))
                .select("key", "pos", "at", "line.role", "line.text"))
    return report, repaired


def repaired_digest(repaired: DataFrame) -> DataFrame:
    """(key, repaired_sha256): of each conversation's ``role:text`` lines, joined by newlines.

    A digest takes its input in order, so each conversation runs through one
    task; its rows pass one at a time and are not kept.
    """

    def run(batches):
        key, digest = None, None
        for batch in batches:
            rows = []
            for k, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if k != key:
                    if digest:
                        rows.append((key, digest.hexdigest()))
                    key, digest = k, sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield _table(rows, "key repaired_sha256", [pa.string(), pa.string()])
        if digest:
            yield _table([(key, digest.hexdigest())], "key repaired_sha256", [pa.string(), pa.string()])

    ordered = repaired.repartition("key").sortWithinPartitions("key", "pos", "at")
    return ordered.select("key", "role", "text").mapInArrow(run, "key string, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """The conversations with faults put in by crc32(``conv_id:turn``) % 20, nulls read as one space:
    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                                F.coalesce("text", space).alias("text"))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.withColumn("kind", kind).filter("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), copies.alias("copy")).drop("copy"))


def damaged_and_repaired(conversations: DataFrame, **options) -> DataFrame:
    """The registered query: every conv_id with the report on its damaged rows and the digest of their repair."""
    report, repaired = repair(damage(conversations), **options)
    nothing = sha256(b"").hexdigest()
    all_ids = conversations.groupBy(key_of("conv_id").alias("key")).agg(F.first("conv_id").alias("conv_id"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (all_ids.join(report.drop("conv_id"), "key", "left").join(repaired_digest(repaired), "key", "left")
            .select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))
