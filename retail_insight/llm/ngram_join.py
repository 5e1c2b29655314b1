"""N-gram Jaccard join with prefix filters under several global token orders.

A document's set holds the hashes of its distinct five-word shingles. Two sets
whose Jaccard similarity reaches the threshold share a token among the first
few of either (the prefix) under *any* order of all tokens. The first order
puts tokens of frequent cells last, then goes by hash: its prefixes are
joined, so passages that many documents share make few candidates. A pair
leaves that join only if a sketch of both sets allows the threshold: bit i of
a sketch is the parity of the tokens that hash to i, so two sets differ in at
least as many tokens as their sketches in bits. Candidates must then share a
prefix token under each further order; only what passes all filters is joined
with its texts and compared exactly.

Equal sets are one node from the start. The links of a node group are first
sought from its hubs, the nodes whose prefix tokens others share most; what a
few such rounds connect needs no more pairs, and the remaining pairs between
nodes not yet connected are all compared, so that no link between components
is missed. Links go to connected components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import _text as tx
from ._components import components
from ._sketch import CELL_BITS, SKETCH, cells, frequent, sketch_of, sketches_allow
from ._stage import staged

SHINGLE = 5
PERCENT = 75
ORDERS = 3
HUB_ROUNDS = 1
TOKEN_BITS = 48
ROWS_PER_PARTITION = 600_000
SALTS = 64
BITS = tuple(f"bits{i}" for i in range(SKETCH))
#: (node, id) rows of 16 bytes that may be broadcast.
BROADCAST_ROWS = 200_000


def shingles(block: tx.Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of a block's texts, sorted; a text
    of fewer words has its whole sequence as the one."""
    data = tx.LOWER[block.data]
    words = tx.spans(data, block.offsets, tx.NOT_SPACE)
    at, key = tx.windows(words.hash, words.doc, size)
    doc = words.doc[at]
    count = words.per_doc(block.n)
    for k in range(1, size):
        short = np.flatnonzero(count == k)
        if len(short):
            first = np.searchsorted(words.doc, short)
            total = np.zeros(len(short), np.uint64)
            for j in range(k):
                total = total * np.uint64(0xD6E8FEB86659FD93) + words.hash[first + j]
            doc = np.concatenate([doc, short])
            key = np.concatenate([key, tx.mix(total + np.uint64(k))])
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[new], key[new]


def node_of(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(set hash as signed long, set size) of each of ``n`` texts."""
    size = np.bincount(doc, minlength=n)
    total = np.zeros(n, np.uint64)
    if len(doc):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        total[doc[first]] = np.add.reduceat(tx.mix(key + np.uint64(0x5851F42D4C957F2D)), first)
    return tx.mix(total + size.astype(np.uint64)).view(np.int64), size


def prefix_size(n, percent: int):
    """Tokens of a set of ``n`` among which a partner's must show: n - ceil(t n) + 1."""
    return n + (-percent * n // 100) + 1


def similar_enough(a, b, common, percent: int):
    return 100 * common >= percent * (a + b - common)


def _keys(source: DataFrame, size: int, id_type: str) -> tuple[DataFrame, np.ndarray]:
    """(id, node, n, sketch) of every row, and the cells of frequent shingles, in one pass."""
    id_arrow = to_arrow_type(source.schema["id"].dataType)

    def run(batches):
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for block in tx.blocks(batch, "text"):
                doc, key = shingles(block, size)
                counts += np.bincount(cells(key), minlength=len(counts))
                node, n = node_of(doc, key, block.n)
                none = pa.nulls(block.n, pa.int64())
                bits = sketch_of(doc, key, block.n, SKETCH).T.copy()
                yield tx.record_batch(id=block.column("id"), node=node, n=n.astype(np.int64), cell=none, count=none,
                                      **dict(zip(BITS, bits)))
        at = np.flatnonzero(counts)
        none = pa.nulls(len(at), pa.int64())
        yield tx.record_batch(id=pa.nulls(len(at), id_arrow), node=none, n=none,
                              cell=at, count=counts[at], **dict.fromkeys(BITS, none))

    longs = "".join(f", {c} long" for c in ("node", "n", "cell", "count", *BITS))
    both = staged(source.mapInArrow(run, f"id {id_type}{longs}"), "ngram-keys")
    return both.filter("cell is null").drop("cell", "count"), frequent(both.filter("cell is not null"))


def _prefix_rows(source: DataFrame, size: int, percent: int, hot) -> DataFrame:
    """Prefix tokens of every row under the first order: key, node.

    A key is a token's TOKEN_BITS and above them a salt: tokens of frequent
    cells are spread over salts, so none lands in one task.
    """

    def run(block: tx.Block):
        doc, key = shingles(block, size)
        node, n = node_of(doc, key, block.n)
        often = hot.value[cells(key)]
        order = np.lexsort((key, often, doc))
        doc, key, often = doc[order], key[order], often[order]
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        rank = np.arange(len(doc)) - first[doc]
        pick = rank < prefix_size(n, percent)[doc]
        doc, key, often = doc[pick], key[pick], often[pick]
        token = (key >> np.uint64(64 - TOKEN_BITS)).astype(np.int64)
        salt = np.where(often, 1 + (node[doc] % SALTS), 0)
        return tx.record_batch(key=(salt << TOKEN_BITS) + token, node=node[doc])

    return tx.map_blocks(source, "text", run, "key long, node long")


def _shared_tokens(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows of tokens that several nodes hold, each (token, node) once. A salted
    token's rows all stay here: their groups are complete only over the salts."""

    def run(batches):
        got = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not got:
            return
        table = pa.concat_tables(got)
        key, node = (table.column(c).to_numpy() for c in ("key", "node"))
        order = np.lexsort((node, key))
        k, v = key[order], node[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
        k, v = k[new], v[new]
        same_key = k[1:] == k[:-1]
        keep = k >> TOKEN_BITS > 0
        keep[1:] |= same_key
        keep[:-1] |= same_key
        found = tx.record_batch(token=k[keep] & ((1 << TOKEN_BITS) - 1), node=v[keep])
        yield from pa.Table.from_batches([found]).to_batches(max_chunksize=50_000)

    spread = rows.repartition(partitions, "key")
    found = staged(spread.mapInArrow(run, "token long, node long"), "ngram-tokens")
    several = found.groupBy("token").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    return staged(found.join(several, "token"), "ngram-shared")


def _share_further(pairs: DataFrame, nodes: DataFrame, orders: int) -> DataFrame:
    """Pairs that share a prefix token under every further order. ``nodes``: node, order1, ..."""
    for k in range(1, orders):
        def side(name: str) -> DataFrame:
            return nodes.select(F.col("node").alias(name), F.col(f"order{k}").alias(f"p_{name}"))

        pairs = (pairs.join(side("a"), "a").join(side("b"), "b")
                 .filter(F.arrays_overlap("p_a", "p_b")).select("a", "b"))
    return pairs


def _verified(pairs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold. ``nodes``: node, text."""

    def run(batches):
        for batch in batches:
            for rows in tx.pair_blocks(batch):
                yield _compare(rows, size, percent)

    left = pairs.join(nodes.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(nodes.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _compare(rows: pa.RecordBatch, size: int, percent: int) -> pa.RecordBatch:
    a, b = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    ids, first = np.unique(np.concatenate([a, b]), return_index=True)
    texts = rows.column(2).to_pylist() + rows.column(3).to_pylist()
    table = pa.record_batch([pa.array([texts[i] for i in first], pa.large_string())], names=["text"])
    sets = []
    for block in tx.blocks(table, "text"):
        doc, key = shingles(block, size)
        sets += np.split(key, np.searchsorted(doc, np.arange(1, block.n)))
    ia, ib = np.searchsorted(ids, a), np.searchsorted(ids, b)
    good = []
    for k, (i, j) in enumerate(zip(ia.tolist(), ib.tolist())):
        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if similar_enough(len(sets[i]), len(sets[j]), common, percent):
            good.append(k)
    return rows.select(["a", "b"]).take(pa.array(good, pa.int64()))


def _fits(percent: int):
    """Sizes that can reach the threshold at all."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return 100 * small.cast("long") >= percent * large.cast("long")


def _enough_shared(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches allow the threshold and that share enough prefix tokens of the first order.

    Of two prefixes one ends first in the order; all common tokens up to its
    end lie in both, and at most the rest of that set follows. So the common
    tokens are at most those shared plus the larger of the two rests.
    """

    def side(name: str) -> DataFrame:
        return profiles.select(F.col("node").alias(name), F.col("n").cast("long").alias(f"n_{name}"),
                               F.col("tokens").alias(f"t_{name}"),
                               *[F.col(c).alias(f"{c}_{name}") for c in BITS])

    both = (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(sketches_allow(percent, "a", "b", BITS))
            .withColumn("most", F.size(F.array_intersect("t_a", "t_b"))))
    return both.filter(_reaches(F.col("most"), percent)).select("a", "b")


def _reaches(shared, percent: int):
    """Can sets of n_a and n_b tokens that share so many prefix tokens reach the threshold?"""

    def rest(n):        # tokens behind the prefix: ceil(t n) - 1
        up = percent * n.cast("long") + 99
        return (up - up % 100) / 100 - 1

    n_a, n_b = F.col("n_a"), F.col("n_b")
    return (100 + percent) * (shared + F.greatest(rest(n_a), rest(n_b))) >= percent * (n_a + n_b)


def _node_texts(source: DataFrame, ids: DataFrame, pairs: DataFrame, size: int, percent: int,
                orders: int) -> DataFrame:
    """(node, text, order1, ...) of the pairs' nodes: the text, and the prefix under each further
    order as ints (two tokens of one int only let a pair through). A small set of nodes is broadcast, which saves a shuffle of all texts."""
    wanted = staged(ids.select("node", "id").join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi"),
                    "ngram-wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def own(block: tx.Block):
        doc, key = shingles(block, size)
        node, n = node_of(doc, key, block.n)
        columns = {"node": block.column("node"), "text": block.column("text")}
        first = np.concatenate([[0], np.cumsum(n)])
        for k in range(1, orders):
            rank = tx.mix(key + np.uint64(0x2545F4914F6CDD1D * k % 2**64))
            order = np.lexsort((rank, doc))
            pick = np.arange(len(doc)) - first[doc] < prefix_size(n, percent)[doc]
            token = (rank[order][pick] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[pick], minlength=block.n))])
            columns[f"order{k}"] = pa.ListArray.from_arrays(ends.astype(np.int32), token)
        return tx.record_batch(**columns).filter(pa.array(node == block.column("node").to_numpy()))

    texts = source.join(wanted, "id").select("node", "text")
    lists = "".join(f", order{k} array<int>" for k in range(1, orders))
    return tx.map_blocks(texts, "text", own, f"node long, text string{lists}").dropDuplicates(["node"])


def _links(source: DataFrame, keys: DataFrame, hot, *, size: int, percent: int, orders: int,
           hub_rounds: int) -> DataFrame | None:
    """Verified links (a, b) between nodes; with them every similar pair is in one component."""
    spark = source.sparkSession
    total = keys.agg(F.sum(F.col("n") / 4 + 1)).first()[0] or 0
    rows = _prefix_rows(source, size, percent, hot)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total) // ROWS_PER_PARTITION)
    shared = _shared_tokens(rows, partitions)
    if shared.isEmpty():
        return None
    # Hubs: the nodes whose tokens have most holders.
    ids = staged(keys.filter("n > 0 and id is not null").groupBy("node")
                 .agg(F.min("id").alias("id"), F.max("n").cast("int").alias("n"),
                      *[F.max(c).alias(c) for c in BITS]), "ngram-ids")
    tokens = shared.groupBy("node").agg(
        F.sum("holders").alias("score"), F.array_sort(F.collect_list("token")).alias("tokens"))
    profiles = staged(tokens.join(ids.drop("id"), "node"), "ngram-profiles")
    # of a node's shared tokens, how many there are and are left from this one on
    shared = staged(profiles.select("node", "n", "score", F.size("tokens").alias("all"), F.posexplode("tokens"))
                    .select("node", "n", "score", "all", (F.col("all") - F.col("pos")).alias("left"),
                            F.col("col").alias("token")), "ngram-scored")

    links = tried = root = None
    for turn in range(hub_rounds + 1):
        now = shared
        if root is not None:
            now = shared.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
            open_ = (now.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
                     .filter("r0 <> r1").select("token"))
            now = staged(now.join(open_, "token", "left_semi"), "ngram-open")
            if now.isEmpty():
                break
        else:
            now = now.withColumn("root", F.col("node"))
        if turn < hub_rounds:
            hub = now.groupBy("token").agg(F.max(F.struct("score", "node", "n", "root", "all")).alias("h"))
            if turn:    # the best of the components other than the best hub's
                hub = (now.join(hub, "token").filter("root <> h.root").groupBy("token")
                       .agg(F.max(F.struct("score", "node", "n", "root", "all")).alias("h")))
            pairs = (now.join(hub, "token").filter("root <> h.root")
                     .select(F.col("node").alias("x"), F.col("n").alias("n_a"),
                             F.col("h.node").alias("y"), F.col("h.n").alias("n_b"),
                             F.least("all", "h.all").alias("most")))
        else:
            now = now.join(profiles.select("node", *BITS), "node")
            one = now.select("token", F.col("node").alias("x"), F.col("n").alias("n_a"),
                             F.col("root").alias("root_a"), F.col("left").alias("left_a"),
                             *[F.col(c).alias(f"{c}_x") for c in BITS])
            two = now.select("token", F.col("node").alias("y"), F.col("n").alias("n_b"),
                             F.col("root").alias("root_b"), F.col("left").alias("left_b"),
                             *[F.col(c).alias(f"{c}_y") for c in BITS])
            # a pair shares no more tokens than either has left from its first shared one
            pairs = (one.join(two, "token")
                     .filter(F.expr("x < y and root_a <> root_b") & sketches_allow(percent, "x", "y", BITS))
                     .withColumn("most", F.least("left_a", "left_b")))
        pairs = (pairs.filter(_fits(percent) & _reaches(F.col("most"), percent))
                 .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staged(_enough_shared(pairs, profiles, percent), "ngram-pairs")
        nodes = staged(_node_texts(source, ids, pairs, size, percent, orders), "ngram-nodes")
        alike = staged(_share_further(pairs, nodes, orders), "ngram-alike")
        found = staged(_verified(alike, nodes, size, percent), "ngram-links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        # stars of the components found so far stand for the links they came from
        links = found if root is None else found.unionByName(
            root.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        if turn < hub_rounds:
            root = components(links, "ngram-components")
    return links


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       size: int = SHINGLE, percent: int = PERCENT, orders: int = ORDERS,
                       hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """Set size and component of every row of ``docs``: id, n_shingles, component_id.

    Rows link when 100 * common >= percent * union of their shingle sets;
    component_id is the least id reachable. Texts without words (or null)
    link with nothing. Rows that share an id are one document with the links
    of each. A row with a null id has a null component and links nothing. An
    empty table gives no rows. Other columns are not read.
    """
    source = tx.pick(docs, id=id_col, text=text_col)
    keys, often = _keys(source, size, source.schema["id"].dataType.simpleString())
    hot = source.sparkSession.sparkContext.broadcast(often)
    members = keys.filter("n > 0 and id is not null")
    links = _links(source, keys, hot, size=size, percent=percent, orders=orders, hub_rounds=hub_rounds)
    # rows that share an id hold their sets together
    spread = members.groupBy("id").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most")
    same_id = (members.join(spread, "id").filter("node <> least")
               .select(F.col("least").alias("a"), F.col("node").alias("b")))
    links = same_id if links is None else links.unionByName(same_id)
    root = components(links, "ngram-components")
    placed = (members.select("id", "node").distinct().join(root, "node", "left")
              .withColumn("root", F.coalesce("root", "node")).select("id", "node", "root"))
    least = placed.groupBy("root").agg(F.min("id").alias("component"))
    by_node = (placed.select("node", "root").distinct().join(least, "root").select("node", "component"))
    return (keys.withColumn("key", F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("node")))
            .join(by_node.withColumnRenamed("node", "key"), "key", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id")))


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, with the row of the least id of each component only.

    Of rows that share an id one stays if they link; rows with a null id or
    without words all stay. Columns may have any names.
    """
    found = staged(jaccard_components(docs, id_col=id_col, text_col=text_col, **options), "ngram-kept")
    linked = found.filter(F.col(id_col).isNotNull() & (F.col("n_shingles") > 0))
    goes = linked.filter(F.col("component_id") != F.col(id_col)).select(id_col).distinct()
    has_words = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    gone = tx.fresh(docs.columns, "gone")
    left = docs.join(goes.withColumnRenamed(id_col, gone),
                     (F.col(f"`{id_col}`") == F.col(gone)) & has_words, "left_anti")
    twice = linked.groupBy(id_col).agg(F.count(F.lit(1)).alias("several")).filter("several > 1").select(id_col)
    columns = [f"`{c}`" for c in docs.columns]
    repeated = left.join(twice, id_col, "left_semi").select(columns)
    once = repeated.filter(has_words).dropDuplicates([id_col])
    return (left.join(twice, id_col, "left_anti").select(columns)
            .unionByName(once).unionByName(repeated.filter(~has_words)))


def keep_one_of_each_text(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """As :func:`keep_one_of_each`, but only the texts link: rows that share an id are
    documents of their own unless their texts are linked. Of each component the row of the
    least id stays, and of its rows that of the least hash of the text.
    """
    key = F.when(F.col(f"`{id_col}`").isNotNull(), F.struct(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("t")))
    both = tx.fresh(docs.columns, "id_and_text")
    kept = keep_one_of_each(docs.withColumn(both, key), id_col=both, text_col=text_col, **options)
    return kept.select([f"`{c}`" for c in docs.columns])
