"""Near duplicates by a chosen-path similarity join over word shingles.

Every tree sends a document down a path: a node's own hash function selects the document's minwise token,
and that token names the child.  Documents that share a node after ``SHALLOW`` choices are compared there if
they are few; a larger node goes on branching to ``DEEP`` choices first.  Two sets with Jaccard similarity s
share a node of one tree with probability s ** depth, and ``TREES`` independent trees bring the chance to
miss a pair at 0.85 to about 3e-7 in small nodes and 1e-4 in deep ones (less where a group has more than one
link).  Every link is confirmed on the full sets.

A deep node in which more than ``BLOCK`` documents are outside its largest class (texts that share boilerplate
but are not linked) is a crowd.  Its documents branch again in new trees, to the depths of ``CROWD_DEPTHS`` in
turn, as many trees as keep the chance to miss a link at ``MISS``.  What is still a crowd at the last depth is
compared as pairs of blocks: a task holds two blocks at most, and no pair is compared twice in a node.

What is linked are distinct sets, named by a hash of their sums, not doc_ids: texts with equal sets are one
node of the graph, so exact copies never meet, and rows with a null doc_id or with another text under the same
doc_id take part like all others.  A class takes its least non-null id.

Null, empty and blank texts have an empty set, are linked with nothing and keep themselves.  Repeated rows
share a class.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom.llm import _bytes as tb
from delayloom.llm._graph import components
from delayloom.llm._spark import REST, arrow_batches, grouped, packed, parts_for, stored, unpacked

SHINGLE_WORDS = 5
#: Link when 100 * intersection >= MIN_PERCENT * union.
MIN_PERCENT = 85
TREES = 16
FIRST_TREES = 4
SHALLOW, DEEP = 3, 5
SMALL_NODE = 64
#: Instead of a side: all pairs of a task are compared.
ALL_PAIRS = 2
#: Documents of one node that are compared in one task at once (two blocks where a node is larger).
BLOCK = 2000
#: Choices in the trees for the documents of crowds, and the chance to miss a link that their number allows.
CROWD_DEPTHS = (8, 12, 16)
MISS = 1e-4

#: Parts that the rows of a set or class are dealt over where its leader is joined.
SALTS = 16

_WORD_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS, values: np.ndarray = tb.LOWER_VALUES
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and their numbers.

    A text with fewer words than ``size`` has its whole word sequence as its only shingle.
    """
    starts, ends, counts = tb.words(data, offsets)
    hashes = tb.stretch_hashes(tb.prefix_sums(data, values), starts, ends)
    firsts = tb.run_starts(counts)
    long = counts >= size
    windows = np.where(long, counts - size + 1, (counts > 0).astype(counts.dtype))
    at = tb.expand(firsts, windows)
    shingles = np.zeros(len(at), dtype=np.uint64)
    whole = np.repeat(long, windows)
    padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
    have = np.repeat(counts, windows)
    for k in range(size):
        word = padded[at + k]
        shingles = shingles * _WORD_STEP + np.where(whole | (k < have), word, np.uint64(0))
    shingles = tb.mix(shingles ^ np.where(whole, size, have).astype(np.uint64))
    out, sizes, place = [], np.zeros(len(counts), dtype=np.int64), 0
    for row, count in enumerate(windows.tolist()):
        if count:
            own = np.unique(shingles[place : place + count])
            out.append(own)
            sizes[row] = len(own)
            place += count
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), sizes


def _paths(
    sets: np.ndarray, sizes: np.ndarray, trees: int, depths: tuple[int, ...] = (SHALLOW, DEEP), first: int = 1
) -> np.ndarray:
    """Node after each number of choices in every tree, for each non-empty set: (trees, depths, sets)."""
    starts = tb.run_starts(sizes)
    out = np.zeros((trees, len(depths), len(sizes)), dtype=np.uint64)
    if not len(sizes):
        return out
    for tree in range(trees):
        node = np.full(len(sizes), tb.mix(np.array([tree + first], dtype=np.uint64))[0])
        for depth in range(1, depths[-1] + 1):
            ranks = sets ^ np.repeat(node, sizes)
            ranks *= tb._MIX_A
            ranks ^= ranks >> np.uint64(32)
            ranks *= tb._MIX_B
            chosen = np.minimum.reduceat(ranks, starts)
            node = tb.mix(node * _WORD_STEP + chosen + np.uint64(depth))
            if depth in depths:
                out[tree, depths.index(depth)] = node
    return out


def _signatures(trees: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.text_bytes(batch.column("text"))
            for low, high in tb.steps(offsets):
                sets, sizes = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)
                full = sizes > 0
                sums = np.zeros((2, len(sizes)), dtype=np.uint64)
                nodes = np.zeros((len(sizes), 2 * trees), dtype=np.int64)
                if full.any():
                    starts = tb.run_starts(sizes[full])
                    sums[0, full] = np.add.reduceat(sets, starts)
                    sums[1, full] = np.add.reduceat(tb.mix(sets), starts)
                    found = _paths(sets, sizes[full], trees)
                    nodes[full] = found.reshape(2 * trees, -1).T.view(np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * (2 * trees)), pa.array(nodes.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), batch.column("mark").slice(low, high - low), pa.array(sizes),
                     pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), lists],
                    names=["doc_id", "mark", "n_shingles", "sum_a", "sum_b", "nodes"],
                )

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.text_bytes(batch.column("text"))
            for low, high in tb.steps(offsets):
                sets, sizes = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)
                edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
                blobs = [sets[a:b].tobytes() for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(low, high - low), pa.array(blobs, pa.binary())], names=["doc", "tokens"]
                )

    return run


def _crowd_paths(trees: int, depth: int):
    """Nodes of sets after ``depth`` choices, in trees that no other depth uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("tokens").to_pylist()
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64)
            for low, high in tb.steps(offsets):
                sets = np.frombuffer(b"".join(blobs[low:high]), dtype=np.uint64)
                found = _paths(sets, np.diff(offsets[low : high + 1]) // 8, trees, (depth,), depth << 20)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(trees, dtype=np.int32), high - low)),
                     pa.array(found[:, 0].T.ravel().view(np.int64)),
                     batch.column("doc").slice(low, high - low).take(pa.array(np.repeat(np.arange(high - low), trees)))],
                    names=["tree", "node", "doc"])

    return run


def linked_in_node(
    docs: np.ndarray, classes: np.ndarray, sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that join the classes of one node's documents: all pairs of different classes are decided.

    A document is held against all others at once (a mark on its tokens, then a sum over each set).  Pairs
    already in one class need no comparison, so a node of near copies ends after a few rounds.  With ``sides``
    (0 or 1), only pairs of documents on different sides are decided.
    """
    if sides is not None:
        order = np.argsort(sides, kind="stable")
        cut = int((sides == 0).sum())
        if not 0 < cut < len(sides):
            return []
        if 2 * cut > len(sides):  # the smaller side is marked, the larger one summed
            order, cut = np.roll(order, -cut), len(sides) - cut
        docs, classes, sets = docs[order], classes[order], [sets[k] for k in order.tolist()]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    tokens, local = np.unique(np.concatenate(sets), return_inverse=True)
    starts = tb.run_starts(sizes)
    _, group = np.unique(classes, return_inverse=True)
    links: list[tuple[int, int]] = []
    mark = np.zeros(len(tokens), dtype=np.int32)
    far = 0 if sides is None else cut
    held, held_starts, held_sizes = local[starts[far] :], starts[far:] - starts[far], sizes[far:]
    for i in np.argsort(-sizes[: cut if far else None], kind="stable").tolist():
        other = group[far:] != group[i]
        if not other.any():
            continue
        own = local[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        shared = np.add.reduceat(mark[held], held_starts)
        mark[own] = 0
        for j in (np.flatnonzero(other & (100 * shared >= percent * (held_sizes + sizes[i] - shared))) + far).tolist():
            if group[j] != group[i]:
                links.append((int(docs[i]), int(docs[j])))
                group[group == group[j]] = group[i]
    return links


def _node_links(percent: int):
    def work(_: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        docs = table.column("doc").to_numpy()
        if len(docs) < 2:
            return
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("tokens").to_pylist()]
        side = table.column("side").to_numpy()
        sides = None if side[0] == ALL_PAIRS else side
        links = linked_in_node(docs, table.column("class").to_numpy(), sets, percent, sides)
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return grouped("node", work)


def _nodes(signatures: DataFrame, trees: int) -> DataFrame:
    """(tree, node, doc) for every tree in which the document is not alone."""
    entries = signatures.select(
        "doc",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
            t.alias("tree"), F.get("nodes", t * 2).alias("shallow"), F.get("nodes", t * 2 + 1).alias("deep")))).alias("e"),
    ).select("doc", "e.*")
    crowd = entries.groupBy("shallow").agg(F.count("*").alias("n")).filter("n > 1")
    shared = entries.join(crowd, "shallow")
    return shared.select("tree", F.when(F.col("n") <= SMALL_NODE, F.col("shallow")).otherwise(F.col("deep")).alias("node"), "doc")


def _tasks(n: Column, others: Column) -> Column:
    """(part, side) of a document for each task that takes it: every pair that is not inside the largest class once.

    The largest class and the others are dealt over blocks of their own.  A block of others meets itself, each
    other one and each block of the largest class.
    """
    many = lambda count: F.greatest(F.ceil(count / BLOCK), F.lit(1)).cast("int")
    large, small = many(n - others), many(others)
    own = lambda blocks: F.pmod(F.xxhash64("doc", "tree"), blocks).cast("int")
    task = lambda kind, a, b, side: F.struct(F.xxhash64(F.lit(kind), a, b).alias("part"), side.alias("side"))
    up_to = lambda blocks: F.sequence(F.lit(0), blocks - 1)
    in_largest = F.transform(up_to(small), lambda j: task(1, own(large), j, F.lit(0)))
    against = F.transform(up_to(large), lambda i: task(1, i, own(small), F.lit(1)))
    among = F.transform(up_to(small), lambda j: task(
        2, F.least(own(small), j), F.greatest(own(small), j),
        F.when(j == own(small), ALL_PAIRS).when(j > own(small), 0).otherwise(1)))
    whole = F.array(task(0, F.lit(0), F.lit(0), F.lit(ALL_PAIRS)))
    return F.when(n <= BLOCK, whole).when(F.col("class") == F.col("largest"), in_largest).otherwise(F.concat(against, among))


def _links(
    nodes: DataFrame, classes: DataFrame | None, sets: DataFrame, percent: int, set_bytes: float, last: bool = True
) -> tuple[DataFrame, DataFrame | None]:
    """Confirmed links between documents of different classes that share a node; documents of crowds left for more depth.

    A node of more than BLOCK documents is dealt over blocks.  Without classes each document goes to one block,
    another in every tree.  With classes, every pair of different classes meets in one task of the node, unless the
    node is a crowd and this is not the ``last`` depth.
    """
    if classes is None:
        members = nodes.withColumn("class", F.col("doc"))
    else:
        joined = nodes.join(classes.select(F.col("node").alias("doc"), F.col("component").alias("class")), "doc", "left")
        members = joined.withColumn("class", F.coalesce("class", "doc"))
    # nodes with the same members are one node; a node whose members are in one class is settled
    shares = members.groupBy("node", "class").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("mark"))
    kinds = shares.groupBy("node").agg(
        F.sum("n").alias("n"), F.sum("mark").alias("mark"), F.count("*").alias("classes"),
        F.max_by("class", F.struct("n", "class")).alias("largest"), (F.sum("n") - F.max("n")).alias("others"),
    ).filter("classes > 1")
    one = kinds.groupBy("n", "mark").agg(F.min(F.struct("node", "largest", "others")).alias("k")).select("n", "k.*")
    chosen, crowd = members.join(one, "node"), None
    if classes is None:
        block = F.pmod(F.xxhash64("doc", "tree"), F.ceil(F.col("n") / BLOCK))
        placed = chosen.withColumn("at", F.struct(block.alias("part"), F.lit(ALL_PAIRS).alias("side")))
    else:
        if not last:
            chosen = stored(chosen, "members")
            crowd = stored(chosen.filter(F.col("others") > BLOCK).select("doc").distinct(), "crowd")
            chosen = chosen.filter(F.col("others") <= BLOCK)
        placed = chosen.withColumn("at", F.explode(_tasks(F.col("n"), F.col("others"))))
    placed = stored(placed.select(F.xxhash64("node", "at.part").alias("node"), "doc", "class", "at.side"), "nodes")
    parts = parts_for(placed.count() * set_bytes, 16e6, sets.sparkSession.sparkContext.defaultParallelism)
    return stored(
        placed.join(sets.hint("merge"), "doc").repartition(parts, "node").sortWithinPartitions("node", "doc")
        .mapInArrow(_node_links(percent), "a long, b long"),
        "confirmed",
    ), crowd


def crowd_trees(depth: int, percent: int) -> int:
    """Trees of a depth that miss a pair at the least similarity with a chance of MISS at most."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** depth)))


def _crowd_nodes(crowd: DataFrame, sets: DataFrame, depth: int, percent: int) -> DataFrame:
    own = sets.join(crowd.hint("merge"), "doc", "left_semi")
    found = stored(own.mapInArrow(_crowd_paths(crowd_trees(depth, percent), depth), "tree int, node long, doc long"), "crowd-nodes")
    return found.join(found.groupBy("node").count().filter("count > 1").select("node"), "node").select("tree", "node", "doc")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, min_percent: int = MIN_PERCENT, trees: int = TREES
) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links) and kept (doc_id = component_id)."""
    with arrow_batches(docs.sparkSession):
        rows, leaders = _classes(docs, shingle_words, min_percent, trees)
    component = F.when(F.col("doc").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return _with_leaders(rows, leaders).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def one_of_each_class(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, min_percent: int = MIN_PERCENT, trees: int = TREES
) -> DataFrame:
    """Rows of ``docs``, exactly one of each class: of the least doc_id (null last), and of its texts one.

    Texts without words are in no class; of their rows with equal doc_id and text one stays.
    """
    with arrow_batches(docs.sparkSession):
        rows, leaders = _classes(docs, shingle_words, min_percent, trees)
    named = _with_leaders(rows, leaders).select(
        F.col("doc_id").alias("id"), F.col("mark").alias("m"),
        (F.col("doc").isNotNull() & ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark")))).alias("extra"))
    # only rows that go, or that are repeated, are named
    wanted = stored(named.groupBy("id", "m").agg(F.count("*").alias("rows"), F.max("extra").alias("extra")).filter(
        "extra or rows > 1"), "extra-rows")
    marked = packed(docs).withColumn("_mark", F.xxhash64("text"))
    same = lambda other: marked["doc_id"].cast("long").eqNullSafe(other["id"]) & (marked["_mark"] == other["m"])
    once = marked.join(wanted, same(wanted), "left_anti")
    again = wanted.filter("not extra")
    repeated = marked.join(again, same(again), "left_semi")
    # of rows that differ in other columns only, one by a hash of them, found with map-side combine
    chosen = F.min_by(F.struct("text", REST), F.struct(F.xxhash64(F.to_json(F.struct(REST))), F.to_json(F.struct(REST))))
    least = repeated.groupBy("doc_id", "_mark").agg(chosen.alias("row")).select("doc_id", "row.*")
    return unpacked(once.select("doc_id", "text", REST).union(least), docs)


def _with_leaders(rows: DataFrame, leaders: DataFrame) -> DataFrame:
    """Rows of ``_classes`` with ``first``, the leader of their class; salted, as one class can hold many rows."""
    salted = leaders.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "mark", "doc"), SALTS).cast("int")).join(
        salted, ["class", "salt"], "left")


def _classes(docs: DataFrame, shingle_words: int, min_percent: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """Every row as (doc_id, mark of the text, n_shingles, doc, class), and (class, first): its least (null, doc_id, mark).

    ``doc`` names the row's set and ``class`` the least name linked with it; both are null for an empty set.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    signatures = docs.mapInArrow(
        _signatures(trees, shingle_words), "doc_id long, mark long, n_shingles long, sum_a long, sum_b long, nodes array<long>")
    signatures = stored(signatures.withColumn(
        "doc", F.when(F.col("n_shingles") > 0, F.xxhash64("n_shingles", "sum_a", "sum_b"))), "signatures")
    full = signatures.filter("doc is not null")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    same = stored(full.groupBy("doc").agg(F.min(place).alias("first"), F.first("nodes").alias("nodes")), "same-sets")
    nodes = stored(_nodes(same, trees), "tree-nodes")
    size = full.agg(F.avg("n_shingles")).first()[0] or 0
    wide = 8.0 * size + 64
    # joined the same way at every size: only texts that share a node move
    wanted = same.join(nodes.select("doc").distinct(), "doc", "left_semi").select(
        "doc", F.col("first.doc_id").alias("id"), F.col("first.mark").alias("m")).hint("merge")
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["id"]) & (docs["mark"] == wanted["m"])).select("doc", "text")
    sets = stored(texts.mapInArrow(_full_sets(shingle_words), "doc long, tokens binary"), "sets").dropDuplicates(["doc"])
    links, _ = _links(nodes.filter(F.col("tree") < FIRST_TREES), None, sets, min_percent, wide)
    classes = components(links)
    for depth in (DEEP, *CROWD_DEPTHS):
        if depth != DEEP:
            nodes = _crowd_nodes(crowd, sets, depth, min_percent)
        more, crowd = _links(nodes, classes, sets, min_percent, wide, depth == CROWD_DEPTHS[-1])
        links = links.union(more)
        classes = components(links)
        if crowd is None or crowd.isEmpty():
            break
    classes = classes.select(F.col("node").alias("doc"), F.col("component").alias("class"))
    named = same.select("doc", "first").join(classes, "doc", "left").withColumn("class", F.coalesce("class", "doc"))
    leaders = stored(named.groupBy("class").agg(F.min("first").alias("first")), "leaders")
    known = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = signatures.drop("nodes", "sum_a", "sum_b").withColumn("salt", F.pmod(F.xxhash64("doc_id", "mark"), SALTS).cast("int"))
    rows = rows.join(known, ["doc", "salt"], "left").drop("salt").withColumn("class", F.coalesce("class", "doc"))
    return rows, leaders
