"""N-gram Jaccard join by vertical partitioning (operator 4).

A document is the set of its 5-word shingles; two documents link when their sets have a Jaccard
similarity of at least 75 %. The join keeps classes of documents with equal sets as one node.

1. The order of all shingles (by hash) is cut into fragments. A document's set is cut likewise,
   and each fragment counts on its own how many of a document's shingles occur in another node
   too. Summed per node these counts leave only nodes of which three quarters of the shingles
   are shared; no other can have a link.
2. Nodes that share one of their rarest shingles (as many as a link cannot miss) are candidates.
   Pairs within a list of candidates are not all formed: each node is first paired with one hub and
   with a few neighbours in random orders of its lists; nodes that turn out connected need no
   further pairs. Then the smaller groups of each list are paired with all of another group. All pairs
   pass a length and a positional filter.
3. The overlap of a pair is counted by fragment, in rows of their own, and summed per pair, which decides exactly;
   pairs that the first fragment rules out are not counted in the others.
4. Components of the links, by repeated contraction with pointer doubling.

Nodes are known by a 64-bit hash of their set that is checked against a second one: sets that meet
in the first use the second.

Defined results: null or empty text, or text without words, has an empty set and is its own
component; fewer than five words count as one shingle; repeated rows give a row each; component_id
is the smallest doc_id, null only if all are null; ties in rarity fall by hash; an empty table
gives an empty table; a text of any length is cut whole, in memory in proportion to its length; only doc_id and the text column are read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitscope.llm.textio import binary_array, distinct_in_groups, sequence_hashes, short_hashes, slices, words
from hitscope.session import scratch_path

SHINGLE = 5
PERCENT = 75
#: Shingles of one fragment that a task has in memory.
FRAGMENT_SHINGLES = 4_000_000
#: Fragments in which the overlaps of a pair are counted, each in a row of its own.
PAIR_FRAGMENTS = 2
#: Copies of a table that is looked up, for keys that a large part of the rows have.
SALTS = 8
#: Of each list, so many neighbours of a member are paired with it at once, in parts of so many members.
CHAIN_STEPS = 8
CHAIN_ROWS = 1000


def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in rising order, and the texts' offsets in them."""
    found = words(texts)
    hashes = found.hashes(lower=True)
    long, doc, _ = sequence_hashes(hashes, found.first, SHINGLE)
    short, short_doc = short_hashes(hashes, found.first, SHINGLE)
    values, doc = np.concatenate([long, short]), np.concatenate([doc, short_doc])
    values, doc = distinct_in_groups(values, doc)
    return values, np.searchsorted(doc, np.arange(len(texts) + 1))


def _nodes(values: np.ndarray, at: np.ndarray, again: frozenset[int]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each set, and a second one; sets whose first is in ``again`` use the second for both."""
    first = np.zeros(len(at) - 1, np.int64)
    second = np.zeros(len(at) - 1, np.int64)
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        if b > a:
            digest = xxhash.xxh3_128_digest(values[a:b].tobytes())
            second[i] = int.from_bytes(digest[8:], "big", signed=True)
            first[i] = int.from_bytes(digest[:8], "big", signed=True)
            if int(first[i]) in again:
                first[i] = second[i]
    return first, second


def _listed(again: frozenset[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            values, at = _sets(rows.column("text"))
            first, second = _nodes(values, at, again)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(at)), pa.array(first), pa.array(second)], ["doc_id", "n_shingles", "node", "second"])

    return run


def _cut(again: frozenset[int], bits: int):
    """Each fragment's share of the sets of a slice: nodes, their sizes, the number of shingles of each, the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text"):
            values, at = _sets(rows.column("text"))
            node, _ = _nodes(values, at, again)
            size = np.diff(at)
            own = np.flatnonzero(size)
            own = np.sort(own[np.unique(node[own], return_index=True)[1]])  # a set once for each slice
            if not len(own):
                continue
            count = size[own]
            pick = np.arange(count.sum()) + np.repeat(at[own] - (np.cumsum(count) - count), count)
            values, doc = values[pick], np.repeat(own, count)
            fragment = (values >> np.uint64(64 - bits)).astype(np.int64)
            by = np.argsort(fragment, kind="stable")
            edges = np.searchsorted(fragment[by], np.arange((1 << bits) + 1))
            out = []
            for k in np.flatnonzero(np.diff(edges)).tolist():
                part = by[edges[k] : edges[k + 1]]
                docs, number = np.unique(doc[part], return_counts=True)
                out.append((k, node[docs].tobytes(), size[docs].astype(np.uint32).tobytes(), number.astype(np.uint32).tobytes(), values[part].tobytes()))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]], ["fragment", "nodes", "sizes", "counts", "hashes"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per fragment and node: its shingles that another node has too, with the number of nodes that have each."""
    rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True))
    for _, group in groupby(rows, key=lambda r: r[0]):
        parts: list[list[np.ndarray]] = [[], [], []]
        for _, nodes, sizes, counts, hashes in group:
            count = np.frombuffer(counts, np.uint32)
            for part, values in zip(parts, (np.repeat(np.frombuffer(nodes, np.int64), count), np.repeat(np.frombuffer(sizes, np.uint32), count), np.frombuffer(hashes, np.uint64)), strict=True):
                part.append(values)
        node, size, hashes = (np.concatenate(p) for p in parts)
        del parts
        by = np.lexsort((node, hashes))
        node, size, hashes = node[by], size[by], hashes[by]
        new = np.ones(len(by), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (node[1:] != node[:-1])
        node, size, hashes = node[new], size[new], hashes[new]
        edge = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.empty(0, np.int64)
        often = np.diff(np.append(edge, len(hashes)))
        often = np.repeat(often, often)
        use = np.flatnonzero(often > 1)
        use = use[np.argsort(node[use], kind="stable")]
        node, size, hashes, often = node[use], size[use], hashes[use], often[use]
        edge = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.empty(0, np.int64)
        ends = np.append(edge, len(node))
        columns = [pa.array(node[edge]), pa.array(size[edge].astype(np.int64)), binary_array(hashes, ends * 8).cast(pa.binary()), binary_array(often.astype(np.uint32), ends * 4).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["node", "size", "hashes", "often"])


def _least(size: np.ndarray | int) -> np.ndarray | int:
    """Shingles of a set that any set linked with it must share."""
    return (PERCENT * size + 99) // 100


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes that can have links, their shared shingles with the rarest first, and how many of these are candidates' keys."""
    for rows in batches:
        out = []
        for node, size, hashes, often in zip(*(rows.column(i).to_pylist() for i in range(4)), strict=True):
            values, count = np.frombuffer(b"".join(hashes), np.int64), np.frombuffer(b"".join(often), np.uint32)
            if len(values) < _least(size):
                continue
            keys = size - _least(size) + 1 - (size - len(values))  # shingles that no other node has come first
            out.append((node, size, values[np.lexsort((values, count))], keys))
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["node", "size", "shingles", "keys"])


def _stored(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    path = scratch_path(spark, "ngram_join", name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _looked_up(rows: DataFrame, key: str, table: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row of ``table`` (first column: key) that has their key; rows of one key are dealt over ``SALTS`` tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__copy")
    copies = table.select(F.col(table.columns[0]).alias("__key"), *table.columns[1:], salts)
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(copies, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__copy")), how).drop("__key", "__copy", "__salt")


def _counted(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """fragment, a, b and what the fragment has of their overlap (``partial``), for each piece of the two."""
    b = pieces.select(F.col("node").alias("__b"), F.col("fragment").alias("__fragment"), F.col("shingles").alias("of_b"))
    a = pieces.select(F.col("node").alias("__a"), "fragment", F.col("shingles").alias("of_a"))
    met = pairs.join(a, F.col("a") == F.col("__a")).join(b, (F.col("b") == F.col("__b")) & (F.col("fragment") == F.col("__fragment")))
    return met.select(*pairs.columns, "fragment", F.size(F.array_intersect("of_a", "of_b")).alias("partial"))


def _reaches(overlap: Column) -> Column:
    return 100 * overlap >= PERCENT * (F.col("size_a") + F.col("size_b") - overlap)


def _linked(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b) those that link: each fragment counts what it has of the overlap, summed per pair.

    The first fragment is counted for all pairs; those that cannot link any more, even if all that is left of the smaller
    set is shared, go before the other fragments are counted."""
    zero = pieces.where("fragment = 0").select("node", "size", (F.col("shared") - F.size("shingles")).alias("left"), "shingles")
    met = pairs.join(zero.toDF("a", "size_a", "left_a", "of_a"), "a").join(zero.toDF("b", "size_b", "left_b", "of_b"), "b")
    first = met.withColumn("counted", F.size(F.array_intersect("of_a", "of_b")))
    open_ = _stored(first.where(_reaches(F.col("counted") + F.least("left_a", "left_b"))).select("a", "b", "size_a", "size_b", "counted"), "open_pairs")
    rest = _counted(open_.select("a", "b"), pieces.where("fragment > 0")).groupBy("a", "b").agg(F.sum("partial").alias("rest"))
    return open_.join(rest, ["a", "b"]).where(_reaches(F.col("counted") + F.col("rest"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, label of every node of a link: equal labels for connected nodes.

    A round joins every node to its smallest neighbour, follows these parents to their last by doubling (so a chain
    in the order of its numbers takes one round), and contracts what is joined."""
    edges = _stored(links.select("a", "b").where("a <> b"), "edges")
    labels = _stored(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        parents = _stored(both.groupBy(F.col("a").alias("child")).agg(F.least(F.min("b"), F.col("child")).alias("parent")), "parents")
        while True:
            up = parents.where("parent < child").select("child", F.col("parent").alias("next"))
            further = _looked_up(parents, "parent", up, "left")
            if further.where("next IS NOT NULL").isEmpty():
                break
            parents = _stored(further.select("child", F.coalesce("next", "parent").alias("parent")), "parents")
        labels = _stored(_looked_up(labels, "label", parents, "left").select("node", F.coalesce("parent", "label").alias("label")), "labels")
        moved = _looked_up(_looked_up(edges, "a", parents.withColumnRenamed("parent", "to_a")), "b", parents.withColumnRenamed("parent", "to_b")).where("to_a <> to_b")
        edges = _stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    return labels


def _may_link(a: Column, b: Column) -> Column:
    """Length filter, and positional filter: what two sets can still share after their first common shingle."""
    needed = F.ceil((a["size"] + b["size"]) * F.lit(PERCENT) / F.lit(100 + PERCENT) - F.lit(1e-9))
    left = 1 + F.least(a["size"] - a["place"] - 1, b["size"] - b["place"] - 1)
    return (a["size"] * 100 >= b["size"] * PERCENT) & (b["size"] * 100 >= a["size"] * PERCENT) & (left >= needed)


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a["node"], b["node"]).alias("a"), F.greatest(a["node"], b["node"]).alias("b")]


def _links(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """node, label of all nodes that have a link."""
    keys = F.slice("shingles", 1, F.greatest(F.col("keys"), F.lit(1)).cast("int"))
    lists = nodes.select("node", "size", "keys", F.size("shingles").alias("shared"), F.posexplode(keys).alias("at", "shingle")).where("at < keys")
    # shingles that no other node has come before all others
    lists = lists.select("shingle", F.struct("node", "size", (F.col("size") - F.col("shared") + F.col("at")).alias("place")).alias("own"))
    often = lists.groupBy("shingle").agg(F.min("own").alias("hub"), F.count("*").alias("members")).where("members > 1")
    lists = _stored(lists.join(often, "shingle"), "lists")
    shift = 64 - (PAIR_FRAGMENTS - 1).bit_length()
    cut = f"transform(sequence(0, {PAIR_FRAGMENTS - 1}), f -> filter(shingles, s -> shiftrightunsigned(s, {shift}) = f))"
    segments = _stored(nodes.select("node", "size", F.size("shingles").alias("shared"), F.posexplode(F.expr(cut)).alias("fragment", "shingles")), "pieces")
    own, hub = F.col("own"), F.col("hub")
    to_hub = lists.where((own["node"] != hub["node"]) & _may_link(own, hub)).groupBy(own["node"].alias("node")).agg(F.min("hub").alias("hub"))
    to_hub = to_hub.select(F.least("node", hub["node"]).alias("a"), F.greatest("node", hub["node"]).alias("b"))
    # neighbours in a random order of each list, in parts of about CHAIN_ROWS members
    part = F.pmod(F.xxhash64(own["node"]), F.ceil(F.col("members") / CHAIN_ROWS).cast("long"))
    order = Window.partitionBy("shingle", "part").orderBy(F.xxhash64(own["node"], "shingle"), own["node"])
    chained = lists.withColumn("part", part).select("own", F.array(*[F.lead("own", k).over(order) for k in range(1, CHAIN_STEPS + 1)]).alias("beside"))
    beside = F.col("other")
    chained = chained.select("own", F.explode(F.filter("beside", lambda x: x.isNotNull() & _may_link(own, x))).alias("other")).select(*_pair(own, beside))
    tried = _stored(to_hub.union(chained).distinct(), "pairs")
    links = _stored(_linked(tried, segments), "links")
    labels = components(links)
    # the rest of each list: members of another group than its largest, with all of other groups
    named = lists.select("shingle", "own", own["node"].alias("node")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = named.groupBy("shingle", "label").agg(F.count("*").alias("members"))
    most = groups.groupBy("shingle").agg(F.max(F.struct("members", "label")).alias("most"), F.count("*").alias("groups")).where("groups > 1")
    named = _stored(named.join(most, "shingle").select("shingle", "own", "label", (F.col("label") == F.col("most.label")).alias("largest")), "groups")
    few = named.where("NOT largest").select("shingle", F.col("own").alias("x"), F.col("label").alias("x_label"))
    every = named.select("shingle", F.col("own").alias("y"), F.col("label").alias("y_label"), "largest")
    x, y = F.col("x"), F.col("y")
    once = F.col("largest") | (x["node"] < y["node"])
    rest = few.join(every, "shingle").where((F.col("x_label") != F.col("y_label")) & once & _may_link(x, y)).select(*_pair(x, y)).distinct()
    rest = _stored(rest.join(tried, ["a", "b"], "left_anti"), "pairs")
    more = _stored(_linked(rest, segments), "links")
    return labels if more.isEmpty() else components(links.union(more))


def join(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    spark = documents.sparkSession
    source = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = "doc_id long, n_shingles long, node long, second long"
    rows = _stored(source.mapInArrow(_listed(frozenset()), schema), "documents")
    meet = rows.where("n_shingles > 0").groupBy("node").agg((F.min("second") != F.max("second")).alias("meet")).where("meet")
    again = frozenset(r.node for r in meet.collect())  # about documents ** 2 / 2 ** 65 of them
    node = F.when(F.col("node").isin(list(again)), F.col("second")).otherwise(F.col("node")) if again else F.col("node")
    rows = rows.select("doc_id", "n_shingles", node.alias("node"))
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    bits = max(6, int(np.ceil(np.log2(total / FRAGMENT_SHINGLES + 1))))
    pieces = source.select("text").mapInArrow(_cut(again, bits), "fragment int, nodes binary, sizes binary, counts binary, hashes binary")
    shared = pieces.repartition(1 << bits, "fragment").sortWithinPartitions("fragment").mapInArrow(_shared, "node long, size long, hashes binary, often binary")
    gathered = shared.groupBy("node", "size").agg(F.collect_list(F.struct("hashes", "often")).alias("parts"))
    gathered = gathered.select("node", "size", "parts.hashes", "parts.often")
    nodes = _stored(gathered.mapInArrow(_ranked, "node long, size long, shingles array<long>, keys long"), "nodes")
    labels = _links(spark, nodes)
    named = rows.where("n_shingles > 0").join(labels, "node", "left").select("doc_id", "n_shingles", F.coalesce("label", "node").alias("label"))
    named = _stored(named, "labelled")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return _looked_up(named, "label", least).select("doc_id", "n_shingles", "component_id").union(alone)


def one_of_each(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are the smallest of their component, with their columns; those without an id stay only if alone."""
    found = join(documents, text).where("doc_id IS NOT NULL AND component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return documents.join(found, F.col("doc_id") == F.col("__gone"), "left_anti")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
c AS (SELECT doc_id AS d, doc_id AS o FROM documents UNION SELECT c.d, l.y FROM c JOIN l ON c.o = l.x)
SELECT c.d AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(c.o) AS component_id FROM c LEFT JOIN n ON n.doc_id = c.d GROUP BY c.d
"""
