"""Prefix trie of conversations: adaptive radix trees over turn ids, one for each range of paths."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import table, written

WIDTH = 16  # bytes of a turn's id
RANGE_PATHS = 20_000  # about so many different paths make a range, with one tree
PART_IDS = 4096  # so many members' numbers are joined before they are put in one place


class Node:
    """A node of an adaptive radix tree: a compressed prefix, a value, and children by their first byte.

    Children are held in the smallest of four layouts they fit in: up to 4 and up to 16
    bytes in order with their children beside them, up to 48 by an index of 256 places,
    and 256 places.  A node grows into the next layout when it is full.
    """

    __slots__ = ("prefix", "value", "keys", "kids", "n")

    def __init__(self, prefix: bytes, value=None) -> None:
        self.prefix, self.value, self.n = prefix, value, 0
        self.keys: bytearray | None = bytearray()
        self.kids: list = []

    def child(self, byte: int) -> Node | None:
        if self.keys is None:
            return self.kids[byte]
        if len(self.keys) == 256:
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> None:
        """Set the child of a byte, new or not."""
        if self.keys is None:
            self.n += self.kids[byte] is None
            self.kids[byte] = node
        elif len(self.keys) == 256:
            at = self.keys[byte]
            if at:
                self.kids[at - 1] = node
            elif self.n < 48:
                self.kids.append(node)
                self.n += 1
                self.keys[byte] = self.n
            else:
                wide: list = [None] * 256
                for b, k in enumerate(self.keys):
                    if k:
                        wide[b] = self.kids[k - 1]
                self.keys, self.kids = None, wide
                self.put(byte, node)
        else:
            at = self.keys.find(byte)
            if at >= 0:
                self.kids[at] = node
            elif self.n < 16:
                at = sum(k < byte for k in self.keys)
                self.keys.insert(at, byte)
                self.kids.insert(at, node)
                self.n += 1
            else:
                index = bytearray(256)
                for k, b in enumerate(self.keys):
                    index[b] = k + 1
                self.keys = index
                self.put(byte, node)

    def layout(self) -> int:
        return 256 if self.keys is None else 48 if len(self.keys) == 256 else 4 if self.n <= 4 else 16

    def children(self) -> list[Node]:
        """In the order of their bytes."""
        if self.keys is None:
            return [k for k in self.kids if k is not None]
        if len(self.keys) == 256:
            return [self.kids[k - 1] for k in self.keys if k]
        return list(self.kids)


class Tree:
    """Values by paths: no two values on one path."""

    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, path: bytes, value) -> None:
        if self.root is None:
            self.root = Node(path, value)
            return
        node, above, at = self.root, None, 0
        while True:
            prefix, same = node.prefix, 0
            if not path.startswith(prefix, at):
                most = min(len(prefix), len(path) - at)
                while same < most and prefix[same] == path[at + same]:
                    same += 1
                split = Node(prefix[:same])
                if above is None:
                    self.root = split
                else:
                    above.put(prefix[0], split)
                node.prefix = prefix[same:]
                split.put(prefix[same], node)
                if at + same == len(path):
                    split.value = value
                else:
                    split.put(path[at + same], Node(path[at + same :], value))
                return
            at += len(prefix)
            if at == len(path):
                node.value = value
                return
            below = node.child(path[at])
            if below is None:
                node.put(path[at], Node(path[at:], value))
                return
            node, above = below, node


def chained(path: bytes, depth: int) -> list[bytes]:
    """Digests of the first 0 .. depth turns of a path."""
    out = [b"\0" * WIDTH]
    for k in range(depth):
        out.append(hashlib.md5(out[-1] + path[k * WIDTH : (k + 1) * WIDTH]).digest())
    return out


def trie_nodes(tree: Tree, before: int, behind: int, goes_on: bool, heads: list[bytes], tails: list[bytes]) -> list[list]:
    """A row for each place of a range's tree at a whole number of turns.

    Values are (members, least, sizes, digest of the ends).  before, behind: how many turns
    the first path has in common with the last one of the range before, and the last path
    with the first one of the range behind (-1: there is none); heads, tails: the digests of
    these turns.  Places on them are shared.  goes_on: the last path begins the one behind.

    Rows: own digest and parent's digest (of shared places), least, depth, least of a
    parent that isn't shared, members, children, leaves, weighed (code points times members)
    and once (code points) of all places from here down, digest of those that end here.
    What the range before has too is counted there: as a child, and in `once`.
    """
    order, stack = [], [(tree.root, 0, True, True, -1)] if tree.root else []
    while stack:
        node, at, first, last, above = stack.pop()
        here = len(order)
        order.append((node, at, first, last, above))
        kids = node.children()
        for k, kid in enumerate(kids):
            stack.append((kid, at + len(node.prefix), first and k == 0 and node.value is None, last and k == len(kids) - 1, here))
    rows: list[list] = []
    sums: list[list | None] = [None] * len(order)  # least, members, leaves, weighed, once, children, their rows, sizes
    for here in range(len(order) - 1, -1, -1):
        node, at, first, last, above = order[here]
        total, end = sums[here], at + len(node.prefix)
        sums[here] = None
        if total is None:
            members, least, sizes, _ = node.value
            total = [least, members, 0 if last and goes_on else 1, 0, 0, 0, [], sizes]
        elif node.value:
            total[0], total[1], total[7] = min(total[0], node.value[1]), total[1] + node.value[0], node.value[2]
        for depth in range(end // WIDTH, -1 if above < 0 else at // WIDTH, -1):
            continued = first and depth <= before
            digest = heads[depth] if continued else tails[depth] if last and depth <= behind else None
            size = total[7][depth - 1] if depth else 0
            total[3] += total[1] * size
            total[4] += 0 if continued else size
            for row in total[6]:
                row[1], row[4] = (None, total[0]) if digest is None else (digest, None)
            ends = node.value[3] if node.value and depth * WIDTH == end else None
            row = [digest, None, total[0], depth, None, total[1], total[5], total[2], total[3], total[4], ends]
            rows.append(row)
            total[5], total[6] = 0 if continued else 1, [row]
        if above >= 0:
            over = sums[above]
            if over is None:
                sums[above] = total
            else:
                over[0] = min(over[0], total[0])
                for k in range(1, 6):
                    over[k] += total[k]
                if len(over[6]) < len(total[6]):
                    over[6], total[6] = total[6], over[6]
                over[6] += total[6]
    return rows


PART_SCHEMA = "path binary, sizes array<int>, least long, members long, ids binary"
PATH_SCHEMA = "part int, path binary, sizes array<int>, least long, members long, ends binary"
NODE_SCHEMA = "own binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, weighed long, once long, ends binary"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def _batches(rows: Iterator, ddl: str, size: int = 4096) -> Iterator[pa.RecordBatch]:
    schema, held = _arrow(ddl), []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring members of one path: their decimal numbers, comma-joined, PART_IDS at a time."""

    def rows():
        at, sizes, least, members, ids = None, None, None, 0, []
        for path, own, conv in _tuples(batches):
            if path != at or members == PART_IDS:
                if members:
                    yield at, sizes, least, members, ",".join(ids).encode()
                at, sizes, least, members, ids = path, own, conv, 0, []
            members += 1
            ids.append(str(conv))
        if members:
            yield at, sizes, least, members, ",".join(ids).encode()

    return _batches(rows(), PART_SCHEMA)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per path, with the digest of all its members' numbers, from parts in their order."""
    part = TaskContext.get().partitionId()

    def rows():
        at, kept, members, state = None, None, 0, None
        for path, sizes, least, n, ids in _tuples(batches):
            if path == at:
                members += n
                state.update(b"," + ids)
                continue
            if kept:
                yield part, at, *kept, members, state.digest()
            at, kept, members, state = path, (sizes, least), n, hashlib.sha256(ids)
        if kept:
            yield part, at, *kept, members, state.digest()

    return _batches(rows(), PATH_SCHEMA)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a range's first and last path and those beside it: turns in common, and whether the last goes on."""

    def rows():
        for part, first, last, ending, starting in _tuples(batches):
            yield part, _same(ending, first), _same(last, starting), bool(starting is not None and starting.startswith(last))

    return _batches(rows(), "part int, before int, behind int, goes_on boolean")


def _same(a: bytes | None, b: bytes | None) -> int:
    if a is None or b is None:
        return -1
    k, most = 0, min(len(a), len(b))
    while k < most and a[k : k + WIDTH] == b[k : k + WIDTH]:
        k += WIDTH
    return k // WIDTH


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie's places, range by range."""

    def rows():
        at, tree, edge = None, None, ()
        for part, path, sizes, least, members, ends, before, behind, goes_on in _tuples(batches):
            if part != at:
                if tree:
                    yield from trie_nodes(tree, *edge, heads, chained(last, edge[1]))
                at, tree, edge, heads = part, Tree(), (before, behind, goes_on), chained(path, before)
            tree.insert(path, (members, least, sizes, ends))
            last = path
        if tree:
            yield from trie_nodes(tree, *edge, heads, chained(last, edge[1]))

    return _batches(rows(), NODE_SCHEMA)


def turns_of(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as arrays of (id, size).

    id: a digest of role and text as hex; size: the text's code points.  Null role and text
    count as empty; a null turn comes first; turns of one number come in the order of their
    ids; rows without a conversation are left out.  The turns' ids of one conversation must
    fit into a task's memory, their texts needn't.
    """
    who, what = F.coalesce(conversations[role], F.lit("")), F.coalesce(conversations[text], F.lit(""))
    made = F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what))
    place = conversations[turn]
    rows = conversations.where(conversations[key].isNotNull()).select(
        conversations[key].cast("long").alias("conv_id"),
        F.struct(place.isNotNull().alias("numbered"), F.coalesce(place.cast("long"), F.lit(0)).alias("turn"), made.alias("id"), F.length(what).alias("size")).alias("turn"),
    )
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return rows.select("conv_id", F.transform("turns", lambda t: F.struct(t.id.alias("id"), t["size"].alias("size"))).alias("turns"))


def with_shared_heads(rows: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversations rebuilt: the first h turns are those of the block's first conversation.

    c's block begins at c - c % block (as much of it as there is, nothing if it is absent);
    h = crc32 of c's decimal digits modulo `most`; c's own turns follow from h on.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    rows = rows.withColumn("h", h)
    heads = rows.select(F.col("conv_id").alias("_first"), F.slice("turns", 1, most - 1).alias("_head"))
    rows = rows.join(heads, F.col("conv_id") - F.col("conv_id") % block == F.col("_first"), "left")
    head = F.when(F.col("_head").isNull(), F.slice("turns", 1, F.lit(0))).otherwise(F.slice("_head", F.lit(1), F.col("h")))
    return rows.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns") + 1)).alias("turns"))


def prefix_trie(rows: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turns) as of turns_of: one row per different beginning.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves
    (childless places from here down), saved_tokens (sum from here down of (n_convs - 1)
    times the last text's code points), ends_sha256 (of the ascending decimal numbers,
    comma-joined, of the conversations that end here; of nothing if there are none).

    A path is the conversation's turn ids, WIDTH bytes each.  Members of one path are joined
    in parts of PART_IDS, spread over tasks; different paths are cut into ranges, and each
    range grows its own adaptive radix tree.  Only the beginnings that neighbouring ranges
    have in common are added up across ranges, so neither a frequent first turn nor a
    frequent conversation gathers in one task.

    A conversation without turns ends at the root; repeated conv_ids and null ones don't
    occur in turns_of's rows; an empty table gives no rows.  Other columns aren't read.
    """
    paths = rows.select(F.unhex(F.array_join("turns.id", "")).alias("path"), F.col("turns.size").alias("sizes"), "conv_id")
    spark = rows.sparkSession
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    parts = written(paths.repartitionByRange(spread, "path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(_joined, PART_SCHEMA), "parts")
    ranges = max(1, parts.count() // RANGE_PATHS + 1)
    ranged = parts.repartitionByRange(ranges, "path").sortWithinPartitions("path", "least")
    ranged = written(ranged.mapInArrow(_digested, PATH_SCHEMA), "paths")
    edges = ranged.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    ending = edges.select((F.col("part") + 1).alias("part"), F.col("last").alias("ending"))
    starting = edges.select((F.col("part") - 1).alias("part"), F.col("first").alias("starting"))
    edges = edges.join(ending, "part", "left").join(starting, "part", "left")
    edges = edges.select("part", "first", "last", "ending", "starting").mapInArrow(_common, "part int, before int, behind int, goes_on boolean")
    grown = ranged.join(edges, "part").repartition(ranges, "part").sortWithinPartitions("part", "path")
    nodes = written(grown.mapInArrow(_grown, NODE_SCHEMA), "nodes")

    counted = ("n_convs", "n_children", "n_leaves", "weighed", "once")
    shared = nodes.where(F.col("own").isNotNull()).groupBy("own", "depth")
    shared = shared.agg(F.min("conv_id").alias("conv_id"), F.max("above").alias("above"), F.max("ends").alias("ends"), *[F.sum(c).alias(c) for c in counted])
    alone = nodes.where(F.col("own").isNull())
    every = alone.select("above", "conv_id", "depth", "parent_conv_id", "ends", *counted).unionByName(shared.select("above", "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "ends", *counted))
    every = every.join(shared.select(F.col("own").alias("_own"), F.col("conv_id").alias("_conv")), F.col("above") == F.col("_own"), "left")
    return every.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("weighed") - F.col("once")).alias("saved_tokens"), F.lower(F.hex(F.coalesce("ends", F.lit(hashlib.sha256().digest())))).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(turns_of(table(spark, sf_dir, "conversations"))))


SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS first, count(*) AS n,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
           lambda a, x: list_reduce(list_prepend(xor(a, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda b, y: xor(b >> 1, 3988292384::BIGINT * (b & 1)))), 4294967295::BIGINT) % 6 AS h
  FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, t.k AS pos, t.id, t.size FROM c JOIN t ON t.conv_id = c.first AND t.k <= c.h
  UNION ALL
  SELECT c.conv_id, t.k, t.id, t.size FROM c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, array_to_string(list(id) OVER w, '') AS path, size
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM p GROUP BY path, depth),
last AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
ends AS (
  SELECT p.path, sha256(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id)) AS ends_sha256
  FROM p JOIN last USING (conv_id, depth) GROUP BY p.path),
kids AS (SELECT left(path, 32 * (depth - 1)::INT) AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
under AS (
  SELECT p.path, sum(CASE WHEN k.path IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.size) AS saved_tokens
  FROM node u JOIN p ON p.conv_id = u.conv_id AND p.depth <= u.depth LEFT JOIN kids k ON k.path = u.path
  GROUP BY p.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
       under.n_leaves::BIGINT AS n_leaves, under.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM node n JOIN under USING (path) LEFT JOIN kids k USING (path) LEFT JOIN ends e USING (path)
LEFT JOIN node up ON n.depth > 0 AND up.path = left(n.path, 32 * (n.depth - 1)::INT)
"""
