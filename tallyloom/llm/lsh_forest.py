"""MinHash near-duplicates: an LSH forest links most of each group, an exact prefix join finds what it missed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import FEW_ROWS, WordHashes, kept_in_worker, table, texts, windows_hashed, written
from tallyloom.llm.components import components

WIDTH = 5  # words of a shingle
TREES, DEPTH, LEAST_DEPTH = 20, 6, 4  # sorted orders; values of a label; of them equal at least
REGION = 512  # nodes of a region; beginnings that more share are divided
SIDE = 8  # neighbours on either side of a node in an order
CLASSES = 1 << 20  # of the table of shingle counts: its size is fixed
SEED = 12345


def shingles(text: bytes, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of the text, lower-cased in A-Z; the whole if shorter."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows_hashed(memo.of(words), min(WIDTH, len(words))))


def signature(found: np.ndarray, factors: np.ndarray) -> bytes:
    """A label value of 16 bits from the least hash by each factor."""
    own = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(own), 4096):
        part = own[start : start + 4096]
        np.minimum(least, (part[None, :] * factors[:, None]).min(axis=1), out=least)
    least ^= least >> np.uint32(15)
    return (least * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(">u2").tobytes()


def signed(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, k1, k2, n_shingles, sig, text): each row with its set's key and signature, written."""
    factors = np.random.default_rng(SEED).integers(0, 1 << 31, TREES * DEPTH, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = kept_in_worker("words", WordHashes)
        for batch in rows:
            k1, k2, sizes, sigs = [], [], [], []
            for text in texts(batch):
                found = shingles(text, memo)
                raw = found.tobytes()
                k1.append(xxhash.xxh3_64_intdigest(raw) - (1 << 63))
                k2.append(xxhash.xxh3_64_intdigest(raw, 7) - (1 << 63))
                sizes.append(len(found))
                sigs.append(signature(found, factors) if len(found) else b"")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), batch.column("text")], ["doc_id", "k1", "k2", "n_shingles", "sig", "text"])

    rows = docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, k1 long, k2 long, n_shingles long, sig binary, text string")
    return written(rows.withColumn("row_id", F.monotonically_increasing_id()), "signed", FEW_ROWS)


def regions(nodes: DataFrame) -> DataFrame:
    """(tree, shared, block, label, node, pivot): each tree's stretches of labels with a common beginning.

    A region is as deep as its size asks for: the first depth, from LEAST_DEPTH values on, at
    which at most REGION nodes share a beginning.  A beginning that more share is divided into
    its deeper ones, each of which has one node in the order of the upper one, so all stay
    tied; an order of more than REGION of these is cut where the next value passes even steps.
    Nodes that share a whole label have no order left: they are dealt to blocks, and meet
    their first node, too.  Beginnings of one node are left out.  Sizes are counted before
    they are joined, so no task holds a region's nodes to count them.
    """
    wide = 2 * DEPTH
    label = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring(F.col("sig"), t * wide + 1, F.lit(wide)))
    rows = nodes.select("node", F.posexplode(label).alias("tree", "label"))
    none, out = F.lit(None).cast("long"), []
    for depth in range(LEAST_DEPTH, DEPTH + 1):
        rows = rows.withColumn("shared", F.substring("label", 1, 2 * depth))
        sizes = rows.groupBy("tree", "shared").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1")
        rows = rows.join(sizes, ["tree", "shared"])
        out.append(rows.where(F.col("n") <= REGION).select("tree", "shared", F.lit(0).alias("block"), "label", "node", none.alias("pivot")))
        rows = rows.where(F.col("n") > REGION)
        if depth == DEPTH:
            block = F.pmod(F.xxhash64("tree", "node"), F.floor(F.col("n") / REGION) + 1)
            out.append(rows.select("tree", "shared", block.cast("int").alias("block"), "label", "node", "pivot"))
            break
        value = F.substring("label", 2 * depth + 1, 2)
        firsts = rows.groupBy("tree", "shared", value.alias("value")).agg(F.min(F.struct("label", "node")).alias("first"))
        several = firsts.groupBy("tree", "shared").agg(F.count("*").alias("n"), F.min("first.node").alias("pivot")).where("n > 1")
        block = F.floor(F.conv(F.hex("value"), 16, 10).cast("long") * (F.floor(F.col("n") / REGION) + 1) / (1 << 16))
        pivot = F.when(F.col("n") > REGION, F.col("pivot"))
        out.append(firsts.join(several, ["tree", "shared"]).select("tree", "shared", block.cast("int").alias("block"), "first.label", "first.node", pivot.alias("pivot")))
        rows = rows.select("node", "tree", "label")
    found = out[0]
    for part in out[1:]:
        found = found.union(part)
    return found


def candidate_pairs(found: DataFrame) -> DataFrame:
    """(a, b, step): neighbours by longest common prefix in a region's order, or a node and its region's pivot.

    The next on either side always, as step 1; up to SIDE on either side, at their distance,
    as long as they share as long a prefix as the nearer of the two next ones does.  Nodes
    with equal labels stand in an order of their own in each tree."""
    line = Window.partitionBy("tree", "shared", "block").orderBy("label", F.xxhash64("tree", "node"), "node")
    equal = [(F.substring("label", 1, 2 * d) == F.substring(F.lead("label").over(line), 1, 2 * d)).cast("int") for d in range(1, DEPTH + 1)]
    depth = F.coalesce(sum(equal[1:], equal[0]), F.lit(0))
    rows = found.withColumn("after", depth)
    rows = rows.withColumn("best", F.greatest("after", F.coalesce(F.lag("after").over(line), F.lit(0))))
    near = []
    for step in range(1, SIDE + 1):
        other, theirs = F.lead("node", step).over(line), F.lead("best", step).over(line)
        common = F.least(*[F.lead("after", k).over(line) for k in range(step)], F.lit(DEPTH))
        near.append(F.struct(other.alias("b"), theirs.alias("theirs"), common.alias("common"), F.lit(step).alias("step")))
    pairs = rows.select(F.col("node").alias("a"), "best", F.array(*near).alias("near")).select("a", "best", F.inline("near")).where("b IS NOT NULL")
    pairs = pairs.where("step = 1 OR common >= least(best, theirs)").select("a", "b", "step")
    tied = found.where("pivot IS NOT NULL").select(F.col("node").alias("a"), F.col("pivot").alias("b"), F.lit(1).alias("step"))
    both = pairs.union(tied).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "step")
    return both.groupBy("a", "b").agg(F.min("step").alias("step"))


def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose nodes aren't in one component yet."""
    for end in ("a", "b"):
        own = groups.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
        pairs = pairs.join(own, end, "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def forest_links(nodes: DataFrame, rows: DataFrame, share: int) -> DataFrame:
    """(a, b): links that the forest finds: next neighbours first, further ones where these left nodes apart."""
    pairs = written(candidate_pairs(written(regions(nodes.select("node", "sig")), "regions")), "pairs")
    links = written(verified(pairs.where("step = 1"), rows, share), "confirmed", FEW_ROWS)
    further = written(apart(pairs.where("step > 1"), components(links)), "further")
    return written(links.union(verified(further, rows, share)), "forest-links", FEW_ROWS)


def class_counts(nodes: DataFrame) -> np.ndarray:
    """How often the shingles of each class are met, in all nodes.

    It only orders the shingles: any one order serves, a good one keeps common shingles out of the prefixes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, total = kept_in_worker("words", WordHashes), np.zeros(CLASSES, np.int64)
        for batch in batches:
            for x in texts(batch):
                np.add.at(total, _classes(shingles(x, memo)), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["class", "n"])

    found = nodes.select("text").mapInArrow(count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    out = np.zeros(CLASSES, np.uint64)
    out[found.column("class").to_numpy()] = np.minimum(found.column("n").to_numpy(), 0xFFFF)
    return out


def _classes(found: np.ndarray) -> np.ndarray:
    return (found & np.uint64(CLASSES - 1)).astype(np.int64)


def prefixes(nodes: DataFrame, share: int) -> DataFrame:
    """(key, node, n, at): the rarest shingles of each node, of which similar nodes share one, if another node has it; written.

    Sets of n and m shingles with 100 * intersection >= share * union have at least
    share * n / 100 in common, so they share one of the first n - that + 1 in any one order."""
    counts = nodes.sparkSession.sparkContext.broadcast(class_counts(nodes))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, rank = kept_in_worker("words", WordHashes), counts.value
        for batch in batches:
            keys, sizes = [], []
            for x in texts(batch):
                found = shingles(x, memo)
                codes = np.sort(rank[_classes(found)] << np.uint64(48) | found >> np.uint64(16))
                keys.append(codes[: len(codes) + (-share * len(codes)) // 100 + 1])
                sizes.append(len(codes))
            lengths = [len(k) for k in keys]
            at = [np.arange(n, dtype=np.int32) for n in lengths]
            columns = [np.concatenate(keys).view(np.int64), np.repeat(batch.column("node").to_numpy(), lengths), np.repeat(np.array(sizes, np.int32), lengths), np.concatenate(at)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "n", "at"])

    rows = written(nodes.select("node", "text").mapInArrow(cut, "key long, node long, n int, at int"), "prefixes", FEW_ROWS)
    several = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    return written(rows.join(several.hint("shuffle_hash"), "key", "left_semi"), "shared-prefixes")


def _grouped(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of shared, with their component, whose key is held by several components."""
    held = shared.join(groups.select("node", F.col("component").alias("_c")), "node", "left").select("key", "node", "n", "at", F.coalesce("_c", "node").alias("c"))
    open_ = held.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min(F.struct("at", "node", "n", "c")).alias("hub")).where("low < high").select("key", "hub")
    return held.join(open_.hint("shuffle_hash"), "key")


def _possible(x: str, y: str, share: int) -> Column:
    """Whether two sets that share a key may be similar, by their sizes and the shingles behind the key."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    need = F.ceil((n + m).cast("long") * share / (100 + share) - 1e-9)
    return (100 * n >= share * m) & (100 * m >= share * n) & (F.least(n - F.col(f"{x}at"), m - F.col(f"{y}at")) >= need)


def hub_pairs(shared: DataFrame, groups: DataFrame, share: int) -> DataFrame:
    """(a, b): each node and, for each of its keys, the node with the fewest rarer shingles.

    That is the original where many copies differ from it in their own ways.  It is a short
    cut: what it links leaves fewer pairs to cross_pairs."""
    rows = _grouped(shared, groups)
    rows = rows.where((F.col("c") != F.col("hub.c")) & _possible("", "hub.", share))
    return rows.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def cross_pairs(shared: DataFrame, groups: DataFrame, share: int) -> DataFrame:
    """(a, b): all nodes of different components that share a key and may be similar."""
    rows = written(_grouped(shared, groups).drop("hub"), "open-prefixes")
    x, y = rows.alias("x"), rows.alias("y")
    met = x.join(y.hint("shuffle_hash"), (F.col("x.key") == F.col("y.key")) & (F.col("x.c") < F.col("y.c")) & _possible("x.", "y.", share))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def verified(pairs: DataFrame, rows: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= share * union."""
    wanted = pairs.select(F.col("a").alias("row_id")).union(pairs.select(F.col("b").alias("row_id"))).distinct()
    held = rows.select("row_id", "text").join(wanted, "row_id", "left_semi")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = kept_in_worker("words", WordHashes)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), pa.array([shingles(x, memo).tobytes() for x in texts(batch)], pa.binary())], ["row_id", "found"])

    sets = written(held.mapInArrow(to_sets, "row_id long, found binary"), "sets", FEW_ROWS)
    both = pairs.select("a", "b").join(sets.select(F.col("row_id").alias("b"), F.col("found").alias("found_b")), "b").join(sets.select(F.col("row_id").alias("a"), F.col("found").alias("found_a")), "a")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("found_a").to_pylist(), batch.column("found_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                n, m = len(x), len(y)
                if 100 * min(n, m) < share * max(n, m):
                    good.append(False)
                    continue
                merged = np.sort(np.concatenate([x, y]), kind="stable")
                common = int(np.count_nonzero(merged[1:] == merged[:-1]))
                good.append(100 * common >= share * (n + m - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "found_a", "found_b").mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, share: int = 85) -> DataFrame:
    """(row_id, doc_id, n_shingles, component_id, component, h1, h2) per row of docs.

    Rows with the same set are one node.  Neighbours in the forest's orders are checked
    first, then hubs; then all pairs of nodes that are not yet in one component and share a
    shingle of their prefixes, so every link that joins components is found.  component_id:
    the smallest doc_id reachable.  A null or empty text has no shingles and is linked with
    nothing (its component is its own id); rows without an id take their component's;
    repeated rows share one; other columns aren't read.
    """
    rows = signed(docs)
    sets = rows.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("row_id").alias("node"), F.min("doc_id").alias("least_id"))
    sets = written(sets, "nodes")
    nodes = rows.select(F.col("row_id").alias("node"), "sig", "text").join(sets.select("node"), "node", "left_semi")
    links = forest_links(nodes, rows, share)
    shared = prefixes(nodes, share)
    for found in (hub_pairs, cross_pairs):
        pairs = written(found(shared, components(links), share), found.__name__)
        links = written(links.union(verified(pairs, rows, share)), "all-links", FEW_ROWS)
    groups = components(links)
    labelled = sets.join(groups, "node", "left").select("k1", "k2", "least_id", F.coalesce("component", "node").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labelled = labelled.join(least, "component").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "component_id", "component")
    out = rows.select("row_id", "doc_id", "k1", "k2", "n_shingles", *text_hashes(F.col("text"))).join(labelled, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("n_shingles") > 0), "left")
    own: Column = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("row_id", "doc_id", "n_shingles", own.alias("component_id"), "component", "h1", "h2")


def text_hashes(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def one_of_each(docs: DataFrame, share: int = 80) -> DataFrame:
    """The rows of docs, with their own columns, of which one of each group of near-duplicates stays.

    It is the row with the smallest doc_id (null last), of these the one with the smallest text
    hash; of rows that repeat id and text one stays, too.  Texts without words all stay.
    """
    rows = near_duplicates(docs, share)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    best = rows.where("n_shingles > 0").groupBy("component").agg(F.min(place).alias("p")).select("p.doc_id", "p.h1", "p.h2")
    blank = rows.where("n_shingles = 0").select("doc_id", "h1", "h2").distinct()
    times = rows.where("n_shingles > 0").groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("doc_id", "h1", "h2")]
    keys = best.alias("x").join(times.alias("y"), same, "left").select("x.doc_id", "x.h1", "x.h2", F.col("n").isNotNull().alias("again"))
    keys = keys.union(blank.withColumn("again", F.lit(False))).select(F.col("doc_id").alias("_id"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("again").alias("_again"))
    h1, h2 = text_hashes(docs["text"])
    keys = keys.hint("shuffle_hash")
    kept = docs.join(keys, docs["doc_id"].eqNullSafe(keys["_id"]) & (h1 == keys["_h1"]) & (h2 == keys["_h2"]))
    kept = kept.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[keys[c] for c in keys.columns])
    again = kept.where("_again").dropDuplicates(["_id", "_h1", "_h2"])
    return kept.where("NOT _again").union(again).select("row.*")


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
  s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM w),
  e AS (SELECT doc_id, unnest(s) AS x FROM s), n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
  c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
  l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
  r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
  SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n"""
