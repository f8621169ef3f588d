"""Near duplicates by DartMinHash signatures and banded joining.

Elements are word shingles, weighted by how often a text holds them. The region of an element
is cut into strips of unit weight. Hashed darts fall on every strip as a Poisson process along
the rank axis; each dart has a coordinate, and the signature keeps the earliest dart of each
coordinate. Two texts agree on a coordinate with probability equal to their weighted Jaccard
similarity. Only ranks up to a border that depends on the total weight are looked at, so a text
costs its shingles plus about k log k darts, however long it is; if a coordinate stays empty the
border is doubled.

1. One pass gives every document a fingerprint of its shingles and its bands. Documents with the
   same shingles are one node from here on.
2. In every band bucket, nodes meet the bucket's leader: the node that shares most buckets with
   others, so the text that a group of copies comes from leads in most of their buckets. Pairs
   of leader and node are distinct over all bands and are checked exactly, on all shingles of
   both texts: first each node with the leader it shares most buckets with, then the pairs that are not
   in one class by that. Verified links are joined to classes by connected components.
3. Nodes that share a bucket share its leader. So for every leader, those of its nodes that are
   not in its class meet all its other nodes, again exactly. Both sides are cut into blocks of
   about ``_BLOCK`` nodes; a task holds two blocks and returns one link per pair of classes. If
   most nodes are in their leader's class, this is a small rest. Together the two steps cover
   every two nodes that share a bucket.

No pairs within a group are spelled out and no task holds more than two blocks. Leaders and
counts are combined on the map side; joins on a hot leader or bucket have plain exchanges that
Spark can split.

Defined cases: texts of fewer words than a shingle have one shingle of all their words; a
missing text or one without words is in a class of its own; a missing id counts as the
smallest; a document is an id and a text, so different texts under one id (or without an id) are
documents of their own and equal rows are one; an empty table gives an empty result. Other
columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import bytetext, components, text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 5
_BLOCK = 512
_SMALLEST = -(1 << 63)
_SEEDS = (np.uint64(0x632BE59BD9B4E019), np.uint64(0xC2B2AE3D27D4EB4F))


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1)."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def darts(rows: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """Signatures, one row of ``k`` numbers per set; ``weights`` are positive.

    ``elements`` are 64-bit hashes, each once per set; ``rows`` is the set of each. Every set
    needs an element.
    """
    units = np.ceil(weights).astype(np.int64)
    strip_of = np.repeat(np.arange(len(elements)), units)
    layer = np.arange(len(strip_of)) - np.repeat(np.cumsum(units) - units, units)
    strips = bytetext.mix(elements[strip_of] + bytetext.mix(layer.astype(np.uint64)))
    height = np.minimum(weights[strip_of] - layer, 1.0)  # of the last strip, less than one
    strip_row = rows[strip_of]
    total = np.bincount(rows, weights, n_rows)
    border = k * (np.log(k) + 2) / total
    out = np.full(n_rows * k, np.iinfo(np.uint64).max, np.uint64)
    open_rows = np.ones(n_rows, bool)
    while open_rows.any():
        live = np.flatnonzero(open_rows[strip_row])
        bits, rank = strips[live], np.zeros(len(live))
        while live.size:
            bits = bytetext.mix(bits + _SEEDS[0])
            rank = rank - np.log(_uniform(bits))
            near = rank <= border[strip_row[live]]
            live, bits, rank = live[near], bits[near], rank[near]
            dart = bytetext.mix(bits + _SEEDS[1])
            hit = _uniform(bytetext.mix(dart)) < height[live]
            slot = strip_row[live] * k + (dart % np.uint64(k)).astype(np.int64)
            order = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)
            value = order | dart >> np.uint64(32)
            np.minimum.at(out, slot[hit], value[hit])
        open_rows = (out.reshape(n_rows, k) == np.iinfo(np.uint64).max).any(axis=1)
        border = np.where(open_rows, border * 2, border)
    return out.reshape(n_rows, k)


def shingle_table(words: bytetext.Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``rows``, ``shingles`` and their ``counts``, sorted by row and shingle, each pair once."""
    hashes, row, per_row = words.hashes(), words.rows(), np.diff(words.bounds)
    starts = np.flatnonzero((np.arange(len(hashes)) - words.bounds[row] + length) <= per_row[row])
    short = np.flatnonzero((per_row > 0) & (per_row < length))
    whole = np.zeros(len(short), np.uint64)
    for k in range(length - 1):
        has = per_row[short] > k
        whole[has] = bytetext.mix(whole[has] * bytetext._ODD + hashes[words.bounds[short[has]] + k])
    rows = np.concatenate((row[starts], short))
    shingles = np.concatenate((bytetext.runs(hashes, length)[starts] if len(starts) else np.zeros(0, np.uint64), whole))
    order = np.lexsort((shingles, rows))
    rows, shingles = rows[order], shingles[order]
    fresh = np.concatenate(([True], (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1])))[: len(rows)]
    first = np.flatnonzero(fresh)
    counts = np.diff(np.concatenate((first, [len(rows)])))
    return rows[first], shingles[first], counts


def strips_of(words: bytetext.Words, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted strip hashes: sets whose Jaccard similarity is the weighted one of the shingles."""
    rows, shingles, counts = shingle_table(words, length)
    layer = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    strips = bytetext.mix(np.repeat(shingles, counts) + bytetext.mix(layer.astype(np.uint64)))
    wide = np.repeat(rows, counts)
    strips = strips[np.lexsort((strips, wide))]
    cuts = np.searchsorted(wide, np.arange(words.last - words.first + 1))
    for d in range(words.last - words.first):
        yield words.first + d, strips[cuts[d] : cuts[d + 1]]


def _signed(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``doc``, ``node`` (16-byte fingerprint of the shingles; missing without words) and ``keys`` per band."""
    k = bands * rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in bytetext.chunks(batch.column(1)):
                n = words.last - words.first
                set_of, shingles, counts = shingle_table(words, shingle)
                has = np.zeros(n, bool)
                has[set_of] = True
                dense = (np.cumsum(has) - 1)[set_of]
                sketch = darts(dense, shingles, counts.astype(np.float64), int(has.sum()), k)
                keys = np.zeros((len(sketch), bands), np.uint64)
                for r in range(rows):
                    keys = bytetext.mix(keys * bytetext._ODD + sketch[:, r::rows])
                heavy = counts.astype(np.uint64)
                prints = np.zeros((int(has.sum()), 2), np.uint64)
                for i, seed in enumerate(_SEEDS):
                    np.add.at(prints[:, i], dense, bytetext.mix(bytetext.mix(shingles ^ seed) + heavy))
                node = np.full(n, None, object)
                node[has] = [p.tobytes() for p in prints]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(has) * bands)), pa.int32()), pa.array(keys.view(np.int64).ravel(), pa.int64())
                )
                size = np.bincount(set_of, counts, n).astype(np.int64)
                own = [batch.column(i).slice(words.first, n) for i in (0, 2)]
                yield pa.record_batch(
                    [*own, pa.array(node, pa.binary()), pa.array(size), lists], ["doc", "body_hash", "node", "size", "keys"]
                )

    schema = "doc long, body_hash long, node binary, size long, keys array<long>"
    return docs.withColumn("body_hash", F.xxhash64("body")).mapInArrow(task, schema)


def _strips(docs: DataFrame, shingle: int) -> DataFrame:
    """``node`` and its packed sorted strips, from one text of each node."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in bytetext.chunks(batch.column(1)):
                packed = [strips.tobytes() for _, strips in strips_of(words, shingle)]
                yield pa.record_batch(
                    [batch.column(0).slice(words.first, len(packed)), pa.array(packed, pa.binary())], ["node", "strips"]
                )

    return docs.mapInArrow(task, "node binary, strips binary")


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _verified(pairs: DataFrame, strips: DataFrame, similarity: float) -> DataFrame:
    """Links ``a``, ``b``: the pairs of leader and node whose exact similarity is high enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(left.as_buffer(), "<u8"), np.frombuffer(right.as_buffer(), "<u8")
                shared = _shared(x, y)
                keep.append(shared >= similarity * (len(x) + len(y) - shared) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = strips.select(F.col("node").alias("leader"), F.col("strips").alias("left"))
    right = strips.select("node", F.col("strips").alias("right"))
    joined = pairs.join(right, "node").join(left, "leader")
    ends = [F.col("leader").alias("a"), F.col("node").alias("b")]
    return joined.select(*ends, "left", "right").mapInArrow(task, "a binary, b binary")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of shared strips of every pair of a left and a right set."""
    elements, at = np.unique(np.concatenate(left + right), return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for start in range(0, len(elements), _BLOCK * 8):
        a, b = np.searchsorted(at, (start, start + _BLOCK * 8))
        held = np.zeros((len(left) + len(right), _BLOCK * 8), np.float32)
        held[owner[a:b], at[a:b] - start] = 1
        out += held[: len(left)] @ held[len(left) :].T
    return out


def _rest(groups: DataFrame, strips: DataFrame, similarity: float) -> DataFrame:
    """Links between nodes outside of their leader's class (``apart``) and its other nodes; step 3.

    ``groups`` has ``leader``, ``node``, ``root`` and ``apart``, each node once per leader.
    """
    sizes = groups.groupBy("leader").agg(F.count("*").alias("n"), F.sum(F.col("apart").cast("long")).alias("n_apart"))
    blocks = lambda n: F.ceil(F.col(n) / _BLOCK).cast("int")
    waiting = sizes.filter((F.col("n_apart") > 0) & (F.col("n") > 1)).select(
        "leader", blocks("n").alias("of_all"), blocks("n_apart").alias("of_apart")
    )
    full = groups.join(runtime.store(waiting, "waiting"), "leader").join(strips, "node")
    pick = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = full.filter("apart").select("leader", "node", "root", "strips", F.lit(True).alias("side"), pick("of_apart", 1).alias("x"), each("of_all").alias("y"))
    two = full.select("leader", "node", "root", "strips", F.lit(False).alias("side"), each("of_apart").alias("x"), pick("of_all", 2).alias("y"))

    def block(rows: pa.Table) -> pa.Table:
        sides = {}
        for side in (True, False):
            part = rows.filter(pa.compute.equal(rows.column("side"), side))
            held = [np.frombuffer(s.as_buffer(), "<u8") for c in part.column("strips").chunks for s in c]
            sides[side] = part.column("node").to_pylist(), part.column("root").to_pylist(), held
        found: dict[tuple[bytes, bytes], tuple[bytes, bytes]] = {}
        (nodes, roots, left), (others, their, right) = sides[True], sides[False]
        if left and right:
            shared = _overlaps(left, right)
            total = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :]
            for i, j in zip(*np.nonzero(shared >= similarity * (total - shared) - 1e-6)):
                if roots[i] != their[j]:
                    found.setdefault((roots[i], their[j]), (nodes[i], others[j]))
        ends = [pa.array([p[k] for p in found.values()], pa.binary()) for k in (0, 1)]
        return pa.table(ends, ["a", "b"])

    return one.union(two).groupBy("leader", "x", "y").applyInArrow(block, "a binary, b binary")


def classes(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    body: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``key``, ``class_id`` (smallest id of the class) and ``n_class``, one row per document.

    A class is a connected component of the links between documents.
    """
    kind = docs.schema[key].dataType
    named = lambda doc: F.when(F.col(doc) != _SMALLEST, F.col(doc)).cast(kind)
    return _classes(docs, key, body, shingle, similarity, bands, rows).select(
        named("doc").alias(key), named("first.doc").alias("class_id"), "n_class"
    )


def _identity(key: str, body: str) -> list[Column]:
    """``doc`` and ``body_hash``: a document is an id, the smallest if missing, and a text."""
    return [
        F.coalesce(F.col(key).cast("long"), F.lit(_SMALLEST)).alias("doc"),
        F.xxhash64(text.whole(F.col(body))).alias("body_hash"),
    ]


def _classes(docs: DataFrame, key: str, body: str, shingle: int, similarity: float, bands: int, rows: int) -> DataFrame:
    """``doc`` and ``body_hash`` of every document, ``first`` (the same two of the first of its class) and ``n_class``."""
    text.bound_batches(docs.sparkSession)
    narrow = docs.select(_identity(key, body)[0], text.whole(F.col(body)).alias("body"))
    signed = runtime.store(_signed(narrow, shingle, bands, rows), "signed")
    one_each = signed.select("doc", "body_hash", "node").distinct()
    own = F.struct("doc", "body_hash")
    heads = one_each.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min(own).alias("head"), F.count("*").alias("n"))
    links = _links(narrow, signed, shingle, similarity)
    found = components.connected_components(links, "a", "b").withColumnRenamed("component", "root")
    rooted = heads.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rooted.groupBy("root").agg(F.min("head").alias("first"), F.sum("n").alias("n_class"))
    named = runtime.store(rooted.select("node", "root").join(sizes, "root").select("node", "first", "n_class"), "named")
    return one_each.join(named, "node", "left").select(
        "doc", "body_hash", F.coalesce("first", own).alias("first"), F.coalesce("n_class", F.lit(1)).cast("long").alias("n_class")
    )


def _groups(signed: DataFrame, similarity: float) -> DataFrame:
    """``leader`` and ``node``, distinct, for every node that shares a bucket; ``near`` if their
    sizes allow the similarity, and ``shares``, the number of buckets they share."""
    nodes = signed.filter(F.col("node").isNotNull()).select("node", "size", "keys").distinct()  # before there is a row per band
    spread = nodes.select("node", "size", F.posexplode("keys").alias("band", "value"))
    placed = spread.select("node", "size", F.xxhash64("band", "value").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    buckets = runtime.store(placed.join(_small(runtime.store(shared, "shared")), "bucket"), "buckets")
    central = buckets.groupBy("node").agg(F.sum("n").alias("central"))
    ranked = runtime.store(buckets.join(central, "node"), "ranked")
    lead = F.max_by(F.struct("node", "size"), F.struct("central", "node")).alias("lead")
    leaders = runtime.store(ranked.groupBy("bucket").agg(lead).select("bucket", "lead"), "leaders")
    met = ranked.join(leaders, "bucket").filter(F.col("node") != F.col("lead.node"))
    near = F.least("size", "lead.size") >= similarity * F.greatest("size", "lead.size")
    pairs = met.select(F.col("lead.node").alias("leader"), "node", near.alias("near"))
    return pairs.groupBy("leader", "node", "near").agg(F.count("*").alias("shares"))


def _texts_of(narrow: DataFrame, sources: DataFrame) -> DataFrame:
    """``node`` and ``body``: one text of each node, taken out of the documents.

    Documents meet the wanted ones on the map side if those fit a broadcast; beyond that their texts are shuffled once.
    """
    texts = narrow.withColumn("body_hash", F.xxhash64("body"))
    return texts.join(_small(sources), ["doc", "body_hash"]).select("node", "body")


def _small(stored: DataFrame) -> DataFrame:
    """The table with a broadcast hint if its counted size allows one."""
    rows, size = stored.agg(F.count("*"), F.sum(runtime.row_bytes(stored))).first()
    return F.broadcast(stored) if runtime.fits_broadcast(rows, size) else stored


def _leader_links(groups: DataFrame, strips: DataFrame, similarity: float) -> DataFrame:
    """Verified links of leaders and nodes: enough of them to tell which leaders a node is in one class with.

    Every node first meets the leader that it shares most buckets with. Of the other pairs only those are compared
    that are in different classes after this, so a node of a group of copies is compared about once.
    """
    near = groups.filter("near").select("leader", "node", "shares")
    best = near.groupBy("node").agg(F.max_by("leader", F.struct("shares", "leader")).alias("leader"))
    first = runtime.store(_verified(best, strips, similarity), "links")
    found = runtime.store(components.connected_components(first, "a", "b"), "found")
    of = lambda end: found.select(F.col("node").alias(end), F.col("component").alias(f"{end}_root"))
    roots = near.join(of("node"), "node", "left").join(of("leader"), "leader", "left")
    apart = F.coalesce("node_root", "node") != F.coalesce("leader_root", "leader")
    rest = roots.filter(apart).select("leader", "node").join(best, ["leader", "node"], "left_anti")
    return runtime.store(first.union(_verified(rest, strips, similarity)), "links")


def _links(narrow: DataFrame, signed: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Verified links ``a``, ``b`` between nodes; see steps 2 and 3 above."""
    groups = runtime.store(_groups(signed, similarity), "groups")
    nodes = groups.select("node").union(groups.select("leader")).distinct()
    sources = (
        signed.join(nodes, "node", "left_semi")
        .groupBy("node")
        .agg(F.min(F.struct("doc", "body_hash")).alias("at"))
        .select("node", "at.doc", "at.body_hash")
    )
    sources = runtime.store(sources, "sources")
    strips = runtime.store(_strips(_texts_of(narrow, sources), shingle), "strips")
    links = _leader_links(groups, strips, similarity)
    found = runtime.store(components.connected_components(links, "a", "b"), "found")
    own = found.select("node", F.col("component").alias("root"))
    led = found.select(F.col("node").alias("leader"), F.col("component").alias("lead_root"))
    rooted = (
        groups.select("leader", "node")
        .join(own, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(led, "leader", "left")
        .withColumn("apart", F.col("root") != F.coalesce("lead_root", "leader"))
        .drop("lead_root")
    )
    return runtime.store(links.union(_rest(runtime.store(rooted, "rooted"), strips, similarity)), "links")


def keep_one(docs: DataFrame, *, key: str = "doc_id", body: str = "text") -> DataFrame:
    """The documents without those that are not the first (smallest id, then hash of the text) of their class.

    Equal rows are one document; all rows of the kept one stay.
    """
    found = _classes(docs, key, body, SHINGLE, SIMILARITY, BANDS, ROWS)
    doc, body_hash = _identity(key, body)
    others = found.filter((F.col("doc") != F.col("first.doc")) | (F.col("body_hash") != F.col("first.body_hash")))
    later = others.select(F.col("doc").alias("near_dedup__doc"), F.col("body_hash").alias("near_dedup__body"))
    same = (doc == F.col("near_dedup__doc")) & (body_hash == F.col("near_dedup__body"))
    return docs.join(runtime.store(later, "later"), same, "left_anti")


@CATALOG.query()
def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return classes(text.table(spark, folder, "documents").select("doc_id", "text"))
