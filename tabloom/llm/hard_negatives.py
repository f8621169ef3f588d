"""Hard negatives: for each anchor and positive, the closest rows of other labels inside a window of scores.

A row's score is the inner product with the anchor. A positive of score p opens the window from
``low`` to ``high`` percent of p. The windows of an anchor overlap, but their upper limits cut the
scores into disjoint slots, and a window's first rows are the first ones at or below its upper limit:

1. Rows meet anchors in a grid: anchors are dealt to blocks of about ``_ANCHORS``, rows to strips, and a
   cell holds one of each. There are about three cells per shuffle partition (one per block at least), so a
   row is copied once per block of anchors and an anchor once per strip, and what all cells return
   grows with the anchors, not with the pairs. A cell's anchors come first, its rows pass batch by
   batch, and only the best rows of each anchor are held.
2. The first run of the grid keeps each anchor's best rows of its own label, the positives.
3. The second keeps the first ``most`` rows of other labels in every slot of every anchor. This is all any
   window needs, for each row counts for one slot only.
4. Cells are combined per anchor and slot. From the lowest slot up, the first ``most`` rows of a slot followed by
   those of the slots below are what its window can hold; its lower limit cuts the list.

No pair of a row and an anchor is ever a row of a table: scores are products of matrices in a task,
which holds a block of anchors and a piece of a batch of rows.

Defined cases: rows with a missing label, a missing vector or a component that is missing or not
finite take no part; a row meets only anchors with as many components; a row without an id is no
anchor, and as a positive or negative it comes after all ids of its score; rows with the anchor's own id
are not among its positives; equal rows are rows of their own, and so are anchors that share an id; a
positive below zero has an empty window; products beyond 64 bits are an error; an empty table gives an empty result.
Only the three named columns are read, under names of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score
SCALE = 256
ANCHOR_EVERY = 100
CHANGED_EVERY, CLASSES = 7, 10
_ANCHORS = 16_384  # of a block, about
_STRIP = 4096  # rows that a strip holds at least, about
_TILE = 1 << 20  # scores computed at once
_NO_ID = np.iinfo(np.int64).max
_LOWEST = np.iinfo(np.int64).min


def prepared(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """``id``, ``label`` and ``vector``, whole numbers packed as 64-bit integers, of the rows that take part; stored."""
    component = F.col("v").cast("array<double>")
    narrow = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fit = narrow.withColumn("v", component).filter(F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite))
    steps = fit.select("id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False)).tolist()
            values = column.flatten().to_numpy(zero_copy_only=False).astype("<i8")
            packed = [values[a:b].tobytes() for a, b in zip([0, *ends], ends)]
            yield pa.record_batch([*batch.columns[:2], pa.array(packed, pa.binary())], ["id", "label", "vector"])

    return runtime.store(steps.mapInArrow(task, "id long, label long, vector binary"), "vectors")


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as 64-bit integers."""
    if not left.shape[1]:
        return np.zeros((len(left), len(right)), np.int64)
    largest = float(np.abs(left.astype(np.float64)).max(initial=0)) * float(np.abs(right.astype(np.float64)).max(initial=0)) * left.shape[1]
    if largest * 100 >= 2.0**63:
        raise OverflowError("inner products need more than 64 bits")
    if largest < 2.0**53:  # every sum is exact in a double
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Packed vectors of one size as rows."""
    ends = np.frombuffer(vectors.buffers()[1], np.int32)[vectors.offset : vectors.offset + len(vectors) + 1]
    if not size:
        return np.zeros((len(vectors), 0), np.int64)
    return np.frombuffer(vectors.buffers()[2], np.uint8)[ends[0] : ends[-1]].view("<i8").reshape(len(vectors), size // 8)


class _Best:
    """The first ``most`` rows of every list, by score and then id, of what has been added."""

    def __init__(self, lists: int, most: int):
        self.most = most
        self.scores = np.full((lists, most), _LOWEST, np.int64)
        self.ids = np.full((lists, most), _NO_ID, np.int64)
        self.held = np.zeros(lists, np.int64)

    def least(self) -> np.ndarray:
        """Per list, the score that a row must reach to matter."""
        return np.where(self.held < self.most, _LOWEST, self.scores[:, -1])

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        lists = np.unique(at)
        filled = np.arange(self.most) < self.held[lists][:, None]
        every = np.concatenate((at, np.repeat(lists, self.held[lists])))
        scores = np.concatenate((scores, self.scores[lists][filled]))
        ids = np.concatenate((ids, self.ids[lists][filled]))
        order = np.lexsort((ids, -scores, every))
        every, scores, ids = every[order], scores[order], ids[order]
        begins = np.searchsorted(every, lists)
        place = np.arange(len(every)) - np.repeat(begins, np.diff(np.append(begins, len(every))))
        keep = place < self.most
        every, place = every[keep], place[keep]
        self.scores[every, place], self.ids[every, place] = scores[keep], ids[keep]
        self.held[lists] = np.bincount(every, minlength=len(self.held))[lists]


class _Cell:
    """One cell of the grid: a block of anchors, and the best rows seen for each of their slots."""

    def __init__(self, same_label: bool, slots: int, most: int):
        self.same_label, self.slots, self.most = same_label, slots, most
        self.given: list[pa.RecordBatch] = []
        self.groups: dict[int, tuple] | None = None  # by bytes of a vector

    def close_anchors(self) -> None:
        rows = pa.Table.from_batches(self.given).combine_chunks().to_batches()[0]
        sizes = pc.binary_length(rows.column("vector")).to_numpy()
        limits = np.full((len(rows), self.slots), _LOWEST, np.int64)
        for i, values in enumerate(rows.column("limits").to_pylist()):
            limits[i, : len(values or [])] = values or []
        self.groups, self.given = {}, []
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            part = rows.take(pa.array(at))
            own = part.column("id").fill_null(_NO_ID).to_numpy()
            best = _Best(len(at) * self.slots, self.most)
            self.groups[size] = _matrix(part.column("vector"), size), part.column("anchor").to_numpy(), own, part.column("label").to_numpy(), limits[at], best

    def add(self, rows: pa.RecordBatch) -> None:
        sizes = pc.binary_length(rows.column("vector")).to_numpy()
        for size in set(np.unique(sizes).tolist()) & set(self.groups):
            part = rows.take(pa.array(np.flatnonzero(sizes == size)))
            vectors, labels = _matrix(part.column("vector"), size), part.column("label").to_numpy()
            ids = part.column("id").fill_null(_NO_ID).to_numpy()
            if self.same_label:  # rows of a label meet anchors of that label only
                for label in np.unique(labels):
                    near, pick = np.flatnonzero(self.groups[size][3] == label), labels == label
                    self._meet(size, near, vectors[pick], ids[pick], labels[pick])
            else:
                self._meet(size, np.arange(len(self.groups[size][1])), vectors, ids, labels)

    def _meet(self, size: int, near: np.ndarray, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        matrix, _, own, their, limits, best = self.groups[size]
        if not len(near) or not len(ids):
            return
        high = max(1, _TILE // len(ids))
        for first in range(0, len(near), high):
            part = near[first : first + high]
            scores = products(matrix[part], vectors)
            if self.same_label:
                slot = np.zeros(scores.shape, np.int64)
                fit = ids[None, :] != own[part][:, None]
            else:  # slot i is above the limits from i + 1 on
                slot = (limits[part][:, :, None] >= scores[:, None, :]).sum(axis=1) - 1
                fit = (their[part][:, None] != labels[None, :]) & (slot >= 0)
            at = part[:, None] * self.slots + np.maximum(slot, 0)
            fit &= scores >= best.least()[at]
            if fit.any():
                best.add(at[fit], scores[fit], np.broadcast_to(ids, scores.shape)[fit])

    def results(self) -> Iterator[pa.RecordBatch]:
        for _, anchors, _, _, _, best in (self.groups or {}).values():
            lists, places = np.nonzero(np.arange(best.most) < best.held[:, None])
            ids = best.ids[lists, places]
            columns = [
                pa.array(anchors[lists // self.slots], pa.int64()),
                pa.array((lists % self.slots).astype(np.int32)),
                pa.array(best.scores[lists, places]),
                pa.array(ids, pa.int64(), mask=ids == _NO_ID),
            ]
            yield pa.record_batch(columns, ["anchor", "slot", "score", "id"])


def _first(rows: DataFrame, group: list[str], most: int, out: str) -> DataFrame:
    """The first rows of each group by score and id, numbered from 1; groups hold a few rows per strip."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= most)


def _grid(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, *, same_label: bool, slots: int, most: int) -> DataFrame:
    """``anchor``, ``slot``, ``score``, ``id`` and ``place``: the first ``most`` rows of every slot of every anchor.

    ``anchors`` has ``anchor`` (a number of its own), ``id``, ``label``, ``vector`` and the slots' upper ``limits``, falling.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n_anchors // _ANCHORS))
    strips = max(1, min(3 * tasks // blocks, -(-n_rows // _STRIP)))  # several cells a task even out their sizes
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, *by: F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")
    ours = anchors.select(
        dealt(blocks, "anchor").alias("block"), each(strips).alias("strip"), F.lit(False).alias("is_row"),
        "anchor", "id", "label", "limits", "vector",
    )
    theirs = rows.select(
        each(blocks).alias("block"), dealt(strips, "id", "vector").alias("strip"), F.lit(True).alias("is_row"),
        F.lit(None).cast("long").alias("anchor"), "id", "label", F.lit(None).cast("array<long>").alias("limits"), "vector",
    )
    cells = ours.unionByName(theirs).repartition(min(tasks, blocks * strips), "block", "strip")
    placed = cells.sortWithinPartitions("block", "strip", "is_row")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, place = None, None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, len(batch)]):
                if place != (keys[0, a], keys[1, a]):
                    if cell:
                        yield from cell.results()
                    cell, place = _Cell(same_label, slots, most), (keys[0, a], keys[1, a])
                part = batch.slice(a, b - a)
                if not keys[2, a]:
                    cell.given.append(part)
                    continue
                if cell.given:
                    cell.close_anchors()
                if cell.groups:
                    cell.add(part)
        if cell:
            yield from cell.results()

    found = placed.mapInArrow(task, "anchor long, slot int, score long, id long")
    return _first(found, ["anchor", "slot"], most, "place")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``vectors`` comes from :func:`prepared`; ``is_anchor`` is a condition on its columns.
    """
    text.bound_batches(vectors.sparkSession)
    chosen = vectors.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id())
    anchors = runtime.store(chosen, "anchors")  # numbers stay as they are from here on
    size = {"n_rows": vectors.count(), "n_anchors": anchors.count()}
    everything = anchors.withColumn("limits", F.lit(None).cast("array<long>"))
    near = runtime.store(_grid(vectors, everything, **size, same_label=True, slots=1, most=positives), "positives")
    limit = F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100")
    listed = near.groupBy("anchor").agg(F.sort_array(F.collect_list(limit), False).alias("limits"))  # ``positives`` at most
    found = _grid(vectors, anchors.join(listed, "anchor"), **size, same_label=False, slots=positives, most=negatives)
    entry = F.struct("place", "score", "id")
    lists = found.groupBy("anchor").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("slot") == i, entry))).alias(f"slot_{i}") for i in range(positives)]
    )
    suffix, windows = F.array().cast("array<struct<place:int,score:bigint,id:bigint>>"), []
    for i in reversed(range(positives)):  # a slot's rows come before those of all slots below
        suffix = F.slice(F.concat(F.col(f"slot_{i}"), suffix), 1, negatives)
        windows.insert(0, suffix)
    held = lists.select("anchor", F.array(*windows).alias("held"))
    opened = near.join(held, "anchor").join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    inside = F.filter(F.element_at("held", F.col("place")), lambda x: x["score"] * 100 >= F.col("score") * low)
    return opened.select(
        "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(inside).alias("at", "found")
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("found.id").alias("negative_id"),
        "positive_score",
        F.col("found.score").alias("negative_score"),
    )


@CATALOG.query(
    f"""
    WITH vectors AS (
      SELECT row_number() OVER () AS r, vec_id AS id,
        CASE WHEN vec_id % {CHANGED_EVERY} = 0 THEN (label + 1) % {CLASSES} ELSE label END AS label,
        list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
      SELECT a.r, a.id AS anchor_id, b.id, a.label = b.label AS same,
        coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
      FROM vectors a JOIN vectors b ON len(a.v) = len(b.v) WHERE a.id % {ANCHOR_EVERY} = 0
    ),
    positives AS (
      SELECT r, anchor_id, id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, id NULLS LAST) AS p
      FROM scored WHERE same AND id IS DISTINCT FROM anchor_id QUALIFY p <= {POSITIVES}
    )
    SELECT p.anchor_id, p.id AS positive_id,
      (row_number() OVER (PARTITION BY p.r, p.p ORDER BY n.score DESC, n.id NULLS LAST))::INT AS rank,
      n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n
      ON p.r = n.r AND NOT n.same AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
    QUALIFY rank <= {NEGATIVES}
    """
)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    changed = (F.col("label") + 1) % CLASSES
    label = F.when(F.col("vec_id") % CHANGED_EVERY == 0, changed).otherwise(F.col("label"))
    vectors = text.table(spark, folder, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return mine(prepared(vectors), F.col("id") % ANCHOR_EVERY == 0)
