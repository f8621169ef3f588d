"""Drop lines that many documents share, keeping them in one document.

A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys of at
least ``least_chars`` characters held by at least ``least_docs`` documents lose all their lines
except in the largest document id that holds them.

Two Bloom filters say which keys may be in more than one document. Each task sets bits for the
keys of its documents; the bits of all tasks are merged segment by segment, streaming, into a
filter of bits set once and one of bits set twice or more. Only the second is sent out. A key
whose bits are all in it is a suspect, and only suspects are shuffled: a 16-byte digest and the
row, from which documents are counted exactly.

The filters grow with the table: ``LINE_BITS`` bits for every line that may have a key, counted
first. They are cut by hash into slices of at most ``SLICE_BITS``, and one slice at a time is sent out,
with one scan of the texts each, so what an executor holds of them is bounded. From ``MOST_SLICES``
slices on (about a billion lines) the filters stay as they are; more keys are then suspects by chance,
which costs shuffled rows and changes no result.

Defined cases: a missing text is an empty one, and an empty text is one empty line; a missing
document id counts as the smallest; rows that share an id are one document, and keep or lose
their lines together, each row by a list of its own. An empty table gives an empty result. Added columns replace columns of
the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom import runtime
from tabloom.llm import text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

LEAST_CHARS = 20
LEAST_DOCS = 3
LINE_BITS = 8
SLICE_BITS = 1 << 29
MOST_SLICES = 16
_SEGMENT_BITS = 1 << 17
_FLUSH = 500_000
_WHITE = text.WHITE.encode()
_SMALLEST = -(1 << 63)


def line_digest(line: bytes, least_chars: int) -> bytes | None:
    """Digest of a line's key, or nothing if the key is short."""
    key = line.strip(_WHITE)
    if len(key) < least_chars or len(key) < 4 * least_chars and len(key.decode("utf-8", "replace")) < least_chars:
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def _digests(column: pa.Array, least_chars: int) -> Iterator[set[bytes]]:
    """Distinct key digests of each text; one text at a time is a Python object."""
    for value in column.cast(pa.binary()):
        body = value.as_py() or b""
        found = {line_digest(line, least_chars) for line in body.split(b"\n")}
        found.discard(None)
        yield found


def counted_bits(texts: DataFrame, least_chars: int) -> int:
    """Bits for all lines of the texts that may have a key, a power of two."""
    body = text.whole(F.col(texts.columns[0]))
    lines = F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit(""))) + 1
    fitting = F.floor((F.octet_length(body) + 1) / (least_chars + 1))
    most = texts.agg(F.sum(F.least(lines, fitting)).alias("n")).first()["n"] or 0
    return min(max(1 << (LINE_BITS * most - 1).bit_length(), _SEGMENT_BITS), MOST_SLICES * SLICE_BITS)


def _positions(digests: list[bytes], bits: int) -> np.ndarray:
    """Two bits of the filter for each digest, both in the slice that its last bits name."""
    words = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    own = min(bits, SLICE_BITS)
    slices = np.uint64(bits // own)
    return (words & np.uint64(own - 1)) + ((words[:, 1:] >> np.uint64(40)) % slices) * np.uint64(own)


def _set_bits(texts: DataFrame, bits: int, least_chars: int) -> DataFrame:
    """Per task and segment of the filter: positions set by its keys, once and more often."""

    def flush(pending: list[bytes]) -> pa.RecordBatch:
        at, count = np.unique(_positions(pending, bits), return_counts=True)
        segment = (at // _SEGMENT_BITS).astype(np.int32)
        inside = (at % _SEGMENT_BITS).astype("<u4")
        ids, first = np.unique(segment, return_index=True)
        once = [part.tobytes() for part in np.split(inside, first[1:])]
        twice = [part[n > 1].tobytes() for part, n in zip(np.split(inside, first[1:]), np.split(count, first[1:]))]
        return pa.record_batch([pa.array(ids), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["segment", "once", "twice"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[bytes] = []
        for batch in batches:
            for found in _digests(batch.column(0), least_chars):
                pending.extend(found)
                if len(pending) >= _FLUSH:
                    yield flush(pending)
                    pending = []
        if pending:
            yield flush(pending)

    return texts.mapInArrow(task, "segment int, once binary, twice binary")


def _merge_bits(parts: DataFrame, segments: int) -> DataFrame:
    """``segment`` and ``bits`` set twice; a task holds its segments' two filters and streams the parts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for segment, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if segment not in filters:
                    filters[segment] = (np.zeros(_SEGMENT_BITS, bool), np.zeros(_SEGMENT_BITS, bool))
                seen, again = filters[segment]
                at = np.frombuffer(once, "<u4")
                again[at[seen[at]]] = True
                again[np.frombuffer(twice, "<u4")] = True
                seen[at] = True
        ids = sorted(s for s, (_, again) in filters.items() if again.any())
        packed = [np.packbits(filters[s][1], bitorder="little").tobytes() for s in ids]
        yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(packed, pa.binary())], ["segment", "bits"])

    parallel = max(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), segments // 128)  # 32 MB a task
    return parts.repartition(parallel, "segment").mapInArrow(task, "segment int, bits binary")


def twice_filter(merged: DataFrame, number: int, bits: int) -> np.ndarray:
    """One packed slice of the filter of bits set twice, ``bits`` / 8 bytes."""
    packed, width = np.zeros(bits // 8, np.uint8), _SEGMENT_BITS // 8
    first = number * (bits // _SEGMENT_BITS)
    own = merged.filter((F.col("segment") >= first) & (F.col("segment") < first + bits // _SEGMENT_BITS))
    for row in own.toLocalIterator():  # at most the slice
        start = (row["segment"] - first) * width
        packed[start : start + width] = np.frombuffer(row["bits"], np.uint8)
    return packed


def suspects(docs: DataFrame, key: str, body: str, bits: int | None, least_chars: int) -> DataFrame:
    """``doc``, ``body_hash`` and ``digest`` of keys whose bits are all set twice, once per row and key; stored."""
    narrow = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_SMALLEST)).alias("doc"), F.xxhash64(body).alias("body_hash"), F.col(body).alias("body")
    )
    bits = bits or counted_bits(narrow.select("body"), least_chars)
    own = min(bits, SLICE_BITS)
    merged = _merge_bits(_set_bits(narrow.select("body"), bits, least_chars), bits // _SEGMENT_BITS)
    merged = runtime.store(merged, "filter")
    found = None
    for number in range(bits // own):
        sent = docs.sparkSession.sparkContext.broadcast(twice_filter(merged, number, own))

        def task(batches: Iterator[pa.RecordBatch], sent=sent, number=number) -> Iterator[pa.RecordBatch]:
            packed = sent.value
            for batch in batches:
                per_doc = [list(found) for found in _digests(batch.column(2), least_chars)]
                flat = [d for found in per_doc for d in found]
                if not flat:
                    continue
                at = _positions(flat, bits)
                row = np.repeat(np.arange(len(per_doc)), [len(found) for found in per_doc])
                mine = np.flatnonzero(at[:, 0] // np.uint64(own) == number)
                inside = at[mine] & np.uint64(own - 1)
                hit = (packed[inside >> np.uint64(3)] >> (inside & np.uint64(7)).astype(np.uint8)) & 1
                keep = mine[hit.all(axis=1)]
                place = pa.array(row[keep])
                digests = pa.array([flat[i] for i in keep], pa.binary())
                yield pa.record_batch([batch.column(0).take(place), batch.column(1).take(place), digests], ["doc", "body_hash", "digest"])

        part = runtime.store(narrow.mapInArrow(task, "doc long, body_hash long, digest binary"), "suspects")
        sent.unpersist()
        found = part if found is None else found.union(part)
    return found


def lines_to_drop(found: DataFrame, least_docs: int) -> DataFrame:
    """``doc``, ``body_hash`` and ``drop``, the digests of the lines a row loses. Counts are combined on the map side."""
    counted = found.groupBy("digest").agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("keeper"))
    # stored, so that the join below has a plain exchange of suspects that Spark can split
    decided = runtime.store(counted.filter(F.col("docs") >= least_docs).select("digest", "keeper"), "decided")
    lost = found.join(decided, "digest").filter(F.col("doc") != F.col("keeper"))
    return lost.groupBy("doc", "body_hash").agg(F.collect_set("digest").alias("drop"))


def dedup_lines(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    body: str = "text",
    least_docs: int = LEAST_DOCS,
    least_chars: int = LEAST_CHARS,
    filter_bits: int | None = None,
) -> DataFrame:
    """The documents without the dropped lines, ``n_lines`` (before) and ``n_dropped``.

    ``filter_bits`` sets the size of a filter, a power of two, in place of the counted one.
    """
    text.bound_batches(docs.sparkSession)
    plain = docs.drop("n_lines", "n_dropped")
    drops = lines_to_drop(suspects(plain, key, body, filter_bits, least_chars), least_docs)
    place, hashed = "line_dedup__doc", "line_dedup__body"
    joined = (
        plain.withColumns({place: F.coalesce(F.col(key).cast("long"), F.lit(_SMALLEST)), hashed: F.xxhash64(body)})
        .join(drops.withColumnsRenamed({"doc": place, "body_hash": hashed, "drop": "line_dedup__drop"}), [place, hashed], "left")
        .drop(place, hashed)
    )
    names = plain.columns
    at = names.index(body)

    def rewrite(whole: bytes, drop: list[bytes]) -> tuple[bytes, int, int]:
        lines, gone = whole.split(b"\n"), set(drop)
        stay = [line for line in lines if line_digest(line, least_chars) not in gone]
        return b"\n".join(stay), len(lines), len(lines) - len(stay)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(at).cast(pa.binary()).to_pylist()
            drops = batch.column(len(names)).to_pylist()
            rows = [
                rewrite(b or b"", d) if d else ((b or b""), (b or b"").count(b"\n") + 1, 0)
                for b, d in zip(bodies, drops)
            ]
            columns = batch.columns[: len(names)]
            columns[at] = pa.array([r[0] for r in rows], pa.binary()).cast(batch.schema.field(at).type)
            counts = [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2)]
            yield pa.record_batch([*columns, *counts], [*names, "n_lines", "n_dropped"])

    fields = [f if f.name != body else T.StructField(body, T.StringType()) for f in plain.schema.fields]
    added = [T.StructField(n, T.LongType()) for n in ("n_lines", "n_dropped")]
    return joined.mapInArrow(task, T.StructType([*fields, *added]))


@CATALOG.query(
    rf"""
    WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    lines AS (
      SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
    ),
    keyed AS (
      SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM lines
    ),
    decided AS (
      SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {LEAST_CHARS}
      GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}
    ),
    marked AS (
      SELECT k.*, coalesce(k.doc_id <> d.keeper, false) AS dropped FROM keyed k LEFT JOIN decided d ON k.key = d.key
    )
    SELECT doc_id, count(*)::BIGINT AS n_lines, sum(dropped::INT)::BIGINT AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """
)
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = text.table(spark, folder, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("text").cast("binary"), 256)
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))
