"""Remove passages that start earlier in the corpus, found through difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document. Every word is removed that is covered
by a window whose words also start earlier: in a smaller document id, or before it in the same
document. Windows are judged on the input.

Hashing every window would shuffle every word. Instead, shorter runs of words (anchors) are
hashed at positions that lie in a difference cover modulo a period: for any two positions some
common shift below the period moves both into the cover, so two equal windows always share an
anchor at the same place inside them. About a third of the positions are hashed.

1. Anchor hashes go to buckets, packed, where those that occur twice are found. A task first
   settles those that repeat among its own documents, so it sends each hash once.
2. Only around repeated anchors, windows are hashed in full (80 bits), and the earliest start of
   every window is found the same way. All others are removed.
3. Documents drop the covered words. Texts are shuffled once, by a hash of id and text (the tag),
   and used by steps 2 and 3; removals name the id and the tag.

There are about as many buckets and shards as shuffle partitions; a task holds one at a time (the
texts of a shard, or its share of the hashes), so that setting has to grow with the data. A passage that most documents hold
reaches a bucket once per task; the documents that hold it are spread over all shards.

Defined cases: a missing text has no words; a missing id counts as the smallest; rows with the
same id compare by position only, each row losing the words of its own text, so equal rows keep or
lose the same words; words in texts shorter than a window stay; an empty table gives an empty
result. Only the columns named in ``dedup_passages`` are returned. If many different texts under
one id hold a passage at the same place, none of them is earlier, and its bucket gets all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import bytetext, text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

WINDOW = 20
# Perfect difference sets by period.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
_LEAST_ANCHOR = 8
_PER_PARTITION = 1
_FLUSH = 2_000_000
_SMALLEST = -(1 << 63)
_LOW48 = np.uint64((1 << 48) - 1)
_PACKED = "place int, docs binary, lows binary, highs binary, starts binary, tags binary"


def period_for(window: int) -> int:
    """The longest period that leaves anchors of ``_LEAST_ANCHOR`` words."""
    fits = [p for p in COVERS if window - p + 1 >= _LEAST_ANCHOR]
    if not fits:
        raise ValueError(f"a window needs at least {min(COVERS) + _LEAST_ANCHOR - 1} words")
    return max(fits)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in the narrowest type, named by the first byte."""
    kind = np.min_scalar_type(int(values.max()) if values.size else 0)
    return bytes([kind.itemsize]) + values.astype(f"<u{kind.itemsize}").tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.uint64)


def _pack_ids(ids: np.ndarray) -> bytes:
    """Ascending ids as steps from the first one."""
    if not ids.size:
        return b""
    return int(ids[0]).to_bytes(8, "little", signed=True) + _pack(np.diff(ids).view(np.uint64))


def _unpack_ids(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int64)
    steps = np.concatenate((np.zeros(1, np.uint64), _unpack(packed[8:]))).cumsum(dtype=np.uint64)
    return steps.view(np.int64) + np.int64(int.from_bytes(packed[:8], "little", signed=True))


def _parts(place: np.ndarray, docs: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """One packed row per place; a missing column stays empty."""
    order = np.lexsort((docs, place))
    place, docs = place[order], docs[order]
    ids, first = np.unique(place, return_index=True)
    cuts = [*first, len(place)]
    rows = list(zip(cuts[:-1], cuts[1:]))
    out: dict[str, list[bytes]] = {"docs": [_pack_ids(docs[a:b]) for a, b in rows]}
    for name in ("lows", "highs", "starts", "tags"):
        if name not in columns:
            out[name] = [b""] * len(rows)
            continue
        values = columns[name][order]
        if name == "lows":  # six bytes each
            raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            out[name] = [raw[a:b].tobytes() for a, b in rows]
        else:
            out[name] = [_pack(values[a:b]) for a, b in rows]
    arrays = [pa.array(ids, pa.int32()), *(pa.array(v, pa.binary()) for v in out.values())]
    return pa.record_batch(arrays, ["place", *out])


def _unpack_parts(parts: pa.Table) -> tuple[np.ndarray, ...]:
    """``docs``, ``lows``, ``highs``, ``starts`` and ``tags`` of all rows; absent ones are empty."""
    found = []
    for name, read, kind in (
        ("docs", _unpack_ids, np.int64),
        ("lows", _six_bytes, np.uint64),
        ("highs", _unpack, np.uint64),
        ("starts", _unpack, np.uint64),
        ("tags", _unpack, np.uint64),
    ):
        each = [read(p) for p in parts.column(name).to_pylist() if p]
        found.append(np.concatenate(each) if each else np.zeros(0, kind))
    return tuple(found)


def _six_bytes(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _shard(tags: np.ndarray, shards: int) -> np.ndarray:
    return (tags.view(np.int64) % shards).astype(np.int32)


def _shard_column(tag: str, shards: int):
    return F.pmod(F.col(tag), F.lit(shards)).cast("int")


def _prime_from(n: int) -> int:
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _anchors(words: bytetext.Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (word numbers in the chunk) and 48-bit hashes of anchors that lie in a window."""
    period = period_for(window)
    length = window - period + 1
    row = words.rows()
    inside = np.arange(len(hashes)) - words.bounds[row]
    count = np.diff(words.bounds)[row]
    cover = np.zeros(period, bool)
    cover[list(COVERS[period])] = True
    at = np.flatnonzero(cover[inside % period] & (inside + length <= count) & (count >= window))
    return at, bytetext.runs(hashes, length)[at] & _LOW48 if at.size else np.zeros(0, np.uint64)


def _send_anchors(texts: DataFrame, window: int, shards: int) -> DataFrame:
    """Packed (shard, anchor hash), the shard in the place of the document: once per task and hash to
    the hash's place; and, below the places, to the shard if the hash is known to repeat."""

    def flush(homes: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((homes, hashes))
        homes, hashes = homes[order], hashes[order]
        fresh = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        size = np.diff(np.concatenate((np.flatnonzero(fresh), [len(hashes)])))
        known = np.repeat(size > 1, size)
        place = (hashes[fresh] % np.uint64(shards)).astype(np.int32)
        yield _parts(place, homes[fresh], lows=hashes[fresh])
        novel = known & (fresh | np.concatenate(([True], homes[1:] != homes[:-1])))
        if novel.any():
            yield _parts(-1 - homes[novel].astype(np.int32), homes[novel], lows=hashes[novel])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, count = [], 0
        for batch in batches:
            homes = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for words in bytetext.chunks(batch.column(1)):
                at, hashes = _anchors(words, words.hashes(), window)
                pending.append((homes[words.first : words.last][words.rows()[at]], hashes))
                count += len(at)
                if count >= _FLUSH:
                    yield from flush(*map(np.concatenate, zip(*pending)))
                    pending, count = [], 0
        if count:
            yield from flush(*map(np.concatenate, zip(*pending)))

    return texts.select("place", "body").mapInArrow(task, _PACKED)


def _repeated_anchors(sent: DataFrame, shards: int) -> DataFrame:
    """Per shard: the packed hashes of its anchors that occur twice."""

    def place(parts: pa.Table) -> pa.Table:
        homes, hashes, *_ = _unpack_parts(parts)
        if not len(homes) or parts.column("place")[0].as_py() < 0:
            return pa.table(parts.set_column(0, "place", _lifted(parts.column("place"))))
        order = np.argsort(hashes, kind="stable")
        homes, hashes = homes[order], hashes[order]
        same = hashes[1:] == hashes[:-1]
        twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
        return pa.Table.from_batches([_parts(homes[twice].astype(np.int32), homes[twice], lows=hashes[twice])])

    return sent.groupBy("place").applyInArrow(place, _PACKED)


def _lifted(places: pa.ChunkedArray) -> pa.Array:
    return pa.array([-1 - p for p in places.to_pylist()], pa.int32())


def _send_windows(texts: DataFrame, repeated: DataFrame, window: int, shards: int) -> DataFrame:
    """Packed (document, tag, start, hash) of windows that hold a repeated anchor; the earliest of each
    hash in the shard goes to the hash's place, the others to their document's shard."""
    reach = period_for(window) - 1
    odd = np.uint64(0xD6E8FEB86659FD93)

    def shard(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = np.unique(_unpack_parts(right)[1])
        found = []
        for batch in left.combine_chunks().to_batches() if len(wanted) else []:
            ids, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
            for words in bytetext.chunks(batch.column("body")):
                hashes = words.hashes()
                at, anchors = _anchors(words, hashes, window)
                row = words.rows()
                own, mark = ids[words.first : words.last], marks[words.first : words.last].view(np.uint64)
                spot = np.minimum(np.searchsorted(wanted, anchors), len(wanted) - 1)
                at = at[wanted[spot] == anchors]
                begin = np.maximum(at - reach, words.bounds[row[at]])
                stop = np.minimum(at, words.bounds[row[at] + 1] - window) + 1
                steps = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(steps, begin, 1)
                np.add.at(steps, stop, -1)
                starts = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
                if not starts.size:
                    continue
                low, high = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
                for k in range(window):
                    word = hashes[starts + k]
                    low = low * bytetext._ODD + word
                    high = (high ^ word) * odd
                low, high = bytetext.mix(low) & _LOW48, bytetext.mix(high) >> np.uint64(32)
                begin = (starts - words.bounds[row[starts]]).astype(np.uint64)
                found.append((own[row[starts]], mark[row[starts]], begin, low, high))
        if not found:
            return pa.Table.from_batches([], _schema())
        docs, tags, starts, low, high = map(np.concatenate, zip(*found))
        order = np.lexsort((tags, starts, docs, high, low))
        docs, tags, starts, low, high = docs[order], tags[order], starts[order], low[order], high[order]
        fresh = np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
        again = ~fresh & _later(docs, starts, fresh)
        sent = ~again & (fresh | np.concatenate(([True], tags[1:] != tags[:-1])))  # with the first, other texts that tie
        place = (low[sent] % np.uint64(shards)).astype(np.int32)
        out = [_parts(place, docs[sent], lows=low[sent], highs=high[sent], starts=starts[sent], tags=tags[sent])]
        if again.any():
            out.append(_parts(-1 - _shard(tags[again], shards), docs[again], starts=starts[again], tags=tags[again]))
        return pa.Table.from_batches(out)

    return texts.groupBy("place").cogroup(repeated.groupBy("place")).applyInArrow(shard, _PACKED)


def _schema() -> pa.Schema:
    return pa.schema([("place", pa.int32()), *((n, pa.binary()) for n in ("docs", "lows", "highs", "starts", "tags"))])


def _later(docs: np.ndarray, starts: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Whether an entry starts after the first of its group (rows with one id may tie)."""
    head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    return (docs != docs[head]) | (starts != starts[head])


def _removed_windows(sent: DataFrame, shards: int) -> DataFrame:
    """Per shard: packed (document, tag, start) of windows that start earlier elsewhere."""

    def place(parts: pa.Table) -> pa.Table:
        if parts.column("place")[0].as_py() < 0:
            return pa.table(parts.set_column(0, "place", _lifted(parts.column("place"))))
        docs, low, high, starts, tags = _unpack_parts(parts)
        order = np.lexsort((starts, docs, high, low))
        docs, tags, starts, low, high = docs[order], tags[order], starts[order], low[order], high[order]
        fresh = np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
        again = ~fresh & _later(docs, starts, fresh)
        return pa.Table.from_batches([_parts(_shard(tags[again], shards), docs[again], starts=starts[again], tags=tags[again])])

    return sent.groupBy("place").applyInArrow(place, _PACKED)


def _rewrite(window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def shard(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, _, _, starts, tags = _unpack_parts(right)
        order = np.argsort(tags, kind="stable")
        docs, tags, starts = docs[order], tags[order], starts[order].astype(np.int64)
        ids, marks = left.column("doc").to_numpy(), left.column("tag").to_numpy().view(np.uint64)
        first, last = np.searchsorted(tags, marks, "left"), np.searchsorted(tags, marks, "right")
        counts, gone, kept = [], [], []
        bodies = left.column("body").cast(pa.binary())
        for body, doc, a, b in zip(bodies, ids, first, last):
            words = (body.as_py() or b"").split()
            counts.append(len(words))
            if a < b:
                steps = np.zeros(len(words) + window + 1, np.int64)
                inside = starts[a:b][(docs[a:b] == doc) & (starts[a:b] + window <= len(words))]
                np.add.at(steps, inside, 1)
                np.add.at(steps, inside + window, -1)
                words = list(compress(words, (np.cumsum(steps)[: len(words)] == 0).tolist()))
            gone.append(counts[-1] - len(words))
            kept.append(b" ".join(words))
        arrays = [left.column("key"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.table(arrays, ["key", "n_words", "n_removed", "kept"])

    return shard


def dedup_passages(docs: DataFrame, *, key: str = "doc_id", body: str = "text", window: int = WINDOW) -> DataFrame:
    """``key``, ``n_words``, ``n_removed`` and ``kept``, the words that stay joined by one blank."""
    text.bound_batches(docs.sparkSession)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = _prime_from(partitions * _PER_PARTITION)
    narrow = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(key).cast("long"), F.lit(_SMALLEST)).alias("doc"),
        text.whole(F.col(body)).alias("body"),
    )
    tagged = narrow.withColumn("tag", F.xxhash64("doc", "body"))
    texts = tagged.withColumn("place", _shard_column("tag", shards))
    repeated = _repeated_anchors(_send_anchors(texts, window, shards), shards)
    removed = _removed_windows(_send_windows(texts, repeated, window, shards), shards)
    kind = narrow.schema["key"].dataType.simpleString()
    out = texts.groupBy("place").cogroup(removed.groupBy("place"))
    return out.applyInArrow(_rewrite(window), f"key {kind}, n_words long, n_removed long, kept string").withColumnRenamed(
        "key", key
    )


@CATALOG.query(
    rf"""
    WITH split AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ),
    windows AS (
      SELECT doc_id, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') AS w
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split)
    ),
    firsts AS (SELECT w, min((doc_id, i)) AS first_start FROM windows GROUP BY w HAVING count(*) > 1),
    covered AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS pos
      FROM windows JOIN firsts USING (w) WHERE (doc_id, i) > first_start
    ),
    words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split),
    marked AS (
      SELECT w.doc_id, w.word, w.pos, c.pos IS NOT NULL AS gone FROM words w LEFT JOIN covered c
        ON w.doc_id = c.doc_id AND w.pos = c.pos
    ),
    summed AS (
      SELECT doc_id, count(*) AS n_words, sum(gone::INT) AS n_removed,
        string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
      FROM marked GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
      sha256(coalesce(kept, '')) AS kept_sha256
    FROM split LEFT JOIN summed USING (doc_id)
    """
)
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = text.table(spark, folder, "documents").select("doc_id", "text")
    done = dedup_passages(docs)
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return done.select("doc_id", "n_words", "n_removed", kept)
