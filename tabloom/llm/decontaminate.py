"""Find documents that hold passages of a benchmark, by the q-gram lemma and banded alignment.

Texts are compared in lower case with white space runs as one blank. Benchmark items are cut
into overlapping patterns, long ones of about ``PATTERN`` characters and short ones of ``PART``
characters that start every ``STEP``, so a leaked part of an item is found as well: every word for
word excerpt of ``PART + STEP - 1`` (55) characters holds a short pattern. A pattern of n characters
matches a region of a text if they are at most k = ``rate`` * n edits apart. By the q-gram lemma
such a region shares n - q + 1 - k q character q-grams with the pattern, on diagonals no more than
k apart. Shared q-grams are counted in bands of 2 k diagonals that overlap by k; bands that reach
the bound are kept and verified by an alignment within the band. The filter loses nothing, and the
alignment decides. An item of fewer than ``LEAST`` characters leaves no room for edits: it has to be
found as it is, between characters that are neither letters nor digits.

Documents are scanned where they are; only matches are shuffled. The benchmark is the query set:
its patterns stream through the driver and are sent out in blocks of at most ``BLOCK`` characters,
one scan of the documents per block. A task looks at about ``_CHUNK`` characters at a time, of a
longer text piece by piece, and spells out at most about ``_ENTRIES`` shared q-grams at a time,
however often a q-gram occurs; pieces and slices overlap by more than any match can be long.

Defined cases: missing or empty texts and items match nothing; repeated rows and repeated items
give one row per pair of ids; rows without an id are searched if ``unnamed`` asks for it, and are then
one document without an id in ``matches`` and judged one by one in ``drop_matches``; an empty table
on either side gives an empty result. Only ids and the smallest number of edits are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

Q = 10
RATE = 0.08
PATTERN = 80
PART = 48
STEP = 8
LEAST = 32
BLOCK = 1 << 22
_CHUNK = 1 << 20
_ENTRIES = 1 << 20
_CELLS = 1 << 19
_FILTER_BITS = 22
_FACTOR = 0x9E3779B97F4A7C15
_GAP = 0x110000  # no character: stands between texts
_CUT = 0x110001  # stands where a long text is cut into pieces; the overlapping piece has what was there


def normal(body: str) -> str:
    return " ".join(body.lower().split())


def codes(body: str) -> np.ndarray:
    return np.frombuffer(body.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(letters: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` characters from each position on, joined from powers of two."""
    parts, width = {1: letters.astype(np.uint64)}, 1
    while 2 * width <= q:
        half = parts[width]
        shift = np.uint64(pow(_FACTOR, width, 1 << 64))
        parts[2 * width] = half[: max(0, len(half) - width)] * shift + half[width:]
        width *= 2
    out, done = parts[width], width
    for width in sorted(parts, reverse=True)[1:]:
        if done + width <= q:
            n = max(0, len(letters) - done - width + 1)
            shift = np.uint64(pow(_FACTOR, width, 1 << 64))
            out, done = out[:n] * shift + parts[width][done : done + n], done + width
    out = out ^ (out >> np.uint64(29))
    return out * np.uint64(0xBF58476D1CE4E5B9)


def _windows(body: str, size: int, step: int) -> list[str]:
    return [body[s : s + size] for s in range(0, len(body) - size, step)] + [body[-size:]]


def cut_item(body: str, pattern: int = PATTERN, part: int = PART, step: int = STEP) -> list[str]:
    """Patterns of ``pattern`` characters that overlap by half, or a shorter item as a whole, and its parts."""
    long = [body] if len(body) < pattern * 3 // 2 else _windows(body, pattern, pattern // 2)
    return long + (_windows(body, part, step) if len(body) > part else [])


class Block:
    """Patterns with the items that hold them, ready to be looked up."""

    def __init__(self, patterns: dict[str, list[int]], q: int, rate: float):
        self.q = q
        loose = sorted(p for p in patterns if len(p) >= LEAST)
        self.items = [patterns[p] for p in loose]
        self.exact = Short({p: items for p, items in patterns.items() if len(p) < LEAST})
        letters = [codes(p) for p in loose]
        self.sizes = np.array([len(p) for p in letters], np.int64)
        self.columns = np.zeros((self.sizes.max(initial=0), len(letters)), np.uint32)
        for i, p in enumerate(letters):
            self.columns[: len(p), i] = p
        self.budgets = np.array([_budget(n, q, rate) for n in self.sizes], np.int64)
        self.bounds = self.sizes - q + 1 - self.budgets * q
        self.reach = int((self.sizes + 2 * self.budgets).max(initial=0)) + LEAST
        grams = [qgrams(p, q) for p in letters]
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        values = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.grams, which = np.unique(values[order], return_inverse=True)
        self.entries = (which.astype(np.int64) << 32) + self.owner  # ascending
        self.ends = np.append(np.searchsorted(which, np.arange(1, len(self.grams))), len(which))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(self.grams)] = True

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def shared(self, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pattern and diagonal of q-grams that a text shares with a pattern, slice by slice of the text.

        Slices overlap by ``reach`` characters, so some slice has all that a region shares with a pattern.
        """
        if not len(self.grams):
            return
        grams = qgrams(letters, self.q)
        at = np.flatnonzero(self.filter[self._slot(grams)])
        spot = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        exact = self.grams[spot] == grams[at]
        at, spot = at[exact], spot[exact]
        slices = np.cumsum(np.diff(self.ends, prepend=0)[spot]) // _ENTRIES
        for begin in np.unique(slices, return_index=True)[1]:
            end = np.searchsorted(slices, slices[begin], "right")
            own = slice(begin, np.searchsorted(at, at[end - 1] + self.reach, "right"))
            yield from self._entries(at[own], spot[own], int(slices[own][-1] - slices[begin]) // 2 + 1)

    def _entries(self, at: np.ndarray, spot: np.ndarray, groups: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pattern and diagonal of the q-grams ``spot`` at ``at``, for ``groups`` groups of patterns."""
        edges = np.linspace(0, len(self.sizes), groups + 1).astype(np.int64)
        for low, high in zip(edges, edges[1:]):
            first = np.searchsorted(self.entries, (spot << 32) + low)
            n = np.searchsorted(self.entries, (spot << 32) + high) - first
            entry = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield self.owner[entry], np.repeat(at, n) - self.place[entry]

    def bands(self, owner: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pattern and first diagonal of the bands that reach the pattern's bound."""
        step = np.maximum(self.budgets[owner], 1)
        low = np.floor_divide(diagonal, step)
        band = np.concatenate((low, low - 1))  # each band covers two steps
        both = (np.concatenate((owner, owner)) << 32) + (band + (1 << 31))
        found, count = np.unique(both, return_counts=True)
        pattern, band = found >> 32, (found & ((1 << 32) - 1)) - (1 << 31)
        keep = count >= self.bounds[pattern]
        pattern, band = pattern[keep], band[keep]
        return pattern, band * np.maximum(self.budgets[pattern], 1)

    def regions(self, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pattern, middle and fewest edits of the regions that match, all bands of one pattern size at once."""
        for pattern, first in (self.bands(*found) for found in self.shared(letters)):
            sizes = self.sizes[pattern]
            for size in np.unique(sizes):
                same = np.flatnonzero(sizes == size)
                for some in np.array_split(same, len(same) * int(size) // _CELLS + 1):
                    edits = self.align(letters, pattern[some], first[some])
                    good = edits <= self.budgets[pattern[some]]
                    own = pattern[some][good]
                    yield own, first[some][good] + self.budgets[own] + size // 2, edits[good]

    def align(self, letters: np.ndarray, pattern: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Fewest edits between each pattern, all of one size, and a region that starts in its band."""
        width = 2 * max(int(self.budgets[pattern[0]]), 1)
        offsets = np.arange(width)
        cost = np.zeros((len(starts), width), np.int64)
        for i in range(self.sizes[pattern[0]]):
            letter = self.columns[i][pattern]
            at = starts[:, None] + i + offsets
            inside = (at >= 0) & (at < len(letters))
            differ = np.where(inside, letters[np.clip(at, 0, len(letters) - 1)] != letter[:, None], True)
            step = cost + differ
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)  # a letter of the pattern is missing
            cost = np.minimum.accumulate(step - offsets, axis=1) + offsets  # a letter of the text is extra
        return cost.min(axis=1)


class Short:
    """Items too short for edits, by their size and hash."""

    def __init__(self, patterns: dict[str, list[int]]):
        self.by_size: dict[int, dict[int, list[tuple[np.ndarray, list[int]]]]] = {}
        for pattern, items in sorted(patterns.items()):
            letters = codes(pattern)
            held = self.by_size.setdefault(len(letters), {})
            held.setdefault(int(qgrams(letters, len(letters))[0]), []).append((letters, items))

    def regions(self, letters: np.ndarray) -> Iterator[tuple[list[int], int]]:
        """Items and middle of every occurrence that no letter or digit touches."""
        for size, held in self.by_size.items():
            grams = qgrams(letters, size)
            for at in np.flatnonzero(np.isin(grams, np.array(list(held), np.uint64))):
                around = [int(letters[i]) for i in (at - 1, at + size) if 0 <= i < len(letters) and letters[i] != _GAP]
                if any(c == _CUT or chr(c).isalnum() for c in around):
                    continue
                for pattern, items in held[int(grams[at])]:
                    if np.array_equal(letters[at : at + size], pattern):
                        yield items, int(at) + size // 2


def _budget(size: int, q: int, rate: float) -> int:
    """Edits allowed for a pattern, so few that the lemma still asks for a shared q-gram."""
    return min(int(size * rate), (size - q) // q)


def blocks(benchmark: DataFrame, item: str, body: str) -> Iterator[dict[str, list[int]]]:
    """The benchmark's patterns with their items in blocks of bounded size; items stream to the driver."""
    current: dict[str, list[int]] = {}
    held = 0
    for row in benchmark.select(F.col(item).cast("long").alias("item"), F.col(body).alias("body")).toLocalIterator():
        letters = normal(row["body"] or "")
        if row["item"] is None or not letters:
            continue
        for pattern in set(cut_item(letters)):
            current.setdefault(pattern, []).append(row["item"])
            held += len(pattern)
        if held >= BLOCK:
            yield current
            current, held = {}, 0
    if current:
        yield current


def _texts(columns: list[pa.Array], overlap: int) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """Identities (id and hash) and characters of texts or overlapping pieces, about ``_CHUNK`` characters at a time."""
    ids, hashes, bodies = columns
    keys, letters, held = [], [], 0
    for *key, body in zip(ids.to_pylist(), hashes.to_pylist(), bodies):
        whole = codes(normal(body.as_py() or ""))
        for begin in range(0, len(whole), _CHUNK):
            piece = whole[max(begin - overlap, 0) : begin + _CHUNK].copy()
            if begin:
                piece[0] = _CUT
            if begin + _CHUNK < len(whole):
                piece[-1] = _CUT
            keys.append(tuple(key))
            letters.append(piece)
            held += len(piece) + 1
            if held >= _CHUNK:
                yield keys, letters
                keys, letters, held = [], [], 0
    if keys:
        yield keys, letters


def _search(block: Block, keys: list[tuple], letters: list[np.ndarray]) -> Iterator[tuple[tuple, int, int]]:
    """The fewest edits per identity and item in these texts."""
    gap = np.array([_GAP], np.uint32)
    joined = np.concatenate([part for each in letters for part in (each, gap)])
    ends = np.cumsum([len(each) + 1 for each in letters])
    best: dict[tuple[int, int], int] = {}
    for pattern, middle, edits in block.regions(joined):
        doc = np.minimum(np.searchsorted(ends, middle, "right"), len(keys) - 1)
        pairs, at = np.unique((pattern << 32) + doc, return_inverse=True)
        fewest = np.full(len(pairs), np.iinfo(np.int64).max)
        np.minimum.at(fewest, at, edits)
        for pair, n in zip(pairs.tolist(), fewest.tolist()):
            for item in block.items[pair >> 32]:
                own = (pair & 0xFFFFFFFF, item)
                best[own] = min(n, best.get(own, n))
    for items, middle in block.exact.regions(joined):
        for item in items:
            best[int(np.searchsorted(ends, middle, "right")), item] = 0
    for (doc, item), n in best.items():
        yield keys[doc], item, n


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    body: str = "text",
    item: str = "item_id",
    item_body: str = "text",
    q: int = Q,
    rate: float = RATE,
    unnamed: bool = False,
) -> DataFrame:
    """``doc_id``, ``item_id`` and ``edits``, the fewest of the item's patterns, per matching pair."""
    judged = docs if unnamed else docs.filter(F.col(key).cast("long").isNotNull())
    found = _row_matches(judged, benchmark, key, body, item, item_body, q, rate)
    return found.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))


def _row_matches(
    docs: DataFrame, benchmark: DataFrame, key: str, body: str, item: str, item_body: str, q: int, rate: float
) -> DataFrame:
    """``doc_id``, ``body_hash``, ``item_id`` and ``edits`` of every match, also of rows without an id."""
    text.bound_batches(docs.sparkSession)
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(body).alias("body_hash"), F.col(body).alias("body"))
    context = docs.sparkSession.sparkContext
    schema, found = "doc_id long, body_hash long, item_id long, edits long", None
    for patterns in blocks(benchmark, item, item_body):
        sent = context.broadcast(patterns)

        def task(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = Block(sent.value, q, rate)
            for batch in batches:
                rows = [(*who, i, n) for part in _texts(batch.columns, own.reach) for who, i, n in _search(own, *part)]
                columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], [], []))]
                yield pa.record_batch(columns, ["doc_id", "body_hash", "item_id", "edits"])

        new = narrow.mapInArrow(task, schema)
        found = new if found is None else found.union(new)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def drop_matches(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", body: str = "text", unnamed: bool = False
) -> DataFrame:
    """The documents that hold no passage of the benchmark, each row judged by its own text.

    Rows without an id stay as they are unless ``unnamed`` asks to judge them as well.
    """
    judged = docs if unnamed else docs.filter(F.col(key).cast("long").isNotNull())
    found = _row_matches(judged, benchmark, key, body, "item_id", "text", Q, RATE)
    hits = found.select(F.col("doc_id").alias("decontaminate__hit"), F.col("body_hash").alias("decontaminate__body")).distinct()
    same = F.col(key).cast("long").eqNullSafe(F.col("decontaminate__hit")) & (F.xxhash64(body) == F.col("decontaminate__body"))
    return docs.join(runtime.store(hits, "hits"), same, "left_anti")


@CATALOG.query()
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return matches(text.table(spark, folder, "documents"), text.table(spark, folder, "benchmark"), unnamed=True)
