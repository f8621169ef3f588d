"""Byte-level BPE: encoding of whole texts to ranks, and decoding.

1. Pre-tokens are found without a regular expression. Every code point has a class (letter,
   number, blank, other white space, quote, other), read from an array; white space and quotes also look
   at what follows them. A small automaton says where a pre-token starts. The transition functions
   of its symbols and all their compositions are a finite set with an associative product,
   so all states come from a blocked scan: the product of each block, prefix products over the
   blocks by doubling, and one step through all blocks at once.
2. Every pre-token, a slice of the text's bytes, is looked up in a cache of its ids that each worker
   keeps; a new one is merged pair by pair, lowest rank first, leftmost on ties, from a heap, so
   a long run without blanks takes n log n steps.
3. The first byte of every token is retained (``starts``). Decoding writes the bytes of all tokens of
   a batch to those places at once and fails if they do not fit together.

Nothing is shuffled. The rank table and the class array (one byte per code point) are all that is
sent to the executors; both have a fixed size. A task holds one Arrow batch or one text.

Defined cases: a missing or empty text has no ids and decodes to no bytes; equal rows are encoded
each; special strings are text; bytes that are no UTF-8 count as U+FFFD, as the library sees them;
an empty table gives an empty result; :func:`encode` returns the key and its own columns only,
:func:`decode` adds ``packed`` and ``decoded`` in place of columns of these names. An id that is no rank is an error.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm import text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

RANKS = "byte_bpe_multi_50k.tiktoken"
_CACHE_ENTRIES = 200_000
_CACHED_BYTES = 64  # longer pre-tokens are not remembered
_CHUNK = 1 << 20
_BLOCK = 128
_TOKENS = 1 << 18  # decoded at once, or one row's

# classes of code points
_LETTER, _NUMBER, _OTHER, _BLANK, _WHITE, _QUOTE = range(6)
# symbols of the automaton: letter, number, other; a quote that opens a contraction of one or two letters;
# the last white space before something else, if a blank or not; white space before white space or the end
_L, _N, _O, _Q1, _Q2, _B_LAST, _W_LAST, _W_MORE = range(8)
_FIRST = 8  # added to the first symbol of a text
# states: a pre-token has ended; inside letters, numbers, others; after a blank that belongs to what follows;
# inside white space; one or two letters of a contraction to go
_DONE, _IN_L, _IN_N, _IN_O, _HELD, _IN_W, _ONE, _TWO = range(8)
_SYMBOL = np.array([_L, _N, _O, _B_LAST, _W_LAST, _O], np.uint8)  # by class, before what follows is known
# The letters after a quote that are a pre-token with it.
_CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


def load_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


def class_table() -> np.ndarray:
    """The class of every code point, as the library's own character classes have it."""
    import tiktoken

    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000))).astype("<u4")
    every = points.tobytes().decode("utf-32-le")
    single = {bytes([b]): b for b in range(256)}
    table = np.full(0x110000, _OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _WHITE)):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(probe.encode_ordinary(every)).decode()  # only matches are encoded
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    table[ord(" ")], table[ord("'")] = _BLANK, _QUOTE
    return table


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``follow`` and ``cut`` [state, symbol]; the function after ``symbol`` ``step`` [function, symbol];
    ``product`` [function, function]; and the functions themselves [function, state]. Function 0 changes nothing."""
    begin = {_L: _IN_L, _N: _IN_N, _O: _IN_O, _Q1: _ONE, _Q2: _TWO, _B_LAST: _HELD, _W_LAST: _DONE, _W_MORE: _IN_W}
    follow, cut = np.zeros((8, 16), np.uint8), np.ones((8, 16), bool)
    for state in range(8):
        for symbol in range(8):
            follow[state, symbol] = follow[state, symbol + _FIRST] = begin[symbol]
        follow[state, _FIRST:] = [begin[s] for s in range(8)]
    others = (_O, _Q1, _Q2)  # inside of others a quote is one of them
    stays = [(_IN_L, (_L,), _IN_L), (_IN_N, (_N,), _IN_N), (_IN_O, others, _IN_O), (_IN_W, (_W_MORE,), _IN_W)]
    stays += [(_HELD, (_L,), _IN_L), (_HELD, (_N,), _IN_N), (_HELD, others, _IN_O)]
    stays += [(_ONE, range(8), _DONE), (_TWO, range(8), _ONE)]
    for state, symbols, then in stays:
        for symbol in symbols:
            follow[state, symbol], cut[state, symbol] = then, False
    known = {tuple(range(8)): 0}
    waiting = list(known)
    for function in waiting:
        for symbol in range(16):
            after = tuple(int(follow[s, symbol]) for s in function)
            if after not in known:
                known[after] = len(known)
                waiting.append(after)
    functions = np.array(waiting, np.uint8)
    step = np.array([[known[tuple(follow[f, s].tolist())] for s in range(16)] for f in functions], np.int32)
    # the set is closed under products: every function is a product of symbols
    product = np.array([[known[tuple(g[f].tolist())] for g in functions] for f in functions], np.int32)
    return follow, cut, step, product, functions


def cuts(symbols: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each symbol."""
    follow, cut, step, product, functions = automaton()
    n, rows = len(symbols), -(-len(symbols) // _BLOCK)
    padded = np.zeros(rows * _BLOCK, np.uint8)
    padded[:n] = symbols
    grid = np.ascontiguousarray(padded.reshape(rows, _BLOCK).T).astype(np.intp)
    ahead = np.zeros(rows, np.intp)
    flat = step.ravel()
    for column in grid:
        ahead = flat[ahead * 16 + column]
    shift = 1
    while shift < rows:
        ahead[shift:] = product[ahead[:-shift], ahead[shift:]]
        shift *= 2
    state = np.concatenate(([_DONE], functions[ahead[:-1], _DONE])).astype(np.intp)
    out = np.empty((_BLOCK, rows), bool)
    flat_cut, flat_follow = cut.ravel(), follow.ravel()
    for j, column in enumerate(grid):
        at = state * 16 + column
        out[j] = flat_cut[at]
        state = flat_follow[at].astype(np.intp)
    return out.T.ravel()[:n]


def symbols_of(points: np.ndarray, firsts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbols of the code points of several texts; ``firsts`` are the places where a text starts."""
    kind = classes[points]
    last = np.zeros(len(points) + 1, bool)
    last[firsts] = last[-1] = True
    last = last[1:]  # this is the end of a text
    white = (kind == _BLANK) | (kind == _WHITE)
    more = white & (last | np.append(white[1:], True))
    symbols = _SYMBOL[kind]
    symbols[more] = _W_MORE
    quotes = np.flatnonzero((kind == _QUOTE) & ~last)
    after = points[quotes + 1]
    for letters in _CONTRACTIONS:
        hit = after == ord(letters[0])
        if len(letters) == 2:
            inside = hit & ~last[quotes + 1]
            hit = inside.copy()
            hit[inside] = points[quotes[inside] + 2] == ord(letters[1])
        symbols[quotes[hit]] = _Q1 if len(letters) == 1 else _Q2
    symbols[firsts] += _FIRST
    return symbols


def pre_tokens(data: bytes, text_starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """First bytes of all pre-tokens of texts that lie one after another in ``data``; none of them is empty."""
    points = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
    heads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # first byte of each code point
    return heads[cuts(symbols_of(points, np.searchsorted(heads, text_starts), classes))]


def merge(part: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    if part in ranks:
        return [ranks[part]]
    n = len(part)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by first byte of a piece; end 0: merged away
    heap = [(ranks[part[i : i + 2]], i, i + 2) for i in range(n - 1) if part[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            grown = part[i : end[stop]]
            if grown in ranks:
                heapq.heappush(heap, (ranks[grown], i, end[stop]))
        left = before[i]
        if left >= 0 and part[left:stop] in ranks:
            heapq.heappush(heap, (ranks[part[left:stop]], left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[part[i : end[i]]])
        i = end[i]
    return ids


class _Packed(dict):
    """Packed ids by pre-token: what this worker has merged so far."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, part: bytes) -> bytes:
        packed = np.array(merge(part, self.ranks), "<u4").tobytes()
        if len(part) <= _CACHED_BYTES:
            if len(self) >= _CACHE_ENTRIES:
                self.clear()
            self[part] = packed
        return packed


@lru_cache(maxsize=1)
def _worker_cache(content: bytes) -> tuple[_Packed, np.ndarray]:
    """The cache that tasks of one Python worker share, and the lengths of the tokens by id."""
    ranks = load_ranks(content)
    return _Packed(ranks), _vocabulary(ranks)[2]


def _whole_texts(column: pa.Array) -> pa.Array:
    """The texts without missing ones and as valid UTF-8, with 64-bit offsets."""
    texts = column.cast(pa.large_binary()).fill_null(b"")
    try:
        return texts.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([t.as_py().decode(errors="replace") for t in texts], pa.large_string())


def _encoded(column: pa.Array, packed: _Packed, lengths: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``offsets`` of the rows, and the ``ids`` and ``starts`` of their tokens."""
    texts = _whole_texts(column)
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = memoryview(texts.buffers()[2] or b"")
    all_ids, all_starts, counts, first = [], [], [], 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + _CHUNK, "right")) - 1)
        data = bytes(whole[bounds[first] : bounds[last]])
        own = bounds[first : last + 1] - bounds[first]
        if data:
            begins = pre_tokens(data, np.unique(own[:-1][np.diff(own) > 0]), classes)
            places = [*begins.tolist(), len(data)]
            found = [packed[data[a:b]] for a, b in zip(places, places[1:])]
            ids = np.frombuffer(b"".join(found), "<u4")
            starts = np.cumsum(lengths[ids])
            starts -= lengths[ids]
            held = np.searchsorted(starts, own)  # tokens before each row's first byte
            counts.append(np.diff(held))
            all_ids.append(ids)
            all_starts.append(starts - np.repeat(own[:-1], counts[-1]))
        else:
            counts.append(np.zeros(last - first, np.int64))
        first = last
    offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
    empty = np.zeros(0, np.int64)
    return offsets, np.concatenate([empty.astype(np.uint32), *all_ids]), np.concatenate([empty, *all_starts])


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32)))


def _vocabulary(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes one after another, and by id their first byte (-1 if no rank) and length."""
    size = max(ranks.values()) + 1
    starts, lengths, at = np.full(size, -1, np.int64), np.zeros(size, np.int64), 0
    for token, i in ranks.items():
        starts[i], lengths[i] = at, len(token)
        at += len(token)
    return np.frombuffer(b"".join(ranks), np.uint8), starts, lengths


def encode(docs: DataFrame, ranks_path: str, *, key: str = "doc_id", body: str = "text") -> DataFrame:
    """``key``, ``ids`` (the tokens) and ``starts`` (first byte of each in the text), one row per row of ``docs``.

    The rank file is read here and travels with the job.
    """
    spark = docs.sparkSession
    text.bound_batches(spark)
    with open(ranks_path, "rb") as file:
        sent = spark.sparkContext.broadcast((file.read(), class_table().tobytes()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, lengths = _worker_cache(sent.value[0])
        classes = np.frombuffer(sent.value[1], np.uint8)
        for batch in batches:
            offsets, ids, starts = _encoded(batch.column(1), packed, lengths, classes)
            yield pa.record_batch([batch.column(0), _lists(offsets, ids), _lists(offsets, starts)], ["key", "ids", "starts"])

    narrow = docs.select(F.col(key).alias("key"), F.col(body).alias("body"))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(task, f"key {kind}, ids array<int>, starts array<int>").withColumnRenamed("key", key)


def _written(ids: np.ndarray, starts: np.ndarray, offsets: np.ndarray, vocabulary: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the rows and the bytes of their tokens, each at its start."""
    letters, first, length = vocabulary
    if ids.size and (ids.min() < 0 or ids.max() >= len(first) or (first[ids] < 0).any()):
        raise ValueError("an id is no rank of the vocabulary")
    sizes = length[ids]
    place = np.cumsum(sizes) - sizes
    rows = np.append(place, sizes.sum())[offsets]
    if (starts != place - np.repeat(rows[:-1], np.diff(offsets))).any():
        raise ValueError("the starts do not fit the tokens")
    out = letters[np.arange(rows[-1]) + np.repeat(first[ids] - place, sizes)]
    return rows, out


def decode(encoded: DataFrame, ranks_path: str, *, ids: str = "ids", starts: str = "starts") -> DataFrame:
    """Add ``packed``, the ids as little-endian unsigned 32-bit integers, and ``decoded``, their bytes.

    Both are empty for a missing list; other columns pass through.
    """
    spark = encoded.sparkSession
    with open(ranks_path, "rb") as file:
        sent = spark.sparkContext.broadcast(file.read())
    plain = encoded.drop("packed", "decoded")
    at = [plain.columns.index(c) for c in (ids, starts)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(load_ranks(sent.value))
        for batch in batches:
            lists = [batch.column(i) for i in at]
            offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(lists[0]).fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)
            tokens, places = (column.flatten().to_numpy(zero_copy_only=False) for column in lists)
            out, packed, first = [], [], 0
            while first < len(batch):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _TOKENS, "right")) - 1)
                span = slice(offsets[first], offsets[last])
                ends, written = _written(tokens[span], places[span], offsets[first : last + 1] - offsets[first], vocabulary)
                out += [written[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                packed += [tokens[a:b].astype("<u4").tobytes() for a, b in zip(offsets[first:last], offsets[first + 1 :])]
                first = last
            added = [pa.array(column, pa.binary()) for column in (packed, out)]
            yield pa.record_batch([*batch.columns, *added], [*batch.schema.names, "packed", "decoded"])

    added = [T.StructField(name, T.BinaryType()) for name in ("packed", "decoded")]
    return plain.mapInArrow(task, T.StructType([*plain.schema.fields, *added]))


@CATALOG.query()
def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path(RANKS)
    encoded = encode(text.table(spark, folder, "documents").select("doc_id", "text"), ranks)
    return decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
