"""Brute-force versions and small tables for the tests of this folder."""

import collections
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def words(text):
    return WORD.findall(text or "")


def documents(spark, rows, *extra):
    """Rows of (doc_id, text[, source]); ``extra`` names columns that hold the text "clash"."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    frame = spark.createDataFrame(full, DOCS)
    for name in extra:
        frame = frame.selectExpr("*", f"'clash' AS {name}")
    return frame


def prose(seed, n):
    """``n`` words of letters that depend on the seed only; two seeds share no run of words."""
    numbers = (f"{(seed * 7919 + i * i * 31 + i) % 99991:05d}" for i in range(n))
    return " ".join(number.translate(str.maketrans("0123456789", "bcdfghjklm")) for number in numbers)


def shingles(text, length=5):
    """Shingles with their repeats told apart, so that set similarity is the weighted one."""
    w = words(text)
    found = collections.Counter(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    if w and not found:
        found = collections.Counter([tuple(w)])
    return {(s, i) for s, n in found.items() for i in range(n)}


def near_classes(docs, similarity=0.8):
    """Class (smallest id) per id, by comparing all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and shared >= similarity * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def window_removal(docs, window=20):
    """Per row: number of words and the words that stay."""
    first = {}
    split = [(d, words(t)) for d, t in docs]
    key = lambda d: -(1 << 63) if d is None else d
    for d, w in split:
        for i in range(len(w) - window + 1):
            run, at = tuple(w[i : i + window]), (key(d), i)
            first[run] = min(first.get(run, at), at)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if (key(d), i) > first[tuple(w[i : i + window])]:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def edits(pattern, text):
    """Fewest edits between the pattern and any part of the text."""
    before = [0] * (len(text) + 1)
    for letter in pattern:
        now = [before[0] + 1]
        for j, other in enumerate(text, 1):
            now.append(min(before[j - 1] + (other != letter), before[j] + 1, now[j - 1] + 1))
        before = now
    return min(before)
