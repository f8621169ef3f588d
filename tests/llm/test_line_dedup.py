import collections
import random

from helpers import documents

from tabloom.llm import line_dedup

WHITE = " \t\n\x0b\f\r"


def brute(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(WHITE).translate(lower)
    held = collections.defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(d)
    keep = {k: max(ids) for k, ids in held.items() if len(ids) >= 3}
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if keep.get(key(x), d) == d]
        out[d] = ("\n".join(stay), len(lines), len(lines) - len(stay))
    return out


def result(frame):
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in frame.collect()}


def test_equals_brute_force(spark):
    rng = random.Random(2)
    pool = [f"Line number {i} with enough é characters" for i in range(30)] + ["short", "", "  ", "ééééééééééééééééééé", "é" * 20]
    docs = [(i, "\n".join(rng.choice(["", "\t", " "]) + rng.choice(pool).upper()[: rng.choice([15, 99])] for _ in range(rng.randint(0, 9)))) for i in range(200)]
    docs += [(900, None), (901, ""), (902, "x" * 300_000)]
    assert result(line_dedup.dedup_lines(documents(spark, docs))) == brute(docs)


def test_a_full_filter_changes_no_result(spark):
    docs = [(i, f"a line that all documents have\nown line {i} of this document\n{i % 60} now and then a line") for i in range(300)]
    small = line_dedup.dedup_lines(documents(spark, docs), filter_bits=1 << 17)
    assert result(small) == brute(docs)


def test_only_suspects_are_shuffled(spark):
    docs = documents(spark, [(i, f"own line {i} of this document\nshared by {i // 2} two documents here") for i in range(400)])
    found = line_dedup.suspects(docs, "doc_id", "text", 1 << 20, 20)
    assert 400 <= found.count() < 420


def test_repeated_rows_missing_ids_and_clashing_names(spark):
    line = "a line that is long enough to count"
    rows = [(5, line), (5, line), (None, line), (3, line)]
    out = line_dedup.dedup_lines(documents(spark, rows, "doc", "digest", "drop", "n_lines", "keeper")).collect()
    # ids are 5, 5, missing (smallest) and 3: three documents, 5 keeps the line in both rows
    assert sorted((str(r["doc_id"]), r["n_dropped"]) for r in out) == [("3", 1), ("5", 0), ("5", 0), ("None", 1)]
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def test_a_filter_in_slices_changes_no_result(spark, monkeypatch):
    docs = [(i, f"a line that all documents have\nown line {i} of this document\n{i % 60} now and then a line") for i in range(300)]
    monkeypatch.setattr(line_dedup, "SLICE_BITS", 1 << 17)
    found = line_dedup.suspects(documents(spark, docs), "doc_id", "text", 1 << 19, 20)
    # the line of all documents, those of five, and few of the others by chance
    assert 600 <= found.count() < 620
    assert result(line_dedup.dedup_lines(documents(spark, docs), filter_bits=1 << 19)) == brute(docs)


def test_the_filter_grows_with_the_lines(spark, monkeypatch):
    texts = documents(spark, [(i, "a line of twenty and more\n" * 100 + "\n" * 5000) for i in range(500)] + [(900, None)]).select("text")
    most = 500 * (100 * 26 + 5000 + 1) // 21  # lines of 20 characters that would fit, fewer than there are lines
    assert most < line_dedup.counted_bits(texts, 20) / line_dedup.LINE_BITS <= 2 * most
    assert line_dedup.counted_bits(texts.limit(0), 20) == 1 << 17
    monkeypatch.setattr(line_dedup, "SLICE_BITS", 1 << 14)
    assert line_dedup.counted_bits(texts, 20) == 1 << 18


def test_rows_without_an_id_drop_their_own_lines(spark):
    line = "a line that is long enough to count"
    other = "another line that is long enough to count"
    rows = [(None, line + "\n" + other), (None, other), (None, "x"), (1, line + "\n" + other), (2, line)]
    rows += [(3, other)]
    out = line_dedup.dedup_lines(documents(spark, rows)).collect()
    got = sorted((str(r["doc_id"]), r["text"], r["n_dropped"]) for r in out)
    assert got == [("1", "", 2), ("2", line, 0), ("3", other, 0), ("None", "", 1), ("None", "", 2), ("None", "x", 0)]
    found = line_dedup.suspects(documents(spark, rows), "doc_id", "text", None, 20)
    lists = line_dedup.lines_to_drop(found, 3).collect()
    assert sorted(len(r["drop"]) for r in lists) == [1, 2, 2]
