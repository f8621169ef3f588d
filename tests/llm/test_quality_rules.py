import collections
import random

from helpers import documents, prose, words

from tabloom.llm import quality_rules


def brute(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_counts_equal_brute_force(spark):
    rng = random.Random(5)
    pieces = ["a", "b", "cc", "é", "#x", " ", "  ", "\n", "\t", "|", "\x0b", "中"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += [None, "", " \n ", prose(1, 20000), "x y z " * 3000, "q" * 50000]
    judged = quality_rules.judge(documents(spark, list(enumerate(texts)))).collect()
    got = {r["doc_id"]: tuple(r[c] for c in quality_rules._COUNTS) for r in judged}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in judged)


def test_depleted_documents_go_and_others_stay(spark):
    shared = prose(0, 45)
    own = [(i, f"{shared}\n{prose(i, 30)}", "h") for i in range(1, 41)]  # 30 words of their own
    rich = [(i, f"{shared.upper()}  \n{prose(i, 60)}", "h") for i in range(41, 61)]
    other = [(i, f"{shared}\n{prose(i, 30)}", None) for i in range(61, 66)]  # too few for a limit
    kept = {r["doc_id"] for r in quality_rules.judge(documents(spark, own + rich + other)).filter("kept").collect()}
    assert kept == set(range(41, 66))


def test_copies_do_not_make_boilerplate(spark):
    rows = [(i, prose(7, 80), "h") for i in range(100)] + [(1000 + i, prose(i + 50, 80), "h") for i in range(10)]
    assert quality_rules.judge(documents(spark, rows)).filter("kept").count() == 110


def test_removing_lines_keeps_the_rest(spark):
    rows = [(i, f"Menu {i}  home\n{prose(i, 5)}\n", "h") for i in range(20)] + [(99, None, None)]
    docs = documents(spark, rows)
    limits = quality_rules.frequent_lines(docs)
    out = {r["doc_id"]: r["text"] for r in quality_rules.without_frequent_lines(docs, limits).collect()}
    assert out[3] == f"{prose(3, 5)}\n" and out[99] is None


def test_empty_tables_clashing_names_and_repeated_rows(spark):
    clash = ("n_words", "shape", "kept", "depleted", "host_key", "body_hash", "line_hash", "pos")
    empty = quality_rules.judge(documents(spark, [], *clash))
    assert empty.count() == 0 and set(quality_rules._COUNTS) < set(empty.columns)
    twice = quality_rules.judge(documents(spark, [(1, prose(1, 60))] * 2 + [(None, None, None)], *clash)).collect()
    assert sorted(r["kept"] for r in twice) == [False, True, True]
