import random

import numpy as np
from helpers import documents, near_classes, prose

from tabloom.llm import near_dedup


def classes(spark, docs, *extra, **kw):
    rows = near_dedup.classes(documents(spark, docs, *extra), **kw).collect()
    return {r["doc_id"]: r["class_id"] for r in rows}, {r["doc_id"]: r["n_class"] for r in rows}


def changed(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    docs = []
    for group in range(25):
        base = prose(group + 100 * seed, rng.randint(20, 400))
        for _ in range(rng.randint(1, 6)):
            docs.append((len(docs), changed(rng, base, rng.randint(0, 6))))
    tail = prose(9999, 60)
    docs += [(len(docs) + i, prose(300 + i, 40) + " " + tail) for i in range(30)]  # a shared passage, no copies
    return docs


def test_equals_brute_force(spark):
    docs = corpus(1) + [(1000, None), (1001, ""), (1002, "one two"), (1003, "one  two"), (1004, "one two three"), (1005, "r " * 30)]
    got, size = classes(spark, docs)
    assert got == near_classes(docs)
    assert all(size[d] == sum(c == got[d] for c in got.values()) for d in got)


def test_a_chain_of_small_changes_is_one_class(spark):
    rng, text, docs = random.Random(3), prose(5, 150), []
    for i in range(40):
        docs.append((i, text))
        text = changed(rng, text, 2)
    got, _ = classes(spark, docs)
    assert got == near_classes(docs)


def test_large_group_of_different_copies(spark):
    rng, base = random.Random(8), prose(77, 120)
    docs = [(i, changed(rng, base, 2)) for i in range(200)] + [(500 + i, prose(800 + i, 60)) for i in range(20)]
    got, _ = classes(spark, docs)
    assert got == near_classes(docs)


def test_signatures_estimate_weighted_similarity():
    rng, k = np.random.default_rng(1), 2000
    elements = rng.integers(0, 2**63, 40).astype(np.uint64)
    left, right = rng.random(40) * 3 + 0.05, rng.random(40) * 3 + 0.05
    both = near_dedup.darts(np.repeat([0, 1], 40), np.concatenate((elements, elements)), np.concatenate((left, right)), 2, k)
    truth = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    assert abs((both[0] == both[1]).mean() - truth) < 0.05


def test_repeated_rows_missing_ids_clashes_and_empty_tables(spark):
    docs = [(4, prose(1, 30)), (4, prose(1, 30)), (None, prose(1, 30)), (9, prose(2, 30))]
    rows = near_dedup.classes(documents(spark, docs, "doc", "node", "keys", "class_id", "bucket")).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_class"]) for r in rows) == [
        ("4", "None", 2), ("9", "9", 1), ("None", "None", 2),
    ]
    assert near_dedup.classes(documents(spark, [])).count() == 0
    kept = near_dedup.keep_one(documents(spark, docs, "later"))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["9", "None"]


def test_texts_under_one_id_or_without_an_id_are_documents_of_their_own(spark):
    rng = random.Random(4)
    texts = [prose(i, 120) for i in range(5)]
    docs = [(None, texts[0]), (None, changed(rng, texts[0], 1)), (None, texts[1]), (3, texts[2]), (7, texts[3])]
    docs += [(7, changed(rng, texts[2], 1)), (7, texts[4])]
    kept = [r["text"] for r in near_dedup.keep_one(documents(spark, docs)).collect()]
    assert sum(k in (docs[0][1], docs[1][1]) for k in kept) == 1
    assert sorted(k for k in kept if k not in (docs[0][1], docs[1][1])) == sorted(texts[1:])
    rows = near_dedup.classes(documents(spark, docs)).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_class"]) for r in rows) == [
        ("3", "3", 2), ("7", "3", 2), ("7", "7", 1), ("7", "7", 1), ("None", "None", 1), ("None", "None", 2), ("None", "None", 2),
    ]
