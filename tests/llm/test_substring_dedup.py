import random

import pytest
from helpers import documents, prose, window_removal

from tabloom.llm import substring_dedup


def check(spark, docs, window=20, *extra):
    out = substring_dedup.dedup_passages(documents(spark, docs, *extra), window=window).collect()
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(map(tuple, out), key=key) == sorted(window_removal(docs, window), key=key)


@pytest.mark.parametrize("period", sorted(substring_dedup.COVERS))
def test_covers_meet_every_pair_of_positions(period):
    cover = set(substring_dedup.COVERS[period])
    for i in range(period):
        for j in range(period):
            assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))


def test_equals_brute_force_on_spliced_texts(spark):
    rng = random.Random(4)
    passages = [prose(i, rng.randint(15, 60)) for i in range(8)]
    docs = []
    for i in range(120):
        parts = [prose(1000 + i, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split()
            a = rng.randint(0, len(p) // 2)
            parts += [" ".join(p[a : a + rng.randint(5, 60)]), prose(5000 + rng.randint(0, 10**6), rng.randint(0, 9))]
        docs.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(parts)))
    docs += [(200, " ".join(["same"] * 70)), (201, " ".join(["same"] * 30)), (202, None), (203, ""), (204, "é" * 100_000)]
    check(spark, docs)
    check(spark, docs, 14)


def test_many_copies_keep_the_smallest_id(spark):
    docs = [(i, prose(3, 80)) for i in range(300)]
    out = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup_passages(documents(spark, docs)).collect()}
    assert out == {i: 80 * (i > 0) for i in range(300)}


def test_repeated_rows_missing_ids_and_clashing_names(spark):
    docs = [(7, prose(1, 50)), (7, prose(1, 50)), (None, prose(2, 30)), (3, prose(2, 30) + " " + prose(1, 19))]
    check(spark, docs, 20, "key", "doc", "body", "place", "kept")
    check(spark, [])


def test_texts_under_one_id_lose_their_own_words_only(spark):
    passage = prose(1, 25)
    docs = [(None, passage + " " + prose(2, 30)), (None, prose(3, 25) + " " + passage + " " + prose(4, 9))]
    docs += [(None, prose(5, 60)), (8, prose(6, 50)), (8, prose(7, 20) + " " + prose(6, 30)), (8, prose(8, 70))]
    docs += [(9, passage + " " + prose(9 + i, 5)) for i in range(12)]
    check(spark, docs)
