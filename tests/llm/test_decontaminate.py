import random
import tracemalloc

import numpy as np
from helpers import documents, edits, prose

from tabloom.llm import decontaminate


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, docs, items, *extra):
    rows = decontaminate.matches(documents(spark, docs, *extra), bench(spark, items)).collect()
    return {(r["doc_id"], r["item_id"]): r["edits"] for r in rows}


def brute(docs, items):
    out = {}
    for d, text in docs:
        for item, body in items:
            body = decontaminate.normal(body or "")
            if d is None or len(body) < decontaminate.LEAST:
                continue
            for pattern in decontaminate.cut_item(body):
                n = edits(pattern, decontaminate.normal(text or ""))
                if n <= decontaminate._budget(len(pattern), decontaminate.Q, decontaminate.RATE):
                    out[d, item] = min(n, out.get((d, item), n))
    return out


def noisy(rng, text, n):
    letters = list(text)
    for _ in range(n):
        i, kind = rng.randrange(len(letters)), rng.random()
        if kind < 0.4:
            letters[i] = rng.choice("abcxyzé")
        elif kind < 0.7:
            letters.insert(i, rng.choice("abcxyz"))
        else:
            del letters[i]
    return "".join(letters)


def test_equals_brute_force_alignment(spark):
    rng = random.Random(6)
    items = [(i, prose(i, rng.randint(6, 30))) for i in range(6)] + [(6, "short"), (7, None), (8, "")]
    docs = []
    for i in range(60):
        item = items[rng.randrange(6)][1]
        a = rng.randrange(0, len(item) // 2)
        piece = noisy(rng, item if rng.random() < 0.5 else item[a:], rng.randint(0, 14))
        docs.append((i, f"{prose(100 + i, 8)} {rng.choice([piece, piece.upper(), piece.replace(' ', chr(10) * 2)])} {prose(200 + i, 8)}"))
    docs += [(900, None), (901, ""), (902, items[3][1]), (903, prose(999, 300))]
    assert found(spark, docs, items) == brute(docs, items)


def test_a_part_of_an_item_and_clean_documents(spark):
    item = prose(1, 60)
    docs = [(1, prose(2, 50) + " " + item[100:240]), (2, prose(3, 400)), (3, item[:40])]
    assert set(found(spark, docs, [(5, item)])) == {(1, 5)}


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    items = [(i, prose(i, 20)) for i in range(5)]
    docs = [(i, prose(50 + i, 10) + " " + prose(i % 6, 20)) for i in range(12)]
    whole = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "BLOCK", 100)
    assert found(spark, docs, items) == whole and len(whole) == 10


def test_missing_ids_repeated_rows_clashes_and_empty_tables(spark):
    item = prose(1, 20)
    docs = [(1, item), (1, item), (None, item)]
    assert found(spark, docs, [(3, item), (3, item), (None, item)], "key", "body", "item_id", "edits", "hit") == {(1, 3): 0}
    assert found(spark, [], [(3, item)]) == {} and found(spark, docs, []) == {}
    left = decontaminate.drop_matches(documents(spark, [*docs, (2, prose(4, 30))], "hit"), bench(spark, [(3, item)]))
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "None"]


def test_rows_are_dropped_by_their_own_text(spark):
    item, clean, other = prose(1, 20), prose(4, 30), prose(5, 30)
    docs = documents(spark, [(1, item), (1, clean), (None, item), (None, other)])
    left = decontaminate.drop_matches(docs, bench(spark, [(3, item)]), unnamed=True).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == [("1", clean), ("None", other)]


def test_every_excerpt_of_55_characters_and_more_is_found():
    block_of = lambda item: decontaminate.Block({p: [1] for p in decontaminate.cut_item(item)}, decontaminate.Q, decontaminate.RATE)
    least = decontaminate.PART + decontaminate.STEP - 1
    for size in (56, 80, 119, 120, 250):
        item = prose(size, 80)[:size]
        block = block_of(item)
        for length in (n for n in {least, 80, 105} if least <= n <= size):
            for at in range(size - length + 1):
                body = prose(7, 9) + " " + item[at : at + length] + " " + prose(8, 9)
                hits = list(decontaminate._search(block, [(1, 1)], [decontaminate.codes(body)]))
                assert [h[:2] for h in hits] == [((1, 1), 1)], (size, length, at)


def test_short_items_are_found_as_they_are(spark):
    docs = [
        (1, prose(2, 5) + " What  is 7 x 6? " + prose(3, 5)),
        (2, "what is 7 x 61"),
        (3, "WHAT IS\n7 X 6"),
        (4, "swhat is 7 x 6"),
        (5, "what is 8 x 6"),
        (6, "(a) " + "nothing " * 50),
    ]
    items = [(1, "What is 7 x 6"), (2, "exactly thirty-one characters.."), (3, "what is 7 x 6"), (4, "b")]
    assert len(items[1][1]) == 31
    docs += [(7, prose(4, 5) + " " + items[1][1]), (8, items[1][1][:-1])]
    assert found(spark, docs, items) == {(1, 1): 0, (1, 3): 0, (3, 1): 0, (3, 3): 0, (7, 2): 0}


def test_very_long_texts_are_searched_piece_by_piece(spark, monkeypatch):
    item, short = prose(1, 20), "a short item"
    docs = [(1, " ".join([prose(2, 9000), item, prose(3, 9000), short])), (2, prose(4, 30_000)), (3, item), (4, "y" + short)]
    whole = found(spark, docs, [(5, item), (6, short)])
    assert whole == {(1, 5): 0, (1, 6): 0, (3, 5): 0}
    items = [(5, item), (6, short)]
    patterns = {p: [i] for i, body in items for p in decontaminate.cut_item(body)}
    block = decontaminate.Block(patterns, decontaminate.Q, decontaminate.RATE)
    bodies = [decontaminate.normal(d[1]) for d in docs]
    for piece, entries in ((300, 1 << 20), (307, 50), (1000, 1)):  # every cut and slice gives the same
        monkeypatch.setattr(decontaminate, "_CHUNK", piece)
        monkeypatch.setattr(decontaminate, "_ENTRIES", entries)
        columns = [decontaminate.pa.array(c) for c in (range(1, 5), range(4), bodies)]
        best = {}
        for part in decontaminate._texts(columns, block.reach):
            for (doc, _), i, n in decontaminate._search(block, *part):
                best[doc, i] = min(n, best.get((doc, i), n))
        assert best == whole


def test_repeated_characters_stay_within_bounded_memory():
    patterns = {p: [1] for p in decontaminate.cut_item("a" * 400)}
    block = decontaminate.Block(patterns, decontaminate.Q, decontaminate.RATE)
    tracemalloc.start()
    hits = list(decontaminate._search(block, [(1, 1)], [np.full(100_000, ord("a"), np.uint32)]))
    assert hits == [((1, 1), 1, 0)] and tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_a_passage_in_many_items_is_searched_in_groups_of_patterns(monkeypatch):
    passage = prose(9, 12)
    items = [prose(100 + i, 4 + i % 3) + " " + passage + " " + prose(300 + i, 5) for i in range(40)]
    patterns = {}
    for i, body in enumerate(items):
        for p in set(decontaminate.cut_item(body)):
            patterns.setdefault(p, []).append(i)
    block = decontaminate.Block(patterns, decontaminate.Q, decontaminate.RATE)
    body = [decontaminate.codes(prose(1, 30) + " " + passage + " " + prose(2, 30) + " " + items[3])]
    whole = sorted(decontaminate._search(block, [(1, 1)], body))
    assert {i for _, i, _ in whole} == set(range(40))
    monkeypatch.setattr(decontaminate, "_ENTRIES", 20)
    assert sorted(decontaminate._search(block, [(1, 1)], body)) == whole


def test_rows_without_an_id_are_one_document_if_asked_for(spark):
    item = prose(1, 20)
    docs = documents(spark, [(None, item), (None, prose(2, 20)), (None, item), (4, item)])
    rows = decontaminate.matches(docs, bench(spark, [(3, item)]), unnamed=True).collect()
    assert sorted(map(str, rows)) == sorted(["Row(doc_id=None, item_id=3, edits=0)", "Row(doc_id=4, item_id=3, edits=0)"])
