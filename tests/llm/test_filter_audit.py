import collections
import itertools
import random

from helpers import documents, prose, words

from tabloom.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def conditions(body):
    w = words(body)
    capitals = sum("A" <= c <= "Z" for c in body)
    return [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * capitals > 3 * len(body), any(c in "#$%&*|" for c in body)]


def brute_force(docs, labels):
    """Rows of the table of all orders from (doc_id, text, lang) rows, by running every order."""
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    rows = []
    for d, t, lang in docs:
        fails = conditions(t or "") + [d is not None and d > first[t or ""]]
        said = [(q == 1, x == 1) for i, q, x in labels if i is not None and i == d]
        rows.append((lang or "", fails, any(g for g, _ in said), any(x for _, x in said)))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley, found = collections.Counter(), []
        for order in itertools.permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                shapley[f] += len(gone)
                redundant = sum(r[1][f] for r in own) - len(gone)
                unique = sum(r[1][f] and sum(r[1]) == 1 for r in own)
                name = "".join("ABCDE"[v] for v in order)
                found.append((f, part, name, step, len(left), len(gone), redundant, unique, sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*row[1:], shapley[row[0]]) for row in found]
    return sorted(out)


def corpus(seed):
    rng, docs = random.Random(seed), []
    for i in range(120):
        body = prose(rng.randrange(12), rng.choice([20, 150, 199, 200, 260]))
        body = body.upper()[: rng.choice([0, 5, 40])] + body[: len(body)] if rng.random() < 0.3 else body
        body += rng.choice(["", "", " #", " a|b", " same" * 300])
        docs.append((rng.randrange(80) if rng.random() < 0.9 else None, rng.choice([body, body, None, ""]), rng.choice(["en", "de", None, ""])))
    return docs


def frame(spark, docs, *extra):
    rows = documents(spark, [(d, t) for d, t, _ in docs], *extra).drop("lang")
    langs = spark.createDataFrame([(i, lang) for i, (_, _, lang) in enumerate(docs)], "place long, lang string")
    numbered = spark.createDataFrame([(i, *r) for i, r in enumerate(rows.collect())], "place long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema))
    return numbered.join(langs, "place").drop("place")


def table(spark, docs, labels, *extra):
    masks = filter_audit.failure_masks(frame(spark, docs, *extra))
    joined = filter_audit.with_labels(masks, spark.createDataFrame(labels, LABELS))
    return sorted(tuple(r) for r in filter_audit.audit(joined).collect())


def test_equals_running_every_order(spark):
    rng, docs = random.Random(2), corpus(1)
    labels = [(rng.randrange(80) if rng.random() < 0.9 else None, rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(100)]
    assert table(spark, docs, labels, "part", "digest", "mask", "n", "doc", "words", "good", "salt") == brute_force(docs, labels)


def test_query_equals_running_every_order(spark, tmp_path):
    docs, labels = corpus(3), [(i, i % 2, i % 3 % 2) for i in range(40)]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    rows = filter_audit.op12_filter_audit(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == brute_force(docs, labels)


def test_long_texts_copies_and_empty_tables(spark):
    long = prose(4, 300_000)
    docs = [(1, long, "en"), (2, long, "en"), (2, long, "en"), (None, long, "en"), (None, long, None), (3, None, None), (4, "", "")]
    assert table(spark, docs, []) == brute_force(docs, [])
    assert table(spark, [], []) == []


def test_every_order_is_reached_by_swaps_of_neighbours():
    for n in range(1, 6):
        order, seen = list(range(n)), {tuple(range(n))}
        for level in filter_audit.neighbour_swaps(n):
            order[level : level + 2] = order[level + 1], order[level]
            seen.add(tuple(order))
        assert seen == set(itertools.permutations(range(n)))


def test_diagrams_stay_reduced():
    """However the levels are swapped, a diagram has the size of one built in that order."""
    rng = random.Random(6)
    for _ in range(20):
        counts = {m: (rng.randrange(3), 0, 0) for m in rng.sample(range(32), rng.randint(0, 32))}
        diagram = filter_audit.Diagram(5, counts, 3)
        for level in filter_audit.neighbour_swaps(5):
            diagram.swap(level)
            places = {v: i for i, v in enumerate(diagram.order)}
            moved = {sum(1 << places[v] for v in range(5) if m >> v & 1): c for m, c in counts.items()}
            assert size(diagram.root) == size(filter_audit.Diagram(5, moved, 3).root)


def size(root):
    seen, waiting = set(), [root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, filter_audit._Node) and node not in seen:
            seen.add(node)
            waiting += [node.passed, node.failed]
    return len(seen)
