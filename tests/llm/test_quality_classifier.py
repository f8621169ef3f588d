import numpy as np
import pyarrow as pa
from helpers import documents

from tabloom.llm import quality_classifier


def graded(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, grade int")


def corpus(n, seed=1):
    rng = np.random.default_rng(seed)
    common = [f"word{i}" for i in range(3000)]
    telling = {0: ["junk", "spam", "###"], 1: ["so", "so-so", "meh"], 2: []}
    docs, labels = [], []
    for i in range(n):
        grade = int(rng.choice(3, p=[0.2, 0.2, 0.6]))
        body = list(rng.choice(common, 80)) + list(rng.choice(telling[grade], 3) if telling[grade] else [])
        rng.shuffle(body)
        docs.append((i, " ".join(body)))
        labels.append((i, grade))
    return docs, labels


def test_held_out_accuracy_and_order_of_grades(spark):
    docs, labels = corpus(3000)
    out = quality_classifier.classify(documents(spark, docs), graded(spark, labels[:1500]), bound=10_000).collect()
    grade = dict(labels)
    held = [r for r in out if r["doc_id"] >= 1500]
    assert len(out) == 3000
    assert np.mean([r["kept"] == (grade[r["doc_id"]] == 2) for r in held]) > 0.95
    means = [np.mean([r["expected_grade"] for r in held if grade[r["doc_id"]] == g]) for g in range(3)]
    assert means[0] < means[1] < means[2] and means[2] > 1.8


def test_slopes_are_those_of_the_likelihood():
    rng = np.random.default_rng(2)
    score, thresholds, grades = rng.normal(size=30), np.array([-0.7, 0.2, 1.1]), rng.integers(0, 4, 30)

    def likelihood(s, t):
        tails = quality_classifier.Model(np.zeros(1), t).tails(s)
        full = np.column_stack((np.ones(30), tails, np.zeros(30)))
        return np.log(full[np.arange(30), grades] - full[np.arange(30), grades + 1]).sum()

    by_score, by_threshold = quality_classifier._slopes(score, thresholds, grades)
    for i in range(30):
        e = np.eye(30)[i] * 1e-6
        assert abs((likelihood(score + e, thresholds) - likelihood(score - e, thresholds)) / 2e-6 - by_score[i]) < 1e-4
    for j in range(3):
        e = np.eye(3)[j] * 1e-6
        slope = (likelihood(score, thresholds + e) - likelihood(score, thresholds - e)) / 2e-6
        assert abs(slope - by_threshold[j]) < 1e-4


def test_the_fit_does_not_depend_on_the_layout(spark):
    docs, labels = corpus(300)
    one = quality_classifier.classify(documents(spark, docs).coalesce(1), graded(spark, labels))
    many = quality_classifier.classify(documents(spark, docs).repartition(7), graded(spark, labels).repartition(3))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_defined_cases(spark):
    docs, labels = corpus(60)
    extra = [(900, None), (901, ""), (902, " \n"), (None, "word1 word2"), (903, "word1 " * 50_000)]
    labelled = graded(spark, [*labels, (900, None), (None, 1), (5000, 2)])
    out = quality_classifier.classify(documents(spark, docs + extra, "key", "grade", "slots"), labelled).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == 65 and all(got[i]["expected_grade"] == 0 and not got[i]["kept"] for i in (900, 901, 902))
    bare = quality_classifier.classify(documents(spark, docs[:2]), graded(spark, [])).collect()
    assert all(r["p_top"] is None and r["kept"] for r in bare)
    assert quality_classifier.classify(documents(spark, []), graded(spark, labels)).count() == 0
    single = quality_classifier.classify(documents(spark, docs), graded(spark, [(i, 0) for i in range(60)])).collect()
    assert all(r["expected_grade"] == 0 for r in single)


def plain_fit(dense, grades, top, rounds=4000):
    """Full-batch ascent on the penalised likelihood of all rows, with steps that never lower it."""
    weights, thresholds = np.zeros(dense.shape[1]), np.linspace(-1, 1, top)

    def parts(w, t):
        edges = np.concatenate(([-np.inf], t, [np.inf]))
        score = dense @ w
        upper, lower = (1 / (1 + np.exp(edges[grades + k] - score)) for k in (0, 1))
        return upper, lower, np.log(np.maximum(upper - lower, 1e-300)).sum() - w @ w / 2

    step, (upper, lower, value) = 1e-3, parts(weights, thresholds)
    for _ in range(rounds):
        mass = upper - lower
        by_weight = dense.T @ (1 - upper - lower) - weights
        by_threshold = np.array([
            (lower * (1 - lower) / mass)[grades == j].sum() - (upper * (1 - upper) / mass)[grades == j + 1].sum()
            for j in range(top)
        ])
        while step > 1e-12:
            w, t = weights + step * by_weight, thresholds + step * by_threshold
            if (np.diff(t) > 0).all() and (found := parts(w, t))[2] >= value:
                weights, thresholds, (upper, lower, value) = w, t, found
                step *= 1.5
                break
            step /= 2
    return weights, thresholds


def test_probabilities_are_near_those_of_a_plain_full_batch_fit():
    """The mini-batch fit stops short of the optimum: bounds are about twice the gaps measured (mean 0.005, largest 0.052)."""
    docs, labels = corpus(3000, seed=4)
    grades = np.array([g for _, g in labels])
    rows = []
    for first, last, row, slot in quality_classifier.features(pa.array([body for _, body in docs])):
        rows += [slot[row == i] for i in range(last - first)]
    model = quality_classifier.fit(rows, grades)
    used = np.flatnonzero(quality_classifier.telling(rows, grades))
    dense = np.array([np.isin(used, r) for r in rows], float)
    weights, thresholds = plain_fit(dense, grades, 2)
    want = 1 / (1 + np.exp(thresholds[None, :] - (dense @ weights)[:, None]))
    got = model.tails(dense @ model.weights[used])
    assert np.abs(got - want).mean() < 0.01 and np.abs(got - want).max() < 0.1
    assert ((got[:, -1] >= quality_classifier.KEEP_FROM) == (want[:, -1] >= quality_classifier.KEEP_FROM)).all()
    assert not model.weights[np.setdiff1d(np.arange(len(model.weights)), used)].any()
