import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import by_id
from voxlake.llm import quality_classifier as Q
from voxlake.llm import source_mixing as M
from voxlake.llm import textops as X
from voxlake.llm import toxicity as T
from voxlake.llm.labels import bounded


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def corpus():
    """Ordinary texts, junk, and texts with insults of which some forms occur only once."""
    pick = random.Random(4)
    syllables = "an the or il be ro sa mi ta ne".split()
    word = lambda: "".join(pick.choice(syllables) for _ in range(pick.randrange(1, 4)))
    rows, marks = [], []
    for i in range(600):
        text = [word() for _ in range(pick.randrange(20, 120))]
        quality, toxic = int(i % 5 > 0), int(i % 6 == 0)
        if toxic:
            for _ in range(3):
                text[pick.randrange(len(text))] = "zgork" + word() if pick.random() < 0.5 else "quxxo"
        if not quality:
            text = [w + "%%%" for w in text] if i % 2 else [w for w in text[:15] for _ in range(6)]
        rows.append((i, " ".join(text)))
        marks.append((i, quality, toxic, "x"))
    return rows, marks


ODD = [(1000, None), (1001, ""), (1002, " \n"), (1003, "a"), (1004, "é" * 200_000)]


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.mark.parametrize(("score", "column"), [(Q.quality_scores, 1), (T.toxicity_scores, 2)])
def test_held_out_texts_are_told_apart(spark, documents, corpus, score, column):
    rows, marks = corpus
    marks = [*marks, (1000, 1, 0, None), (5000, 1, 1, "no text"), (None, 1, 1, ""), (7, None, None, ""),
             (8, 2, 3, "")]
    found = by_id(score(documents(rows + ODD), labels(spark, marks)))
    assert set(found) == {i for i, _ in rows + ODD}
    assert all(0 <= r.score <= 1 and r.held_out == held_out(i) for i, r in found.items())
    of = {m[0]: m[column] for m in marks[:600]}
    test = [i for i in of if held_out(i)]
    assert sum(found[i].predicted == of[i] for i in test) >= 0.97 * len(test)
    assert found[1000].score == found[1001].score


@pytest.mark.parametrize("score", [Q.quality_scores, T.toxicity_scores])
def test_held_out_labels_are_not_learned(spark, documents, corpus, score):
    rows, marks = corpus
    docs = documents(rows[:200])
    turned = [(i, 1 - q, 1 - t, x) if held_out(i) else (i, q, t, x) for i, q, t, x in marks[:200]]
    plain = {i: r.score for i, r in by_id(score(docs, labels(spark, marks[:200]))).items()}
    other = {i: r.score for i, r in by_id(score(docs, labels(spark, turned))).items()}
    assert plain == pytest.approx(other)


@pytest.mark.parametrize("score", [Q.quality_scores, T.toxicity_scores])
def test_no_labels_no_documents(spark, documents, score):
    found = by_id(score(documents([(1, "some text"), (2, None)]), labels(spark, [])))
    assert found[1].score == pytest.approx(found[2].score) == pytest.approx(0.5)
    assert score(documents([]), labels(spark, [(1, 1, 1, "")])).count() == 0


def test_language_models_are_distributions(spark):
    """Shared and class probabilities of what can follow a context add up to one at most."""
    texts = spark.createDataFrame(
        [("the cat sat on the mat", 0), ("that dog bit the cat", 1), ("a mat", 0)],
        "text string, label int")
    counts = T.class_counts(texts)
    expected = {}
    for text, label in texts.collect():
        for word in text.split():
            for i in range(len(word) + 1):
                gram = (" " + word + " ")[max(0, i - 4):i + 2]
                pair = expected.setdefault(gram, [0, 0])
                pair[label] += 1
    name = lambda key: key.to_bytes(6, "big").lstrip(b"\0").decode()
    assert {name(r.gram): [r.ordinary, r.toxic] for r in counts.collect()} == expected
    shared = T.shared_backoff(counts).collect()
    totals = {}
    for row in shared:
        assert 0 < row.shared < 1
        totals[name(row.tail)[:-1]] = totals.get(name(row.tail)[:-1], 0) + row.shared
    assert all(0.2 < total <= 1 + 1e-9 for total in totals.values())


def test_unseen_everywhere_says_nothing(spark):
    texts = spark.createDataFrame([("abc abc", 0), ("abd abd", 1)], "text string, label int")
    seen, unseen = T.likelihood_ratios(T.class_counts(texts))
    model = T.Model(T.lookup(seen, "gram"), T.lookup(unseen, "context"))
    import pyarrow as pa
    toxic, ordinary, other, empty = model.measures(*X.packed(
        pa.array(["abd", "abc", "xyzzyx xyzzy", ""])))
    assert toxic[1] > 0 > ordinary[1]
    assert abs(other[1]) < 1 and list(empty) == [0, 0]


def test_ratios_are_found_by_exact_grams(spark):
    n = 200_000
    table = T.lookup(spark.range(n).selectExpr("id * 77773 + 5 gram", "double(id) ratio", "1L n"), "gram")
    keys = np.arange(n, dtype=np.uint64) * np.uint64(77773)
    assert (table.find(keys + np.uint64(5)) == np.arange(n)).all()
    assert np.isnan(table.find(keys + np.uint64(6))).all()


def test_ratios_in_parts_give_the_same_scores(spark, documents, corpus, monkeypatch):
    rows, marks = corpus
    docs, known = documents(rows[:200] + ODD), labels(spark, marks[:200])
    whole = by_id(T.toxicity_scores(docs, known))
    monkeypatch.setattr(T, "PART", 1 << 10)
    parts = by_id(T.toxicity_scores(docs, known))
    assert {i: r.score for i, r in parts.items()} == pytest.approx({i: r.score for i, r in whole.items()})


def test_features_do_not_depend_on_neighbours():
    import pyarrow as pa
    texts = ["one two two", None, "", "Ünïcode  x", "two two one"]
    model = Q.Model(np.random.default_rng(0).normal(size=(2 * Q.BUCKETS, 3)).astype(np.float32),
                    np.zeros(3, np.float32))
    together = model.scores(*X.packed(pa.array(texts)))
    for text, row in zip(texts, together, strict=True):
        assert np.allclose(model.scores(*X.packed(pa.array([text]))), row)


DOMAIN = "CASE WHEN toxic = 1 THEN 2 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 0 END"


def test_mixture_reaches_its_targets(spark, documents, corpus):
    rows, marks = corpus
    weights = {"plain": 0.85, "poor": 0.1, "toxic": 0.05}
    found = by_id(M.mixing_rates(documents(rows + ODD), labels(spark, marks), F.expr(DOMAIN), weights))
    assert set(found) == {i for i, _ in rows + ODD}
    tokens = sum(r.n_tokens for r in found.values())
    assert all(r.rate >= 0 for r in found.values())
    assert found[1000].n_tokens == found[1001].n_tokens == 0
    for name, weight in weights.items():
        total = sum(r.rate * r.n_tokens * r[f"p_{name}"] for r in found.values())
        assert total == pytest.approx(weight * tokens, rel=1e-3)


def test_descent_is_projected_least_squares(spark):
    """Rates at their bound: the same optimum as plain projected gradient in numpy."""
    rng = np.random.default_rng(3)
    n = rng.integers(1, 50, 80).astype(float)
    p = rng.dirichlet([0.5, 0.5, 0.5], 80)
    weights = [0.96, 0.03, 0.01]
    rows = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)],
                                 "n_words long, scores array<double>")
    history = M.descent(rows, weights, steps=60)
    rates = M._rates(p, history)
    target = np.array(weights) * n.sum()
    best = np.ones(80)
    whiten = (p * n[:, None]).T @ p
    whiten = np.linalg.inv(whiten + 1e-3 * np.trace(whiten) / 3 * np.eye(3))
    for _ in range(60):
        best = np.maximum(0, best - p @ whiten @ ((best * n) @ p - target))
    assert (rates == 0).any()
    assert np.allclose(rates, best)


def _least_squares(n, p, target, steps=300_000):
    """Converged nonnegative least squares, in the metric of the whole Gram matrix."""
    whiten = np.linalg.inv((p * n[:, None]).T @ p)
    rates = np.ones(len(n))
    for _ in range(steps):
        new = np.maximum(0, rates - p @ whiten @ ((rates * n) @ p - target))
        if np.abs(new - rates).max() < 1e-13:
            break
        rates = new
    return (rates * n) @ p


@pytest.mark.parametrize("weights", [[0.899, 0.1, 0.001], [0.999, 0.0009, 0.0001], [0.05, 0.05, 0.9]])
def test_rare_domains_reach_what_least_squares_can(spark, weights):
    rng = np.random.default_rng(5)
    n = rng.integers(1, 50, 400).astype(float)
    rare = rng.uniform(0, 4e-3, 400) * (rng.random(400) < 0.05)  # sum n p^2 near 1e-7 of the tokens
    common = rng.uniform(0.0, 1.0, 400) * (1 - rare)
    p = np.column_stack([common, 1 - rare - common, rare])
    rows = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)],
                                 "n_words long, scores array<double>")
    target = np.array(weights) * n.sum()
    history, missed = M.settled(rows, weights, M.descent(rows, weights))
    reached = (M._rates(p, history) * n) @ p
    assert np.allclose(missed, reached - target, atol=1e-6 * n.sum())
    best = _least_squares(n, p, target)
    whiten = np.linalg.inv((p * n[:, None]).T @ p)
    error = lambda totals: (totals - target) @ whiten @ (totals - target)
    assert error(reached) <= error(best) * (1 + 1e-3) + 1e-6 * n.sum()


def test_rare_targets_are_not_missed(spark):
    n, rare = np.full(200, 100.0), np.zeros(200)
    rare[:4] = 2e-3
    p = np.column_stack([np.linspace(0, 1, 200) * (1 - rare), np.linspace(1, 0, 200) * (1 - rare), rare])
    rows = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)],
                                 "n_words long, scores array<double>")
    weights = [0.5, 0.49996, 0.00004 * 4]
    target = np.array(weights) / sum(weights) * n.sum()
    _, missed = M.settled(rows, weights, M.descent(rows, weights))
    assert (np.abs(missed) <= 1e-6 * target).all()
    begun = (M._rates(p, M.descent(rows, weights)) * n) @ p
    assert abs(begun[2] - target[2]) > 0.1 * target[2]  # what the steps alone leave


def test_mixture_of_nothing(spark, documents):
    none = labels(spark, [])
    assert M.mixing_rates(documents([]), none, F.expr(DOMAIN), {"a": 1.0, "b": 2.0}).count() == 0
    found = by_id(M.mixing_rates(documents([(1, None), (2, "a b")]), none, F.expr(DOMAIN),
                                 {"a": 1.0, "b": 1.0}))
    assert found[1].n_tokens == 0 and found[2].rate == pytest.approx(1.0)


@pytest.mark.parametrize("weights", [{"a": 0.0, "b": 0.0}, {"a": -1.0, "b": 2.0},
                                     {"a": float("nan"), "b": 1.0}, {}])
def test_weights_that_mean_nothing_are_refused(documents, spark, weights):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    with pytest.raises(ValueError):
        M.mixing_rates(documents([(1, "a b")]), none, F.expr(DOMAIN), weights)


def test_labels_without_a_document_do_not_use_up_the_sample(spark, documents):
    docs = documents([(i, "text") for i in range(40)]).select(F.col("doc_id").alias("id"), "text")
    marks = spark.createDataFrame([(i, i % 2) for i in range(0, 4000, 2)], "id long, label int")
    found = [r.id for r in bounded(marks, docs, 15).collect()]
    assert len(found) == 15 and all(i < 40 for i in found)
    assert sorted(r.id for r in bounded(marks, docs, 100).collect()) == list(range(0, 40, 2))
    assert bounded(marks, docs.limit(0), 5).isEmpty()


def test_report_of_a_mixture(spark):
    rows = [(10, 0.9, 0.1, 1.0), (30, 0.2, 0.8, 0.5), (20, 0.5, 0.5, 0.0), (0, 0.5, 0.5, 7.0)]
    rated = spark.createDataFrame(rows, "n_tokens long, p_a double, p_b double, rate double")
    found = {r.domain: r for r in M.mixture_report(rated, {"a": 3.0, "b": 1.0}).collect()}
    assert found["a"].target == pytest.approx(45) and found["b"].target == pytest.approx(15)
    assert found["a"].expected == pytest.approx(sum(n * p * r for n, p, _, r in rows))
    assert found["b"].expected == pytest.approx(sum(n * p * r for n, _, p, r in rows))
    share = sum(n * r for n, *_, r in rows) ** 2 / (60 * sum(n * r * r for n, *_, r in rows))
    assert found["a"].effective_share == pytest.approx(share)
    empty = M.mixture_report(rated.limit(0), {"a": 1.0, "b": 1.0}).collect()
    assert [(r.target, r.expected, r.effective_share) for r in empty] == [(0, 0, None)] * 2
