import numpy as np

import helpers
from helpers import F
from servelens.llm import quality


def test_label_model_finds_planted_accuracies():
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.85
    on_good, on_bad = [0.99, 0.995, 0.98, 0.999], [0.8, 0.5, 0.6, 0.4]
    votes = np.stack([np.where(rng.random(20_000) < np.where(good, g, 1 - b), 1, -1) * (rng.random(20_000) < 0.9) for g, b in zip(on_good, on_bad)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model([(tuple(p), int(n)) for p, n in zip(patterns.tolist(), counts)])
    assert abs(model.good - 0.85) < 0.03
    assert np.abs(np.array(model.right_on_bad) - on_bad).max() < 0.12 and np.abs(np.array(model.right_on_good) - on_good).max() < 0.02


def test_scorer_learns_a_linear_rule():
    rng = np.random.default_rng(1)
    rows = [{int(k): 1.0 for k in rng.choice(50, 8, replace=False)} for _ in range(500)]
    labels = [float(3 in r) for r in rows]
    w = quality.fit_scorer(rows, labels, 50)
    assert all((w[50] + sum(v * w[k] for k, v in r.items()) > 0) == bool(y) for r, y in zip(rows, labels))


def test_held_out_accuracy(spark):
    """No label is used in fitting, so all labels are held out."""
    for sf in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
        got = quality.classify(docs)
        assert got.count() == docs.count() and got.columns == ["doc_id", "score", "kept"]
        r = {(x.quality, x.kept): x.n for x in got.join(labels, "doc_id").groupBy("quality", "kept").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert r.get((1, True), 0) >= 0.99 * (r.get((1, True), 0) + r.get((1, False), 0))
        assert r.get((0, False), 0) >= 0.9 * (r.get((0, True), 0) + r.get((0, False), 0))


def test_edges(spark):
    df = helpers.edge(spark).withColumn("score", F.lit("clash")).withColumn("draw", F.lit(1))
    got = quality.classify(df)
    assert got.count() == df.count() and got.filter("score is null or kept is null").count() == 0
    same = [r.score for r in quality.classify(helpers.frame(spark, ["a b c", "a b c", None, ""])).orderBy("doc_id").collect()]
    assert same[0] == same[1] and same[2] == same[3]
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    assert quality.classify(helpers.empty(spark)).count() == 0 and quality.keep_good(helpers.empty(spark)).count() == 0


def test_scorer_sees_words_beside_shapes():
    texts = [b"the cat sat on a mat", b"the dog sat on a mat"]  # equal shapes and statistics
    a, b = (quality.features_of(x, quality.stats_of(x), 2048) for x in texts)
    assert a != b
    w = quality.fit_scorer([a, b] * 20, [1.0, 0.0] * 20, 2048, rounds=400)
    model = quality.QualityModel(quality.LabelModel(0.5, (), ()), tuple(w.tolist()))
    assert model.score(texts[0]) > 0.5 > model.score(texts[1])


def plain_label_model(votes, rounds=200):
    """Expectation maximisation over unpooled rows, one number at a time."""
    n = len(votes[0])
    good = [0.95 * 0.2 ** sum(v < 0 for v in row) for row in votes]
    model = None
    clip = lambda x, a, b: min(max(x, a), b)
    for _ in range(rounds):
        share = clip((sum(good) + 1) / (len(votes) + 2), 0.01, 0.99)
        g, b = [], []
        for k in range(n):
            yes = sum(p for p, row in zip(good, votes) if row[k] > 0)
            some = sum(p for p, row in zip(good, votes) if row[k])
            no = sum(1 - p for p, row in zip(good, votes) if row[k] < 0)
            any_ = sum(1 - p for p, row in zip(good, votes) if row[k])
            g.append(clip((yes + 1) / (some + 1.1), 0.5, 0.9999))
            b.append(clip((no + 0.1) / (any_ + 1), 1.5 * (1 - g[k]), 0.99))
        model, good = (share, g, b), []
        for row in votes:
            a, z = share, 1 - share
            for k, v in enumerate(row):
                a *= g[k] if v > 0 else 1 - g[k] if v < 0 else 1
                z *= 1 - b[k] if v > 0 else b[k] if v < 0 else 1
            good.append(a / (a + z))
    return model, good


def plain_scorer(rows, labels, size, rounds=150, rate=1.0, decay=1e-4):
    import math

    w, last = [0.0] * (size + 1), [0.0] * (size + 1)
    for k in range(rounds):
        ahead = [a + k / (k + 3) * (a - b) for a, b in zip(w, last)]
        slope = [decay * a for a in ahead]
        for row, y in zip(rows, labels):
            z = ahead[size] + sum(v * ahead[s] for s, v in row.items())
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y) / len(rows)
            slope[size] += error
            for s, v in row.items():
                slope[s] += error * v
        last, w = w, [a - rate * d for a, d in zip(ahead, slope)]
    return w


def test_classifier_equals_brute_force_on_documents(spark):
    docs = helpers.fixture_docs(spark).orderBy("doc_id").limit(150)
    docs = docs.union(docs.where("doc_id % 40 = 0"))  # some rows twice
    texts = [(r.text or "").encode() for r in docs.collect()]
    stats = [quality.stats_of(t) for t in texts]
    votes = [quality.votes_of(s) for s in stats]
    model, _ = plain_label_model(votes)
    got = quality.fit(docs, train_rows=1000, size=64)
    assert np.allclose([got.labels.good, *got.labels.right_on_good, *got.labels.right_on_bad], [model[0], *model[1], *model[2]], atol=1e-6)
    w = plain_scorer([quality.features_of(t, s, 64) for t, s in zip(texts, stats)], got.labels.posterior(votes), 64)
    assert np.allclose(got.weights, w, atol=2e-3)


def test_sample_reaches_the_driver_packed(spark):
    """A number of the sample takes a few bytes of the driver, not an object or two."""
    import tracemalloc

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 2500)) for _ in range(300)]
    docs = helpers.frame(spark, texts)
    numbers = sum(len(quality.features_of(t, quality.stats_of(t), 2048)) for t in map(str.encode, texts))
    tracemalloc.start()
    try:
        model = quality.fit(docs, train_rows=1000)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model is not None and numbers > 300_000
    assert peak < 24 * numbers + 4 * 3 * 2049 * len(texts)


def test_packed_numbers_sort_as_lists_do():
    rng = np.random.default_rng(8)
    slots = [rng.integers(0, 3000, rng.integers(0, 4)).tolist() for _ in range(300)]
    values = [rng.random(rng.integers(0, 4)).astype(np.float32).tolist() for _ in range(300)]
    for rows, kind in ((slots, ">u4"), (values, ">f4")):
        assert [np.frombuffer(b, kind).tolist() for b in sorted(quality._packed(r, kind) for r in rows)] == sorted(rows)
