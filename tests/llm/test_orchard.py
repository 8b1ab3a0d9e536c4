import hashlib
import math
import random

import numpy as np
import pytest

from servelens.llm import orchard

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label); one dict of results per kept row."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda v: [tuple(v[p * width:(p + 1) * width]) for p in range(parts)]
    kept = [(i, cut(v), label) for i, v, label in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p] for r in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        members = {}
        for _, v, _ in kept:
            for p, x in enumerate(v):
                members.setdefault((p, nearest(p, x)[1]), []).append(x)
        for (p, e), xs in members.items():
            books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    out = []
    for i, v, label in kept:
        found = [nearest(p, x) for p, x in enumerate(v)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    total = {}
    for _, _, error, label in out:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, code, error, total[label], digest) for i, code, error, label in out]


def found(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=repr)


def check(spark, rows, schema=SCHEMA, **parameters):
    df = spark.createDataFrame(rows, schema).repartition(3)
    assert found(orchard.code_digest(df, **parameters)) == sorted(plain([r[:3] for r in rows], **parameters), key=repr)


def test_equals_brute_force_with_nulls_ties_and_repeats(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, rng.uniform(-2, 2)]) for _ in range(32)], rng.choice([None, 1, 2, 3])) for i in rng.sample(range(1000), 300)]
    rows += [rows[0], rows[5], (2000, [0.1] * 32, None), (2001, [0.1] * 32, None), (None, [0.3] * 32, 1)]
    rows += [(1, None, 1), (-5, [math.nan] * 32, 1), (-4, [math.inf] + [0.0] * 31, 1), (-3, [None] + [0.0] * 31, 1), (-2, [], 1)]
    check(spark, rows)
    check(spark, rows, parts=4, entries=5, rounds=2)
    check(spark, rows, parts=1, entries=70, rounds=1)


def test_few_vectors_and_grid_ties(spark):
    check(spark, [(i, [float(i)] * 8, 0) for i in range(3)])
    check(spark, [(i, [float(i % 4), float(i % 3)] * 8, i % 2) for i in range(60)])
    check(spark, [(i, [1.0] * 16, None) for i in range(40)])


def test_empty_table_and_clashing_columns(spark):
    none = orchard.code_digest(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert orchard.code_digest(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    names = ["v", "code", "error", "label_error", "cell", "sums", "n", "of_label"]
    rows = [(i, [float(i * 7 % 5), 0.5] * 8, i % 3, *range(len(names))) for i in range(50)]
    check(spark, rows, SCHEMA + ", " + ", ".join(f"{c} int" for c in names))


@pytest.mark.parametrize("rows", [[(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], [(1, [0.0] * 9, 1)], [(1, [1e30] * 8, 1), (2, [0.0] * 8, 1)]])
def test_vectors_that_cannot_be_coded_exactly_raise(spark, rows):
    with pytest.raises(Exception, match="components"):
        orchard.code_digest(spark.createDataFrame(rows, SCHEMA)).collect()


def test_search_visits_fewer_entries_than_all_and_finds_the_nearest():
    rng = np.random.default_rng(1)
    entries = rng.integers(-500, 500, (3, 16, 4))
    x = rng.integers(-600, 600, (2000, 12))
    best, distance = orchard.Codebooks(entries).search(x)
    all_distances = ((x.reshape(-1, 3, 1, 4) - entries) ** 2).sum(-1)
    assert (best == all_distances.argmin(-1)).all() and (distance == all_distances.min(-1)).all()
