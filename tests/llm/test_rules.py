import math
import re
from collections import Counter

import helpers
from helpers import F
from servelens.llm import rules

W = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = re.findall(W, text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(W, line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= set(range(i, i + 8))
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def check(df):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    stats = rules.with_statistics(df, "doc_id").withColumn("base_failed", rules.base_failed())
    key = lambda t: str(t)
    got = sorted(((r.doc_id, *(r[c] for c in columns), r.base_failed) for r in stats.collect()), key=key)
    assert got == sorted(((r.doc_id, *plain(r.text)) for r in df.collect()), key=key)


def test_statistics_equal_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    line = "one two three four five six seven eight nine"
    texts = [f"{line}\n{line} x {line}", "a " * 30, " ".join(map(str, range(40))) + " " + " ".join(map(str, range(5, 14))), "a b c d e f g", "a b c d e f g h",
             "|x|\n\n|x|\n \n", "É🙂 #*$%&|<>\x0b\x0c\x1cx\x85y"]
    check(helpers.frame(spark, texts))
    check(helpers.edge(spark).withColumn("windows", F.lit("clash")).withColumn("t", F.lit(1)))
    check(helpers.empty(spark))


def test_learned_list_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    learned = rules.fit(docs, train)
    assert learned.rules and "reject" in str(learned)
    got = rules.judge(docs, learned)
    assert got.count() == docs.count()
    rows = {(r.quality, r.kept): r.n for r in got.filter("not base_failed").join(held, "doc_id").groupBy("quality", "kept").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert rows[(1, True)] >= 0.99 * (rows[(1, True)] + rows.get((1, False), 0))
    assert rows[(0, False)] >= 0.85 * (rows[(0, False)] + rows.get((0, True), 0))
    assert got.filter("base_failed and kept").count() == 0


def test_no_labels_and_edges(spark):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    df = helpers.edge(spark)
    learned = rules.fit(df, labels)
    assert learned.rules == ()
    assert rules.judge(df, learned).filter("kept = base_failed").count() == 0
    assert rules.judge(helpers.empty(spark), rules.fit(helpers.empty(spark), labels)).count() == 0


def plain_list(rows, names, max_rules=12, max_tests=4, precision=0.9, least_covered=3, steps=24):
    """Sequential covering on dictionaries with the features' values, ``bad`` and ``prune``."""
    def cuts(some, n):
        values = sorted(r[n] for r in some if r[n] is not None)
        return {values[max(0, math.ceil(i / steps * len(values)) - 1)] for i in range(1, steps)} if values else set()
    edges = {n: sorted(cuts(rows, n) | cuts([r for r in rows if r["bad"]], n)) for n in names}
    holds = lambda r, tests: all((r[n] > x) == above for n, above, x in tests)
    left, found = rows, []
    while len(found) < max_rules:
        tests = []
        while len(tests) < max_tests:
            grow = [r for r in left if not r["prune"] and holds(r, tests)]
            p0 = sum(r["bad"] for r in grow)
            n0 = len(grow) - p0
            if not p0 or not n0:
                break
            best = None
            for name in names:
                for x in edges[name]:
                    for above in (False, True):
                        inside = [r for r in grow if (r[name] > x) == above]
                        q = sum(r["bad"] for r in inside)
                        if q:
                            gain = q * (math.log2(q / len(inside)) - math.log2(p0 / (p0 + n0)))
                            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9 or above and gain > best[0] - 1e-9 and best[1][0] == name):
                                best = gain, (name, above, x)
            if best is None:
                break
            tests.append(best[1])
        if not tests:
            break
        prune = [r for r in left if r["prune"]]
        worth = []
        for k in range(1, len(tests) + 1):
            inside = [r for r in prune if holds(r, tests[:k])]
            p = sum(r["bad"] for r in inside)
            worth.append((p, len(inside) - p))
        k = max(range(len(tests)), key=lambda i: ((worth[i][0] - worth[i][1]) / max(1, sum(worth[i])), worth[i][0], -i))
        p, n = worth[k]
        if p < least_covered or p < precision * (p + n):
            break
        found.append(tuple(tests[:k + 1]))
        left = [r for r in left if not holds(r, found[-1])]
    return found


def test_learner_equals_plain_sequential_covering(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    marked = docs.join(labels.select("doc_id", (1 - F.col("quality")).cast("int").alias("bad")), "doc_id").withColumn("prune", F.col("doc_id") % 3 == 0)
    stats = rules.with_statistics(marked, "bad", "prune").filter(~rules.base_failed())
    columns = rules.features()
    rows = [r.asDict() for r in stats.select("bad", "prune", *[c.cast("double").alias(n) for n, c in columns.items()]).collect()]
    for parameters in ({}, {"least_covered": 1, "precision": 0.6, "steps": 8}):
        got = rules.learn(stats, **parameters)
        assert [tuple((t[0], t[1], t[2]) for t in r.tests) for r in got.rules] == plain_list(rows, list(columns), **parameters)
    assert got.rules
