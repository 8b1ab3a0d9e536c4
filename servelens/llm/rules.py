"""Quality rules: decision lists learned by sequential covering.

Every whole text gets countable statistics by built-in functions alone.  From the labelled documents
(at most ``train_rows``, drawn by a hash of the id) conjunctions of thresholds on these statistics are
learned one after the other: a rule grows by the threshold of greatest information gain until it covers
no good document of the growing part, is pruned back on the other part, and is accepted if it is precise
there; what it covers leaves both parts.  Each step is one small aggregate over binned statistics.  The
list becomes one ordered Spark conditional: the first rule that holds rejects, else the text is kept.

NULL and empty texts have no words.  Labels that are NULL, or contradict each other for an id, are not
used; without labels the list is empty and keeps all that the base rules keep.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servelens.llm.common import SPACE, WORD, fenced, occurrences, written

WINDOW = 8


def _per(x: Column, n: Column) -> Column:
    return F.when(n > 0, x / n).otherwise(0.0)




def features() -> dict[str, Column]:
    """What thresholds are learned on, as expressions of the statistics."""
    c = F.col
    return {
        "symbols_per_word": _per(c("n_symbols"), c("n_words")),
        "dup_line_share": _per(c("n_dup_lines"), c("n_lines")),
        "repeat_share": _per(c("n_repeat_words"), c("n_words")),
        "word_length": _per(c("word_chars"), c("n_words")),
        "capital_share": _per(c("n_capitals"), c("word_chars")),
        "shouts_per_word": _per(c("n_shouts"), c("n_words")),
        "stops_per_word": _per(c("n_stops"), c("n_words")),
        "variety": _per(c("n_distinct"), F.sqrt(c("n_words"))),
    }


def with_statistics(docs: DataFrame, *kept: str) -> DataFrame:
    """The named columns and the statistics of ``text``; every step of an array is a column of its own,
    so that none is evaluated again inside another step's lambda."""
    t = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(*kept, t.alias("t"))
    words = F.array_remove(F.split("t", SPACE), "")
    lines = F.filter(F.split("t", "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    count = lambda characters: occurrences(F.col("t"), characters).cast("long")
    df = df.select(*kept, F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"), lines.alias("lines"),
                   F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"), count("#*$%&|<>").alias("n_symbols"),
                   F.length(F.regexp_replace("t", "[^A-ZÀ-ÖØ-Þ]+", "")).cast("long").alias("n_capitals"),
                   count("!|").alias("n_shouts"), count(".").alias("n_stops"))
    basic = ["word_chars", "n_symbols", "n_capitals", "n_shouts", "n_stops"]
    n = F.size("hashes")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))).otherwise(
        F.array().cast("array<bigint>"))
    df = df.select(*kept, *basic, n.cast("long").alias("n_words"), F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct"),
                   F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                   windows.alias("windows"))
    basic += ["n_words", "n_distinct", "n_lines", "n_dup_lines"]
    # positions of windows that occur again: neighbours after a sort by window
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.when(again, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.select(*kept, *basic, placed.alias("placed"))
    pairs = F.zip_with(F.slice("placed", 1, F.size("placed") - 1), F.slice("placed", 2, F.size("placed") - 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    df = df.select(*kept, *basic, F.when(F.col("placed").isNotNull(), F.array_sort(F.array_distinct(F.flatten(pairs)))).alias("at"))
    covered = WINDOW + F.aggregate(F.zip_with(F.slice("at", 1, F.size("at") - 1), F.slice("at", 2, F.size("at") - 1),
                                              lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(0), lambda x, y: x + y)
    return fenced(df.select(*kept, *basic, F.when(F.col("at").isNotNull(), covered).otherwise(0).cast("long").alias("n_repeat_words")))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Rejects where all ``(feature, is_above, threshold)`` hold."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        found = features()
        out = F.lit(True)
        for name, above, cut in self.tests:
            out = out & ((found[name] > cut) if above else (found[name] <= cut))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if above else '<='} {cut:g}" for n, above, cut in self.tests)


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def keeps(self) -> Column:
        """Ordered conditional over the statistics' columns."""
        if not self.rules:
            return F.lit(True)
        out = F.when(self.rules[0].column(), False)
        for rule in self.rules[1:]:
            out = out.when(rule.column(), False)
        return out.otherwise(True)

    def __str__(self) -> str:
        return "\n".join([*(f"if {r}: reject" for r in self.rules), "else: keep"])


def learn(stats: DataFrame, *, max_rules: int = 12, max_tests: int = 4, precision: float = 0.9, least_covered: int = 3, steps: int = 24) -> DecisionList:
    """``stats``: statistics with ``bad`` (0 or 1) and ``prune`` (boolean), a bounded number of rows."""
    found = features()
    names = list(found)
    quantiles = [F.percentile_approx(found[n], [i / steps for i in range(1, steps)], 10000).alias(n) for n in names]
    # cuts from all rows and from the bad ones alone, as a rare kind shows only there
    cuts: dict[str, set[float]] = {n: set() for n in names}
    for rows in (stats, stats.filter("bad = 1")):
        r = rows.agg(*quantiles).first()
        for n in names:
            cuts[n] |= set(r[n] or ())
    edges = {n: sorted(c) for n, c in cuts.items()}
    def bin_of(name: str) -> Column:
        cuts = F.array(*map(F.lit, edges[name])) if edges[name] else F.array().cast("array<double>")
        return F.size(F.filter(cuts, lambda c: c < found[name])).alias(name)

    binned = stats.select("bad", "prune", *map(bin_of, names))
    binned = written(binned, "rules-binned")

    def holds(tests) -> Column:
        out = F.lit(True)
        for n, above, k in tests:
            out = out & ((F.col(n) > k) if above else (F.col(n) <= k))
        return out

    uncovered, rules = F.lit(True), []
    while len(rules) < max_rules:
        tests: list[tuple[str, bool, int]] = []
        while len(tests) < max_tests:
            rows = binned.filter(uncovered & ~F.col("prune") & holds(tests))
            counted = rows.select("bad", F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])).alias("x")).groupBy("x.f", "x.b").agg(
                F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
            by: dict[str, list] = {n: [[0, 0] for _ in range(len(edges[n]) + 1)] for n in names}
            for r in counted:
                by[r.f][r.b] = [r.p, r.n]
            p0, n0 = (sum(x[i] for x in by[names[0]]) for i in (0, 1))
            if not p0 or not n0:
                break
            best = None
            for name in names:
                p, n = 0, 0
                for k, (dp, dn) in enumerate(by[name][:-1]):
                    p, n = p + dp, n + dn
                    for above, (q, m) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        if q:
                            gain = q * (math.log2(q / (q + m)) - math.log2(p0 / (p0 + n0)))
                            # of equal cuts the one that rejects less
                            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9 or above and gain > best[0] - 1e-9 and best[1][0] == name):
                                best = (gain, (name, above, k))
            if best is None:
                break
            tests.append(best[1])
        if not tests:
            break
        sums = []
        for size in range(1, len(tests) + 1):
            h = holds(tests[:size])
            sums += [F.sum(F.when(h, F.col("bad"))).alias(f"p{size}"), F.sum(F.when(h, 1 - F.col("bad"))).alias(f"n{size}")]
        r = binned.filter(uncovered & F.col("prune")).agg(*sums).first()
        worth = [((r[f"p{k}"] or 0), (r[f"n{k}"] or 0)) for k in range(1, len(tests) + 1)]
        size = max(range(len(tests)), key=lambda k: ((worth[k][0] - worth[k][1]) / max(1, sum(worth[k])), worth[k][0], -k))
        p, n = worth[size]
        if p < least_covered or p < precision * (p + n):
            break
        tests = tests[:size + 1]
        rules.append(Rule(tuple((name, above, float(edges[name][k])) for name, above, k in tests)))
        uncovered = uncovered & ~holds(tests)
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = 10_000) -> DecisionList:
    """The list learned on at most ``train_rows`` labelled documents (``labels``: ``doc_id, quality`` 0 or 1)."""
    one = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.min("quality").alias("least"), F.max("quality").alias("most")).filter("least = most")
    draw = F.xxhash64(F.lit("rules"), "label_id")
    sample = written(one.select("label_id", (1 - F.col("least")).cast("int").alias("bad"), (F.pmod(draw, F.lit(3)) == 0).alias("prune")).orderBy(
        draw, "label_id").limit(train_rows), "rules-sample")
    chosen = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("label_id"))
    stats = written(with_statistics(chosen, "bad", "prune"), "rules-statistics")
    # the base rules come first; the list learns from what they leave
    return learn(stats.filter(~base_failed()))


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """Statistics, base verdict and ``kept`` of every row."""
    stats = with_statistics(docs, "doc_id").withColumn("base_failed", base_failed())
    return stats.withColumn("kept", ~F.col("base_failed") & rules.keeps())
