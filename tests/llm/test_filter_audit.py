import itertools
import re

import duckdb
import pytest

import helpers
from servelens.llm import filter_audit


def plain(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    facts = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        bad = set()
        if len(words) < 200:
            bad.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            bad.add("C")
        if re.search("[#$%&*|]", text):
            bad.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs):
            bad.add("E")
        facts.append((source or "", bad, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in facts}:
        mine = [f for f in facts if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                here = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                failing = sum(letter in f[1] for f in mine)
                shapley[letter] += len(here)
                out[part, "".join(order), step] = [len(left), len(here), failing - len(here), sum(f[1] == {letter} for f in mine),
                                                   sum(f[2] for f in here), sum(f[3] for f in here), letter]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]] if isinstance(row[-1], str) else row[-1]
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.COUNTS) for r in df.collect()}


LABELS = "doc_id long, quality int, toxic int"


def cases():
    words = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", "\n", words, words, words + " # x", "word " * 300, words.upper(), "É" * 90 + "AB", "É" * 100 + "AB", words, "a|b " * 400, words + " $ " + "A" * 99,
             " ".join(f"w{i % 125}" for i in range(250)), " ".join(f"w{i % 124}" for i in range(250)), "\x1c".join(["w"] * 300)]
    docs = [(i, t, ["a", "b", None, ""][i % 4]) for i, t in enumerate(texts)]
    docs += [(3, words, "a"), (None, words, "b"), (None, None, None), (50, words, "hot"), (51, words, "hot")] + [(100 + i, "the same", "hot") for i in range(40)]
    labels = [(i, i % 3 % 2, i % 4 // 3) for i in range(0, 140)] + [(5, 1, 1), (5, 0, 0), (None, 1, 1), (7, None, None), (9999, 1, 1)]
    return docs, labels


def test_equals_brute_force_with_copies_across_parts(spark):
    docs, labels = cases()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = found(filter_audit.audit(df, spark.createDataFrame(labels, LABELS)))
    assert got == plain(docs, labels)
    assert len(got) == 600 * 4


def test_empty_tables_and_clashing_columns(spark):
    docs, labels = cases()
    names = ["part", "mask", "own", "digest", "is_first", "good", "toxic", "n", "orders", "shares", "removers", "row", "kept"]
    df = spark.createDataFrame([(*d, *range(len(names))) for d in docs], "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    marks = spark.createDataFrame([(*x, 1, 1) for x in labels], LABELS + ", good int, part int")
    assert found(filter_audit.audit(df, marks)) == plain(docs, labels)
    none = spark.createDataFrame([], LABELS)
    assert found(filter_audit.audit(df, none)) == plain(docs, [])
    assert filter_audit.audit(helpers.empty(spark), none).collect() == []


def test_fixture_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = found(filter_audit.audit(helpers.fixture_docs(spark), spark.read.parquet(f"{folder}/labels.parquet")))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    r = con.execute(filter_audit.AUDIT_SQL)
    at = [c[0] for c in r.description]
    rows = [dict(zip(at, x)) for x in r.fetchall()]
    assert got == {(x["part"], x["filter_order"], x["step"]): tuple(x[c] for c in filter_audit.COUNTS) for x in rows}


@pytest.mark.parametrize("long", ["x" * 2_000_000, "word " * 400_000])
def test_very_long_text(spark, long):
    docs = [(1, long, "a"), (2, long, "b")]
    assert found(filter_audit.audit(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame([], LABELS))) == plain(docs, [])
