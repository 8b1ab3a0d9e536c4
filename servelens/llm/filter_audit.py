"""Filter interaction audit: what each filter removes at each place of every order of the filters.

A document's failures are a bit mask.  Documents are counted per part and mask (a mask cell), and each
cell folds over the array of all orders: one struct per order and step, weighted with the cell's counts.
The structs of a part's cells are summed element by element.

The filters (``FILTERS``) are those of the result contract: A too few words, B too few distinct words, C
too many capital letters, D odd symbols, E a copy of the text of a smaller ``doc_id``.

Defined results: a NULL text is empty; a NULL part is the empty string.  A row with a NULL ``doc_id`` is
no copy and makes none, and has no labels.  Rows equal in ``doc_id`` and text are no copies of each other
(neither id is smaller); each counts.  Several label rows of one id count as one with the greatest values.
No documents give no rows.  Columns beside those named are not read.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servelens.llm.common import column_slices, fenced, written

FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

#: byte classes: A to Z, the symbols of D, first bytes of a code point
CAPITAL, ODD, STARTS = (np.array([f(b) for b in range(256)], np.int64) for f in (
    lambda b: 65 <= b <= 90, lambda b: b in b"#$%&*|", lambda b: b >> 6 != 2))

ROWS = "doc_id long, part string, digest binary, own int"


def own_failures(texts) -> np.ndarray:
    """The bits of the filters that look at one text alone (A 1, B 2, C 4, D 8), for an Arrow string array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(texts)
    # white space at a text's ends leaves empty strings, which are no words
    words = lists.flatten().dictionary_encode()
    text_of = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    is_word = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
    text_of, code = text_of[is_word], code[is_word]
    n_words = np.bincount(text_of, minlength=len(texts))
    n_distinct = np.bincount(np.unique(text_of << 32 | code) >> 32, minlength=len(texts))
    # counts of byte classes per text, by running sums at the texts' ends
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    ends = offsets - offsets[0]
    count = lambda kind: np.diff(np.concatenate([[0], np.cumsum(kind[raw])])[ends])
    n_capital, n_odd, n_chars = count(CAPITAL), count(ODD), count(STARTS)
    failing = (n_words < 200, 100 * n_distinct < 50 * n_words, 100 * n_capital > 2 * n_chars, n_odd > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failing))


def judge_texts(rows: DataFrame) -> DataFrame:
    """``(doc_id, part, digest, own)``: the text as its SHA-256, with its own failures."""
    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            for a, texts in column_slices(batch, "text"):
                own = own_failures(texts)
                digests = [hashlib.sha256(t).digest() for t in texts.cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(texts)), batch.column(1).slice(a, len(texts)), pa.array(digests, pa.binary()),
                     pa.array(own, pa.int32())], names=["doc_id", "part", "digest", "own"])

    return rows.mapInArrow(judge, ROWS)


def judged(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``(part, mask, good, toxic)`` per document.

    Texts are read once and leave as a digest.  The least id of each text comes from an aggregate, so a
    text that a third of all rows share is combined before the shuffle; rows meet it on digest and id,
    a key that no group of copies shares.
    """
    rows = written(judge_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                                           F.coalesce(F.col("text"), F.lit("")).alias("text"))), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("is_first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    copied = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (rows.join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
            .select("part", (F.col("own") + copied.cast("int") * 16).alias("mask"),
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord("A"))


def fails(letter: Column) -> Column:
    return F.col("mask").bitwiseAND(bit(letter)) != 0


def steps() -> Column:
    return F.sequence(F.lit(1), F.lit(len(FILTERS)))


def removers(orders: Column) -> Column:
    """For a cell: the filter that removes its documents, per order (empty: none)."""
    def first_failing(order: Column) -> Column:
        at = lambda step: F.substring(order, step, 1)
        return F.aggregate(steps(), F.lit(""), lambda gone, step: F.when((gone == "") & fails(at(step)), at(step)).otherwise(gone))
    return F.transform(orders, first_failing)


def folded(orders: Column) -> Column:
    """For a cell (``mask``, ``n``, ``good``, ``toxic``, ``shares``): a struct per order and step, flattened."""
    def weigh(condition: Column, count: str = "n") -> Column:
        return F.when(condition, F.col(count)).otherwise(F.lit(0).cast("long"))

    def one_order(order: Column) -> Column:
        def one_step(state: Column, step: Column) -> Column:
            letter, gone = F.substring(order, step, 1), state["gone"]
            here = ~gone & fails(letter)
            row = F.struct(
                order.alias("filter_order"), step.alias("step"), weigh(~gone & ~here).alias("kept"), weigh(here).alias("removed"),
                weigh(gone & fails(letter)).alias("redundant"), weigh(F.col("mask") == bit(letter)).alias("unique_fails"),
                weigh(here, "good").alias("good_lost"), weigh(here, "toxic").alias("toxic_lost"),
                (F.col("n") * F.element_at("shares", F.ascii(letter) - ord("A") + 1)).alias("shapley"))
            return F.struct((gone | here).alias("gone"), F.concat(state["rows"], F.array(row)).alias("rows"))
        fields = ", ".join(f"{c}: bigint" for c in COUNTS)
        none = F.array().cast(f"array<struct<filter_order: string, step: int, {fields}>>")
        return F.aggregate(steps(), F.struct(F.lit(False).alias("gone"), none.alias("rows")), one_step, lambda state: state["rows"])

    return F.flatten(F.transform(orders, one_order))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``part, filter_order, step`` and the counts, for every part, all orders and steps."""
    rows = judged(docs, labels, part)
    cells = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    cells = cells.withColumn("orders", F.array(*[F.lit("".join(o)) for o in itertools.permutations(FILTERS)]))
    # fenced: a mask's 120 removers are worked out once, not for each struct that reads their shares
    cells = fenced(cells.withColumn("removers", removers(F.col("orders"))))
    share = lambda letter: F.size(F.filter("removers", lambda r: r == letter))
    cells = fenced(cells.withColumn("shares", F.array(*[share(letter) for letter in FILTERS])))
    weighted = cells.select("part", F.explode(folded(F.col("orders"))).alias("row")).select("part", "row.*")
    return weighted.groupBy("part", "filter_order", "step").agg(*[F.sum(c).alias(c) for c in COUNTS])


#: DuckDB twin of :func:`audit` over ``documents`` and ``labels``
AUDIT_SQL = r"""
with words as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
judged as (
  select w.part,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(doc_id > min(doc_id) over (partition by text), false)] as f,
         doc_id in (select doc_id from labels where quality = 1) as good,
         doc_id in (select doc_id from labels where toxic = 1) as toxic
  from words w),
letters as (select unnest(range(1, 6)) as i),
orders as (
  select [a.i, b.i, c.i, d.i, e.i] as o from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
cells as (
  select part, f, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from judged group by all),
placed as (
  select part, o, s.i as step, o[s.i] as letter, n, good, toxic, f[o[s.i]] as fails,
         len([x for x in o[1:s.i - 1] if f[x]]) > 0 as gone,
         len([x for x in f if x]) as n_fails
  from cells, orders, letters s),
summed as (
  select part, o, step, letter,
         sum(if(not gone and not fails, n, 0)) as kept, sum(if(not gone and fails, n, 0)) as removed,
         sum(if(gone and fails, n, 0)) as redundant, sum(if(fails and n_fails = 1, n, 0)) as unique_fails,
         sum(if(not gone and fails, good, 0)) as good_lost, sum(if(not gone and fails, toxic, 0)) as toxic_lost
  from placed group by all)
select part, array_to_string([chr((64 + x)::int) for x in o], '') as filter_order, step::int as step,
       kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
       good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, letter))::bigint as shapley
from summed
"""
