import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

import helpers
from servelens.llm.packing import assign, pack

PATH = P.path("word_bpe_49k.json")


def test_assign_balances_and_fills():
    placed, cost = assign([7, 5, 5, 3, 2, 2], 8, 1.0, 1.0)
    assert sum(n for _, _, n, _, _ in placed) == 24 and len(cost) == 3
    room = defaultdict(int)
    for _, _, n, k, offset in placed:
        assert offset == room[k]
        room[k] += n
    assert max(room.values()) <= 8


def check(df, got, seq_len):
    plain = Tokenizer.from_file(PATH)
    ids = [np.array(plain.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4") for r in df.collect()]
    assert sum(r.length for r in got) == sum(map(len, ids))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for spans in by_seq.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= seq_len
    padded = sum(seq_len - sum(n for _, n in s) for s in by_seq.values())
    expect = defaultdict(list)
    for r, x in zip(df.collect(), ids):
        expect[r.doc_id].append(x)
    for doc_id, own in expect.items():
        if len(own) == 1:
            at = 0
            for r in sorted(by_doc[doc_id], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(own[0])
                assert r.ids_crc32 == zlib.crc32(own[0][at:at + r.length].tobytes())
                at += r.length
            assert at == len(own[0])
        else:
            assert sum(r.length for r in by_doc[doc_id]) == sum(map(len, own))
    return padded


def test_whole_table(spark):
    df = helpers.fixture_docs(spark)
    assert check(df, pack(df, PATH, end_id=1).collect(), 2048) < 2048
    n_buckets = -(-df.count() // 50)
    assert check(df, pack(df, PATH, end_id=1, seq_len=128, bucket_rows=50).collect(), 128) < 128 * n_buckets


def test_edges(spark):
    df = helpers.edge(spark).withColumn("bucket", helpers.F.lit("clash"))
    check(df, pack(df, PATH, end_id=1).collect(), 2048)
    assert pack(helpers.empty(spark), PATH, end_id=1).count() == 0
    one = helpers.frame(spark, ["a b"])
    r = pack(one, PATH, end_id=1, with_ids=True).first()
    assert np.frombuffer(r.ids, "<u4")[-1] == 1 and r.length == r.doc_tokens
