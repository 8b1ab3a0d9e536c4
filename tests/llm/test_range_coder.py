import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import helpers
from helpers import F
from servelens.llm import range_coder as rc

PATH = P.path("byte_bpe_50k.json")


def test_round_trips():
    rng = np.random.default_rng(2)
    skewed = np.minimum(rng.zipf(1.3, 30_000), 50_256)
    runs = np.tile(np.arange(900, 1000), 120)
    for ids, classes in ((skewed, 14), (rng.integers(0, 1 << 16, 9000), 14), (runs, 14), (np.zeros(5000, int), 14), ([7], 14), ([], 14),
                         (rng.integers(0, 1 << 31, 6000), 30), (np.arange(4096), 14), (np.arange(4097), 14), ([8, 15, 16, 65535, 0, 7], 14)):
        ids = np.array(ids, np.uint32)
        blocks = rc.encode_blocks(ids, classes)
        assert len(blocks) == -(-len(ids) // rc.BLOCK)
        assert rc.decode_blocks(blocks, classes).tolist() == ids.tolist()
        if len(ids):  # each block stands alone
            assert rc.decode_blocks(blocks[-1:], classes).tolist() == ids[(len(blocks) - 1) * rc.BLOCK:].tolist()
    assert sum(map(len, rc.encode_blocks(np.array(runs, np.uint32), 14))) < 0.2 * 2 * len(runs)
    assert sum(map(len, rc.encode_blocks(np.array(skewed, np.uint32), 14))) < 0.6 * 2 * len(skewed)


def test_every_outcome_has_a_share():
    """However sure the models are, no outcome's interval is empty."""
    for p2 in (0, 65535):
        for p0 in (0, 65535):
            m = rc._Models(2, 14)
            m.by2[:], m.by1[:], m.rest[:] = p2, p2, p0
            m.order1[:] = 5 << 2 | 3
            m.order2[:] = 6 << 2 | 3
            f2, f1 = m.predict(2)
            assert (f2 >= 1).all() and (f1 >= 1).all() and (65536 - f2 - f1 >= 1).all()


def test_runs_with_breaks_round_trip():
    rng = np.random.default_rng(9)
    parts = [np.full(rng.integers(1, 400), rng.integers(0, 4)) if rng.random() < 0.6 else rng.integers(0, 3, rng.integers(1, 60)) for _ in range(400)]
    ids = np.concatenate(parts).astype(np.uint32)
    assert rc.decode_blocks(rc.encode_blocks(ids, 14), 14).tolist() == ids.tolist()


def test_broken_block_raises():
    blocks = rc.encode_blocks(np.arange(3000, dtype=np.uint32), 14)
    bad = bytearray(blocks[0])
    bad[40] ^= 16
    with pytest.raises(ValueError):
        rc.decode_blocks([bytes(bad)], 14)
    with pytest.raises(ValueError):
        rc.decode_blocks([b"XXXX" + blocks[0][4:]], 14)


def test_joined_crc():
    data = np.random.default_rng(3).bytes(5000)
    for cuts in ([], [0], [1], [4999], [17, 17, 900], list(range(0, 5000, 611))):
        parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
        assert rc.joined_crc((len(p), zlib.crc32(p)) for p in parts) == zlib.crc32(data)
    assert rc.joined_crc([]) == 0


def check(df, **options):
    plain = Tokenizer.from_file(PATH)
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expect, start = [], 0
    for doc_id, text in rows:
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4")
        expect.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(map(tuple, rc.write_and_read(df, PATH, **options).collect()), key=lambda r: r[1])
    assert got == expect


def test_files(spark):
    check(helpers.fixture_docs(spark))


def test_edges(spark, monkeypatch):
    check(helpers.edge(spark).withColumn("partition", F.lit("clash")))
    assert rc.write_and_read(helpers.empty(spark), PATH).count() == 0


def test_long_documents_lie_in_parts(spark, tmp_path):
    texts = ["short one", "word and more " * 900, None, "x y z " * 700, "x y z " * 700, "end", "", "long last " * 2000]
    df = helpers.frame(spark, texts, ids=[7, 3, 4, 5, 5, 6, 8, None])
    check(df, size=500)
    rc.write_ids(df, PATH, str(tmp_path / "ids"), size=500)
    rows = spark.read.parquet(str(tmp_path / "ids")).collect()
    assert max(r.n_ids for r in rows) < 2 * 500 and {len(r.doc_ids) for r in rows if r.part is not None} == {1}
    assert sorted(r.part for r in rows if r.doc_ids == [3]) == list(range(len([r for r in rows if r.doc_ids == [3]]))) != [0]


def test_unpredicted_bits_lie_outside_the_coded_words():
    """The place of an id in its class costs no step of the coder: it follows the words as plain bits."""
    ids = np.random.default_rng(5).integers(1 << 15, 1 << 16, 3 * rc.BLOCK).astype(np.uint32)
    blocks = rc.encode_blocks(ids, 14)
    for i, block in enumerate(blocks):
        words = 2 * rc._HEAD.unpack_from(block)[4]
        assert words < 0.1 * rc.BLOCK
        plain = int.from_bytes(block[rc._HEAD.size + words:], "little")
        own = ids[i * rc.BLOCK:(i + 1) * rc.BLOCK].tolist()
        # all but those that orders 1 and 2 hit, 15 bits each
        assert [plain >> 15 * k & 0x7FFF for k in range(20)] == [x - (1 << 15) for x in own[:20]]
    assert rc.decode_blocks(blocks, 14).tolist() == ids.tolist()


def test_broken_words_never_leave_the_tables():
    ids = np.minimum(np.random.default_rng(8).zipf(1.3, 2 * rc.BLOCK), 50_256).astype(np.uint32)
    blocks = rc.encode_blocks(ids, 14)
    for at in range(rc._HEAD.size, rc._HEAD.size + 200, 7):
        bad = blocks[0][:at] + b"\xff" * 9 + blocks[0][at + 9:]
        with pytest.raises(ValueError):
            rc.decode_blocks([bad, blocks[1]], 14)
    with pytest.raises(ValueError):
        rc.decode_blocks([blocks[0][:100], blocks[1]], 14)


def test_carries_run_through_full_words():
    rng = np.random.default_rng(11)
    for _ in range(30):  # skewed outcomes move the interval to its upper end again and again
        ids = np.where(rng.random(rc.BLOCK + 500) < rng.random(), 60_000, rng.integers(0, 3, rc.BLOCK + 500)).astype(np.uint32)
        assert rc.decode_blocks(rc.encode_blocks(ids, 14), 14).tolist() == ids.tolist()
