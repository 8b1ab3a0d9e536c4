"""Repeated byte strings, removed by suffix arrays over shards of the corpus.

Every string of ``min_bytes`` bytes (a window) that starts at more than one place of the corpus is
found, and all bytes under such windows are removed.

1. *Anchors.*  A window's anchor is its ``gram``-byte string of least hash (the first of equals), so equal
   windows have equal anchors at equal places.  Successive windows with one anchor make a fragment; each
   window lies in exactly one.  Only hashes, places and lengths are written, no text.
2. *Fragments.*  Fragments of anchors that occur once in the corpus hold no repeated window and go.  Equal
   fragments are combined to one with a multiplicity before any text moves.
3. *Shards.*  The texts of the remaining fragments are dealt to shards of about ``shard_bytes`` by a hash of
   the anchor.  Fragments of an anchor with more bytes than that are dealt to several shards.
4. *Suffix arrays.*  A shard's suffixes are sorted by Larsson and Sadakane's refinement: groups ordered by
   a first key, then by pairs of ranks at doubling distances, and sorted groups left alone.  Suffixes that no
   possibly repeated window needs are left out of later rounds.  Kasai's common prefixes of neighbours say which windows are repeated.
5. *Merging.*  Shards that share an anchor emit its windows as sorted digests, in ranges.  The shards'
   sorted runs of a range meet in one task, where binary search finds those held by another shard.

No step pairs up documents or fragments, and no task holds all of a group: what grows with a frequent
passage is dealt to more shards and ranges.

Defined results: a NULL text is empty.  Texts are taken as UTF-8 bytes; matches never cross documents.
Rows equal in ``doc_id`` and text repeat each other like any two documents.  A NULL ``doc_id`` is a value
like others.  Empty tables give no rows.  Columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servelens.llm.common import slices, written

#: windows hashed at once
BLOCK = 1 << 16
PLACE_BITS = np.uint64(17)
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 64, 256, np.uint64)
_MULTIPLIERS = _RNG.integers(0, 1 << 64, 16, np.uint64) | np.uint64(1)

ANCHORS = "h long, f long, doc_id long, td long, start int, n int"


# ---------------------------------------------------------------------------
# anchors
# ---------------------------------------------------------------------------

def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` (a power of two) bytes from each place on, by doubling."""
    h = _BYTE[data]
    width, level = 1, 0
    while width < gram:
        left = h[:-width] * _MULTIPLIERS[level]
        left += h[width:]
        h, width, level = left, 2 * width, level + 1
    h ^= h >> np.uint64(32)
    h *= _MULTIPLIERS[15]
    h ^= h >> np.uint64(29)
    return h


def window_anchors(data: np.ndarray, min_bytes: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of the anchor of each window of ``data`` (at most ``BLOCK`` windows)."""
    h = gram_hashes(data, gram)
    bits = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    least = (h & ~bits) | np.arange(len(h), dtype=np.uint64)
    width, span = min_bytes - gram + 1, 1
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if span < width:
        least = np.minimum(least[:span - width], least[width - span:])
    at = (least & bits).astype(np.int64)
    return at, h[at]


def fragments(data: np.ndarray, stops: np.ndarray, min_bytes: int, gram: int):
    """``(text number, start in data, windows, anchor hash)`` arrays of all texts, which end at ``stops``."""
    starts = np.concatenate([[0], stops[:-1]])
    found = []
    for a in range(0, len(data) - min_bytes + 1, BLOCK):
        b = min(a + BLOCK, len(data) - min_bytes + 1)
        at, h = window_anchors(data[a:b + min_bytes - 1], min_bytes, gram)
        window = np.arange(a, b)
        text = np.searchsorted(stops, window, side="right")
        inside = window + min_bytes <= stops[text]
        window, text, at, h = window[inside], text[inside], at[inside], h[inside]
        if len(window):
            new = np.concatenate([[True], (np.diff(at) != 0) | (np.diff(window) != 1) | (np.diff(text) != 0)])
            first = np.flatnonzero(new)
            found.append((text[first], window[first], np.diff(np.append(first, len(window))), h[first]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), starts
    return *(np.concatenate(c) for c in zip(*found)), starts


def anchors(rows: DataFrame, min_bytes: int, gram: int) -> DataFrame:
    """``ANCHORS`` of ``(doc_id, td, data)``: anchor hash, fragment hash, document, first window, windows."""
    def cut(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts = batch.column(2)
            sizes = pc.binary_length(texts).to_numpy()
            for a, b in slices(sizes.tolist(), 4 << 20):
                raw = b"".join(texts.slice(a, b - a).to_pylist())
                text, window, n, h, starts = fragments(np.frombuffer(raw, np.uint8), np.cumsum(sizes[a:b]), min_bytes, gram)
                f = [digest(raw[s:s + k]) for s, k in zip(window.tolist(), (n + (min_bytes - 1)).tolist())]
                doc = pa.array(a + text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.array(f, np.uint64).view(np.int64)), batch.column(0).take(doc), batch.column(1).take(doc),
                     pa.array((window - starts[text]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["h", "f", "doc_id", "td", "start", "n"])

    return rows.where(F.octet_length("data") >= min_bytes).mapInArrow(cut, ANCHORS)


# ---------------------------------------------------------------------------
# suffix arrays
# ---------------------------------------------------------------------------

def first_keys(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number (zeros beyond the end)."""
    key = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        key = (key[:-width] << np.uint64(8 * width)) | key[width:]
    return key[:len(data)]


def group_starts(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the place of each key's group (its first member's), and whether the group has one member."""
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(keys)))
    return np.repeat(places[first], size), np.repeat(size == 1, size)


def suffix_order(data: np.ndarray, windows: np.ndarray, min_bytes: int) -> np.ndarray:
    """The windows (a flag per place) that may be repeated, in the order of their first ``min_bytes`` bytes or
    more.  Windows with a unique part are left out as soon as it shows."""
    n = len(data)
    keys = first_keys(data)
    suffixes = np.argsort(keys)
    rank, single = np.empty(n, np.int64), np.empty(n, bool)
    rank[suffixes], single[suffixes] = group_starts(keys[suffixes], np.arange(n))
    del keys
    depth, windows = 8, windows.copy()
    while True:
        # a window is possible while none of its parts of this depth is unique
        reach = min_bytes - depth
        uniques = np.concatenate([[0], np.cumsum(single)])
        at = np.flatnonzero(windows)
        windows[at] = uniques[at + reach + 1] == uniques[at]
        if depth >= min_bytes or not windows.any():
            return suffixes[windows[suffixes]]
        step = min(depth, min_bytes - depth)
        # places inside possible windows, whose longer parts the next round sorts
        opened = np.concatenate([[0], np.cumsum(windows)])
        places = np.arange(n)
        needed = opened[1:] > opened[np.maximum(places - (reach - step), 0)]
        slots = np.flatnonzero(needed[suffixes])
        moved = suffixes[slots]
        pair = (rank[moved] << 32) | rank[moved + step]
        order = np.argsort(pair)
        moved = moved[order]
        suffixes[slots] = moved
        rank[moved], single[moved] = group_starts(pair[order], slots)
        depth += step


def common_prefixes(data: np.ndarray, order: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it, at most the ``left`` bytes of either.

    Kasai: where both suffixes follow by one byte the pair that their text predecessors form, the prefix is
    one less than theirs.  Only the other pairs are compared, eight bytes at a time.
    """
    found = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return found
    keys = first_keys(np.concatenate([data, np.zeros(8, np.uint8)]))
    by_text = 1 + np.argsort(order[1:], kind="stable")
    i, j = order[by_text], order[by_text - 1]
    limit = np.minimum(left[i], left[j])
    follows = np.concatenate([[False], (np.diff(i) == 1) & (np.diff(j) == 1)])

    def compare(which: np.ndarray) -> np.ndarray:
        length = np.zeros(len(which), np.int64)
        open_ = np.arange(len(which))
        while len(open_):
            at = which[open_]
            differ = keys[i[at] + length[open_]] ^ keys[j[at] + length[open_]]
            same = differ == 0
            last = open_[~same]
            bits = differ[~same]
            zeros = sum((bits >> np.uint64(8 * k) == 0).astype(np.int64) for k in range(1, 8))
            length[last] += zeros
            open_ = open_[same]
            length[open_] += 8
            open_ = open_[length[open_] < limit[which[open_]]]
        return np.minimum(length, limit[which])

    heads = np.flatnonzero(~follows)
    chain = np.cumsum(~follows) - 1
    prefix = compare(heads)[chain] - (np.arange(len(i)) - heads[chain])
    again = np.flatnonzero(prefix <= 0)
    prefix[again] = compare(again)
    found[by_text] = prefix
    return found


def repeated_windows(data: np.ndarray, ends: np.ndarray, min_bytes: int) -> np.ndarray:
    """Flag per place: the window from there occurs again (windows end within their piece of ``data``)."""
    starts = np.concatenate([[0], ends[:-1]])
    left = np.repeat(ends, ends - starts) - np.arange(len(data))
    order = suffix_order(data, left >= min_bytes, min_bytes)
    near = common_prefixes(data, order, left) >= min_bytes
    flags = np.zeros(len(data), bool)
    flags[order[near]] = True
    flags[order[np.flatnonzero(near) - 1]] = True
    return flags


def covered(flags: np.ndarray, min_bytes: int) -> list[tuple[int, int]]:
    """Maximal byte ranges under the flagged windows."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > min_bytes)
    return list(zip(at[np.concatenate([[0], cut + 1])].tolist(), (at[np.append(cut, len(at) - 1)] + min_bytes).tolist()))


# ---------------------------------------------------------------------------
# shards and their merging
# ---------------------------------------------------------------------------

#: per fragment its covered ranges; for anchors in several shards also sorted window digests per range of digests
SHARD = "h long, f long, spans array<struct<a: int, b: int>>, part int, first binary, second binary, members binary, at binary"
SPANS = "h long, f long, spans array<struct<a: int, b: int>>"


def shard_spans(pieces: DataFrame, min_bytes: int) -> DataFrame:
    """Repeats within each shard of ``(shard, h, f, copies, parts, data)``."""
    def search(table):
        import pyarrow as pa
        import xxhash

        h, f, copies, parts = (table.column(c).to_pylist() for c in ("h", "f", "copies", "parts"))
        texts = table.column("data").to_pylist()
        ends = np.cumsum([len(t) for t in texts])
        raw = b"".join(texts)
        flags = repeated_windows(np.frombuffer(raw, np.uint8), ends, min_bytes)
        out, split = [], {}
        for k, end in enumerate(ends.tolist()):
            start = end - len(texts[k])
            windows = end - min_bytes + 1 - start
            own = flags[start:start + windows]
            if copies[k] > 1:
                own = np.ones(windows, bool)  # equal fragments elsewhere
            out.append((h[k], f[k], [{"a": a, "b": b} for a, b in covered(own, min_bytes)], None, None, None, None, None))
            if parts[k] > 1:
                split.setdefault((h[k], parts[k]), []).extend((start + w, f[k], w) for w in range(windows))
        for (anchor, n), windows in split.items():
            digests = np.array([divmod(xxhash.xxh3_128_intdigest(raw[p:p + min_bytes]), 1 << 64) for p, _, _ in windows], np.uint64)
            order = np.lexsort((digests[:, 1], digests[:, 0]))
            first, second = digests[order].T
            members = np.array([x[1] for x in windows], np.int64)[order]
            at = np.array([x[2] for x in windows], np.int32)[order]
            # one of equal windows stands for all: the others are known to be repeated
            one = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
            first, second, members, at = (x[one] for x in (first, second, members, at))
            cuts = np.searchsorted(first, np.array([(k << 64) // n for k in range(1, n)], np.uint64))
            for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(first)])):
                if a < b:
                    out.append((anchor, None, None, part, *(x[a:b].tobytes() for x in (first, second, members, at))))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.int32(), *[pa.binary()] * 4]
        names = ["h", "f", "spans", "part", "first", "second", "members", "at"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return pieces.groupBy("shard").applyInArrow(search, SHARD)


def merged_spans(runs: DataFrame, min_bytes: int) -> DataFrame:
    """Windows of an anchor's shards that another shard holds too: ``(h, f, spans)``."""
    def merge(table):
        import pyarrow as pa

        anchor = table.column("h")[0].as_py()
        column = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        firsts, seconds = column("first", np.uint64), column("second", np.uint64)
        members, at = column("members", np.int64), column("at", np.int32)
        all_first, all_second = np.concatenate(firsts), np.concatenate(seconds)
        order = np.lexsort((all_second, all_first))
        all_first, all_second = all_first[order], all_second[order]
        found: dict[int, list[int]] = {}
        for first, second, member, place in zip(firsts, seconds, members, at):
            # a run holds a digest once, so one that stands in the merged run twice is another shard's too
            low, high = np.searchsorted(all_first, first), np.searchsorted(all_first, first, side="right")
            times = np.zeros(len(first), np.int64)
            for k in range(int((high - low).max())):
                inside = low + k < high
                times[inside] += all_second[(low + k)[inside]] == second[inside]
            for f, w in zip(member[times > 1].tolist(), place[times > 1].tolist()):
                found.setdefault(f, []).append(w)
        out = []
        for f, windows in found.items():
            flags = np.zeros(max(windows) + 1, bool)
            flags[windows] = True
            out.append((anchor, f, [{"a": a, "b": b} for a, b in covered(flags, min_bytes)]))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["h", "f", "spans"])

    return runs.groupBy("h", "part").applyInArrow(merge, SPANS)


def repeated_spans(rows: DataFrame, min_bytes: int, gram: int, shard_bytes: int) -> DataFrame:
    """``(doc_id, td, spans)`` for the texts of ``(doc_id, td, data)`` that hold repeated windows."""
    found = written(anchors(rows, min_bytes, gram), "suffix-anchors")
    size = F.col("n") + F.lit(min_bytes - 1)
    # written, so that the join's sides are shuffles or a broadcast of known size and a hot anchor's rows can be split
    often = written(found.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h"), "suffix-often")
    found = written(found.join(often, "h", "left_semi"), "suffix-repeated")
    distinct = written(found.groupBy("h", "f").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "td", "start", "n")).alias("x"))
                       .select("h", "f", "copies", "x.*"), "suffix-fragments")
    total = distinct.agg(F.sum(size)).first()[0] or 0
    n_shards = max(1, -(-total // shard_bytes))
    parts = F.ceil(F.sum(size) / F.lit(shard_bytes)).cast("int")
    large = written(distinct.groupBy("h").agg(parts.alias("parts")).where("parts > 1"), "suffix-large")
    dealt = distinct.join(large, "h", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("h", F.pmod(F.col("f"), F.col("parts"))), F.lit(n_shards)))
    wanted = dealt.groupBy("doc_id", "td").agg(F.collect_list(F.struct("shard", "h", "f", "copies", "parts", "start", size.alias("size"))).alias("wanted"))
    texts = rows.where(F.octet_length("data") >= min_bytes)
    if texts.groupBy("doc_id", "td").count().where("count > 1").limit(1).count():
        texts = texts.dropDuplicates(["doc_id", "td"])
    pieces = (texts.join(wanted, ["doc_id", "td"]).select("data", F.explode("wanted").alias("w"))
              .select("w.shard", "w.h", "w.f", "w.copies", "w.parts", F.substring("data", F.col("w.start") + 1, F.col("w.size")).alias("data")))
    searched = written(shard_spans(pieces, min_bytes), "suffix-shards")
    spans = searched.where("part is null and size(spans) > 0").select("h", "f", "spans")
    spans = spans.unionByName(merged_spans(searched.where("part is not null").drop("spans", "f"), min_bytes))
    spans = written(spans.groupBy("h", "f").agg(F.flatten(F.collect_list("spans")).alias("spans")), "suffix-spans")
    own = F.transform("spans", lambda s: F.struct((s["a"] + F.col("start")).alias("a"), (s["b"] + F.col("start")).alias("b")))
    return found.join(spans, ["h", "f"]).select("doc_id", "td", own.alias("spans")).groupBy("doc_id", "td").agg(
        F.flatten(F.collect_list("spans")).alias("spans"))


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<a: long, b: long>>, kept binary"


def without_repeats(docs: DataFrame, *, min_bytes: int = 400, gram: int = 64, shard_bytes: int = 2 << 20, with_kept: bool = False) -> DataFrame:
    """Per document its bytes, those removed, the removed runs and the digest of the rest.

    ``with_kept`` adds the runs (``removed``) and the remaining bytes (``kept``).
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), data.alias("data"))
    # joins need an id; a text's hash keeps different texts of one id apart
    rows = rows.select("id", F.coalesce("id", F.lit(0)).cast("long").alias("doc_id"), F.xxhash64("data").alias("td"), "data")
    spans = written(repeated_spans(rows.drop("id"), min_bytes, gram, shard_bytes), "suffix-documents")

    def remove(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts, runs = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            out = []
            for k, doc_id in enumerate(ids):
                text, merged = texts[k].as_py(), []
                for a, b in sorted((s["a"], s["b"]) for s in runs[k].as_py() or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                cuts = [0, *(x for run in merged for x in run), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                out.append((doc_id, len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(),
                            [{"a": a, "b": b} for a, b in merged] if with_kept else None, kept if with_kept else None))
            kinds = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"])

    found = rows.join(spans, ["doc_id", "td"], "left").select("id", "data", "spans").mapInArrow(remove, KEPT)
    return found if with_kept else found.drop("removed", "kept")
