"""Quality classifier from weak labels: heuristic labellers, expectation maximisation, hashed linear scorer.

1. Every whole document gets the votes of overlapping heuristic labellers (good, bad, none).
2. The vote patterns are counted over all documents (at most 3 ** labellers of them) and
   expectation maximisation estimates each labeller's accuracy and the share of good documents.
3. A logistic scorer on hashed features (words, word shapes and statistics) is fitted to the posterior
   labels of a bounded sample of about ``train_rows`` documents, drawn by a hash of the row.
4. Every whole document is scored; it is kept if the score reaches ``threshold``.

The labellers know form, not content: a document that is bad by its content only (toxic, say) has the
votes of a good one, so the words cannot learn it either.  No given label is used.  NULL texts count as empty; an empty text has only the vote of the length
labeller.  Repeated rows are scored alike.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servelens.llm.common import text_slices

#: frequent function words of the languages served
FUNCTION_WORDS = frozenset(w.encode() for w in (
    "the of and a to in is it that for on with as was are this be at by from or an not "
    "de la que el en y los se del las un por con una su para es al lo como "
    "le et les des du dans est une pour qui sur pas au par il ne ce plus "
    "der die und das von zu den mit sich ist dem nicht ein eine auf als auch im").split())
SYMBOLS = b"#*$%&|<>"

_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))


@dataclass(frozen=True)
class Stats:
    """Statistics of a whole text."""

    words: int
    symbols: float  # per word
    capitals: float  # of letters
    shouts: float  # "!" and "|" per word
    repeats: float  # words equal to the one before, of words
    distinct: float  # of words
    function: float  # function words, of words
    stops: float  # full stops per word
    dup_lines: float  # lines equal to an earlier one, of lines


def stats_of(text: bytes) -> Stats:
    import numpy as np

    words = text.lower().split()
    n = max(1, len(words))
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum() + seen[192:].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return Stats(len(words), sum(int(seen[b]) for b in SYMBOLS) / n, upper / max(1, upper + lower), int(seen[33] + seen[124]) / n,
                 sum(map(bytes.__eq__, words[1:], words)) / n, len(set(words)) / n,
                 sum(map(FUNCTION_WORDS.__contains__, words)) / n, int(seen[46]) / n, 1 - len(set(lines)) / max(1, len(lines)))


def _vote(bad: bool, good: bool) -> int:
    return -1 if bad else int(good)


#: name and vote of each labeller
LABELLERS = (
    ("length", lambda s: _vote(s.words == 0, s.words >= 15)),
    ("symbols", lambda s: _vote(s.symbols > 0.15, s.symbols < 0.03 and s.words >= 5)),
    ("capitals", lambda s: _vote(s.capitals > 0.3 and s.words >= 5, s.capitals < 0.15 and s.words >= 5)),
    ("shouts", lambda s: _vote(s.shouts > 0.1, s.shouts < 0.02 and s.words >= 5)),
    ("repeats", lambda s: _vote(s.repeats > 0.25, s.repeats < 0.1 and s.words >= 15)),
    ("variety", lambda s: _vote(s.words >= 30 and s.distinct * s.words ** 0.5 < 3, s.distinct * s.words ** 0.5 > 4)),
    ("function words", lambda s: _vote(s.function < 0.06 and s.words >= 20, s.function > 0.12)),
    ("sentences", lambda s: _vote(s.stops < 0.015 and s.words >= 40, 0.03 < s.stops < 0.5)),
    ("lines", lambda s: _vote(s.dup_lines > 0.5, s.dup_lines == 0 and s.words >= 15)),
)


def votes_of(stats: Stats) -> tuple[int, ...]:
    return tuple(vote(stats) for _, vote in LABELLERS)


@dataclass(frozen=True)
class LabelModel:
    """``good``: share of good documents; per labeller the chance that a vote on a good document
    says good and that a vote on a bad one says bad."""

    good: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]

    def posterior(self, votes):
        """Probability of good, for an array of vote rows; labellers without a vote say nothing."""
        import numpy as np

        v, g, b = np.asarray(votes), np.array(self.right_on_good), np.array(self.right_on_bad)
        odds = np.log(self.good / (1 - self.good)) + (v > 0) @ np.log(g / (1 - b)) + (v < 0) @ np.log((1 - g) / b)
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> LabelModel:
    """Expectation maximisation over counted vote patterns.

    It starts from the votes for bad, as each labeller knows one kind of bad document and all
    others take it for good.  A labeller is kept better than chance: its votes for bad stay likelier on
    bad documents than on good ones."""
    import numpy as np

    votes = np.array([p for p, _ in patterns], float)
    counts = np.array([n for _, n in patterns], float)[:, None]
    good = 0.95 * 0.2 ** (votes < 0).sum(axis=1)
    model = None
    for _ in range(rounds):
        on_good, on_bad = good[:, None] * counts, (1 - good)[:, None] * counts
        share = (on_good.sum() + 1) / (counts.sum() + 2)
        g = (((votes > 0) * on_good).sum(axis=0) + 1) / (((votes != 0) * on_good).sum(axis=0) + 1.1)
        b = (((votes < 0) * on_bad).sum(axis=0) + 0.1) / (((votes != 0) * on_bad).sum(axis=0) + 1)
        g = np.clip(g, 0.5, 0.9999)
        b = np.clip(b, 1.5 * (1 - g), 0.99)
        now = LabelModel(float(np.clip(share, 0.01, 0.99)), tuple(g.tolist()), tuple(b.tolist()))
        if now == model:
            break
        model, good = now, now.posterior(votes)
    return model


#: start of the checksum of words, apart from shapes of the same characters
_WORD = zlib.crc32(b"word:")


@lru_cache(maxsize=20_000)
def _slot(name: bytes, size: int) -> int:
    return zlib.crc32(name) % size


def features_of(text: bytes, stats: Stats, size: int) -> dict[int, float]:
    """Hashed features: roots of the shares of each word (lower case) and word shape (runs of a character class as one), and steps
    of the statistics."""
    from collections import Counter

    import numpy as np

    shape = np.frombuffer(text.translate(_SHAPE), np.uint8)
    if len(shape):
        shape = shape[np.concatenate([[True], shape[1:] != shape[:-1]])]
    found: dict[int, float] = {}
    counts = Counter(shape.tobytes().split())
    total = max(1, sum(counts.values()))
    for word, n in counts.items():
        slot = _slot(word, size)
        found[slot] = found.get(slot, 0.0) + (n / total) ** 0.5
    words = Counter(text.lower().split())
    for word, n in words.items():
        slot = zlib.crc32(word, _WORD) % size
        found[slot] = found.get(slot, 0.0) + (n / max(1, stats.words)) ** 0.5
    steps = {"words": min(8, stats.words.bit_length())} | {
        name: min(10, int(20 * getattr(stats, name))) for name in ("symbols", "capitals", "shouts", "repeats", "function", "stops", "dup_lines")} | {
        "variety": min(10, int(stats.distinct * stats.words ** 0.5))}
    for name, step in steps.items():
        slot = _slot(f"={name}:{step}".encode(), size)
        found[slot] = found.get(slot, 0.0) + 1.0
    return found


def fit_scorer(rows: list[dict[int, float]], labels, size: int, rounds: int = 150, rate: float = 1.0, decay: float = 1e-4, counts=None):
    """Weights (the last is the bias) of a logistic scorer with soft labels: accelerated gradient steps from zero.
    ``counts``: how often each row stands in the sample (default: once)."""
    return fit_weights(feature_matrix(((list(row), list(row.values())) for row in rows), len(rows), size), labels, rounds, rate, decay, counts)


def feature_matrix(rows, n: int, size: int):
    """One line of ``size`` values and a one for the bias from the ``(slots, values)`` of each of ``n`` rows."""
    import numpy as np

    x = np.zeros((n, size + 1), np.float32)
    x[:, size] = 1
    for i, (slots, values) in enumerate(rows):
        x[i, slots] = values
    return x


def fit_weights(x, labels, rounds: int = 150, rate: float = 1.0, decay: float = 1e-4, counts=None):
    """``fit_scorer`` on the lines of a matrix."""
    import numpy as np

    y, w, last = np.asarray(labels, np.float32), np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32)
    n = np.ones(len(x), np.float32) if counts is None else np.asarray(counts, np.float32)
    n = n / max(1.0, float(n.sum()))
    for k in range(rounds):
        ahead = w + k / (k + 3) * (w - last)
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        last, w = w, ahead - rate * (x.T @ (n * (p - y)) + decay * ahead)
    return w


@dataclass(frozen=True)
class QualityModel:
    labels: LabelModel
    weights: tuple[float, ...]

    def score(self, text: bytes) -> float:
        import math

        size = len(self.weights) - 1
        z = self.weights[size] + sum(v * self.weights[k] for k, v in features_of(text, stats_of(text), size).items())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _packed(numbers, kind: str) -> bytes:
    """The (unsigned) numbers as bytes: they sort as the list of numbers does, and no number is an object of its own."""
    import numpy as np

    return np.fromiter(numbers, kind, len(numbers)).tobytes()


def fit(docs: DataFrame, train_rows: int = 8000, size: int = 2048) -> QualityModel | None:
    """Label model over all documents, scorer on a sample; None for an empty table.

    The sample's features reach the driver packed, a few bytes each, as its memory is bounded by them."""
    import numpy as np

    rows = docs.select(F.xxhash64("doc_id", "text").alias("draw"), F.col("text").cast("binary").alias("text"))

    def vote(batches):
        import pyarrow as pa

        for batch in batches:
            for _, _, texts in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array([list(votes_of(stats_of(t))) for t in texts], pa.list_(pa.int32()))], ["votes"])

    patterns = [(tuple(r.votes), r.n) for r in rows.select("text").mapInArrow(vote, "votes array<int>").groupBy("votes").agg(
        F.count(F.lit(1)).alias("n")).orderBy("votes").collect()]
    if not patterns:
        return None
    labels = fit_label_model(patterns)

    # a draw of the hash below this share; texts become features where they stand, before anything is gathered
    share = train_rows / sum(n for _, n in patterns)
    drawn = rows.filter(F.shiftrightunsigned("draw", 11) < F.lit(int(min(1.0, share) * (1 << 53))))

    def featurise(batches):
        import pyarrow as pa

        for batch in batches:
            for a, b, texts in text_slices(batch, "text"):
                stats = [stats_of(t) for t in texts]
                found = [features_of(t, s, size) for t, s in zip(texts, stats)]
                columns = [bytes(v + 1 for v in votes_of(s)) for s in stats], [_packed(f, ">u4") for f in found], [_packed(f.values(), ">f4") for f in found]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c, pa.binary()) for c in columns)],
                                                 ["draw", "votes", "slots", "values"])

    # rows equal in id and text share a draw: they stand once, with their number; the limit bounds what reaches the driver
    featured = drawn.mapInArrow(featurise, "draw long, votes binary, slots binary, values binary")
    sample = featured.groupBy("draw").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("votes", "slots", "values")).alias("x")).select(
        "draw", "n", "x.*").orderBy("draw").limit(2 * train_rows).collect()
    sample.sort(key=lambda r: (r.votes, r.slots, r["values"]))
    votes = np.frombuffer(b"".join(r.votes for r in sample), np.uint8).reshape(len(sample), len(LABELLERS)).astype(np.int64) - 1
    x = feature_matrix(((np.frombuffer(r.slots, ">u4").astype(np.int64), np.frombuffer(r["values"], ">f4")) for r in sample), len(sample), size)
    weights = fit_weights(x, labels.posterior(votes), counts=[r.n for r in sample])
    return QualityModel(labels, tuple(weights.tolist()))


def quality_score(text: Column, model: QualityModel | None) -> Column:
    """Score from 0 to 1 of a text column (NULL as empty)."""
    if model is None:
        return F.lit(None).cast("double")

    @F.pandas_udf("double")
    def run(texts):
        return texts.map(lambda t: model.score(t or b""), na_action=None)
    return run(text.cast("binary"))


def classify(docs: DataFrame, train_rows: int = 8000, size: int = 2048, threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, kept`` of every row."""
    model = fit(docs, train_rows, size)
    scored = docs.select(F.col("doc_id"), quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("kept", F.col("score") >= threshold)


def keep_good(docs: DataFrame, train_rows: int = 8000, size: int = 2048, threshold: float = 0.5) -> DataFrame:
    """The rows that reach the threshold, with all their columns."""
    model = fit(docs, train_rows, size)
    return docs if model is None else docs.filter(quality_score(F.col("text"), model) >= threshold)
