"""Personal data spans: expressions propose, checksums confirm, context words adjust the score.

Each kind has an expression, a validator and context words.  Kinds whose form alone is proof
(``email``, ``ip``, ``card``, ``phone``: the base kinds) start at a score above the threshold, so
their validated matches always stay.  Weaker forms (``iban``, ``ssn``, ``secret``) need a checksum
or a nearby context word to pass.  Offsets are code points, end exclusive.  NULL and empty texts
have no spans.  Matches of one kind are leftmost and non-overlapping; a proposal that fails its
validator is dropped and not tried again.

Every expression is written so that a long run of its characters is scanned once (possessive
repeats, look-behind at the start of a run), with the same matches as the plain form.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servelens.llm.common import text_slices

BASE_KINDS = ("email", "ip", "card", "phone")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of ISO 13616: country and check digits moved to the end, letters as 10 to 35."""
    code = re.sub("[ -]", "", code)
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _ip_ok(s: str) -> bool:
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in s.split(".")))


def _card_ok(s: str) -> bool:
    d = _digits(s)
    return 13 <= len(d) <= 19 and luhn(d)


def _phone_ok(s: str) -> bool:
    return 9 <= len(_digits(s)) <= 15


def _iban_ok(s: str) -> bool:
    return 15 <= len(re.sub("[ -]", "", s)) <= 34 and mod97(s)


def _ssn_ok(s: str) -> bool:
    a, b, c = s.split("-")
    return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain found from each '@': the local part is the run of allowed
    characters before it, back to the last match or '@' at most."""
    done, at = 0, text.find("@")
    floor = 0
    while at >= 0:
        start = at
        while start > floor and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        floor = max(done, at + 1)
        at = text.find("@", floor)


@dataclass(frozen=True)
class Kind:
    """``score`` is the prior of a validated match; a context word within ``window`` characters
    adds ``boost``; spans at or above the detector's threshold are reported."""

    name: str
    find: Callable[[str], Iterator[tuple[int, int]]]
    valid: Callable[[str], bool] | None = None
    score: float = 0.6
    context: tuple[str, ...] = ()
    boost: float = 0.3
    window: int = 40
    near: re.Pattern | None = field(default=None)

    def spans(self, text: str) -> Iterator[tuple[str, int, int, float]]:
        for a, b in self.find(text):
            if self.valid and not self.valid(text[a:b]):
                continue
            score = self.score
            if self.context and re.search(rf"\b(?:{'|'.join(self.context)})\b", text[max(0, a - self.window):a].lower()):
                score = min(1.0, score + self.boost)
            yield self.name, a, b, score


def _by(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    found = re.compile(pattern).finditer
    return lambda text: (m.span() for m in found(text))


KINDS = (
    Kind("email", _emails, None, 0.9, ("mail", "email", "e-mail", "contact")),
    Kind("ip", _by(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"), _ip_ok, 0.6, ("ip", "host", "address", "server")),
    Kind("card", _by(r"[0-9](?:[\x20-]?+[0-9])++"), _card_ok, 0.7, ("card", "visa", "credit", "mastercard", "amex")),
    Kind("phone", _by(r"\+[0-9][\x20().0-9-]+[0-9]"), _phone_ok, 0.7, ("tel", "phone", "call", "fax", "mobile")),
    Kind("iban", _by(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
         _iban_ok, 0.6, ("iban", "account", "konto", "cuenta", "compte")),
    Kind("ssn", _by(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _ssn_ok, 0.3, ("ssn", "social", "security")),
    Kind("secret", _by(r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"), None, 0.6, ("key", "aws", "secret")),
)


def find_spans(text: str, kinds: tuple[Kind, ...] = KINDS, threshold: float = 0.5) -> list[tuple[str, int, int, float]]:
    """All spans of a text at or above the threshold, in the order of ``kinds`` and by start."""
    return [s for kind in kinds for s in kind.spans(text) if s[3] >= threshold]


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Spans replaced by their kind in brackets; overlapping spans are replaced together under the first."""
    out, done = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < done:
            done = max(done, b)
            continue
        out += [text[done:a], f"[{kind.upper()}]"]
        done = b
    return "".join([*out, text[done:]])


def spans_of(text: Column, threshold: float = 0.5) -> Column:
    """Column of spans (kind, start, end, score); an empty list for NULL."""
    @F.pandas_udf(SPAN)
    def run(texts):
        return texts.map(lambda t: [dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(t or "", threshold=threshold)])
    return run(text)


def redacted(text: Column, threshold: float = 0.5) -> Column:
    """The text with its spans replaced; NULL stays NULL."""
    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: None if t is None else redact(t, find_spans(t, threshold=threshold)))
    return run(text)


def pii_digest(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per document the counts of the base kinds and the digests of base and of all spans."""
    def run(batches):
        import pyarrow as pa

        fields = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string())]
        schema = pa.schema(fields)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, _, texts in text_slices(batch, "text", 8 << 20):
                rows = []
                for i, t in enumerate(texts):
                    spans = find_spans(t, threshold=threshold)
                    said = [f"{k}:{x}:{y}" for k, x, y, _ in spans]
                    kinds = [s[0] for s in spans]
                    base = ",".join(s for s, k in zip(said, kinds) if k in BASE_KINDS)
                    rows.append((ids[a + i], *(kinds.count(k) for k in BASE_KINDS), hashlib.sha256(base.encode()).hexdigest(), ",".join(said)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
