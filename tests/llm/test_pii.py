import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

import helpers
from servelens.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn_plain(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and luhn_plain(d)):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=800, deadline=None)
@given(st.text(st.sampled_from(list("0123459.+-@ ()aé🙂%_")), max_size=60) | st.from_regex(PLAIN["email"]) | st.from_regex(PLAIN["card"]) | st.from_regex(PLAIN["ip"]))
def test_base_spans_equal_the_plain_expressions(text):
    assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == brute(text)


def test_validators_and_context():
    assert pii.find_spans("IBAN GB82 WEST 1234 5698 7654 32 ok")[-1][:3] == ("iban", 5, 32)
    assert not [s for s in pii.find_spans("GB83 WEST 1234 5698 7654 32") if s[0] == "iban"]
    assert not pii.find_spans("order 123-45-6789")
    assert [s[0] for s in pii.find_spans("my SSN is 123-45-6789")] == ["ssn"]
    assert pii.redact("a b@c.de, +1 (988) 555-2485.", pii.find_spans("a b@c.de, +1 (988) 555-2485.")) == "a [EMAIL], [PHONE]."
    assert pii.find_spans("1" * 200_000 + "." * 10 + "+" * 50_000 + "a" * 100_000 + "@") == []


def test_digest(spark):
    for df in (helpers.fixture_docs(spark), helpers.edge(spark).withColumn("spans", helpers.F.lit(1))):
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.pii_digest(df).collect())
        expect = []
        for r in df.collect():
            spans = brute(r.text or "")
            n = [sum(s[0] == k for s in spans) for k in PLAIN]
            said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            expect.append((r.doc_id if r.doc_id is not None else -1, *n, hashlib.sha256(said.encode()).hexdigest()))
        assert got == sorted(expect)
    assert pii.pii_digest(helpers.empty(spark)).count() == 0


def test_columns(spark):
    df = helpers.frame(spark, [None, "", "x a@b.cd y"])
    assert [r[0] for r in df.select(pii.redacted(helpers.F.col("text"))).collect()] == [None, "", "x [EMAIL] y"]
    assert [len(r[0]) for r in df.select(pii.spans_of(helpers.F.col("text"))).collect()] == [0, 0, 1]
