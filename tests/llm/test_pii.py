import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from cutpoint.llm import pii

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("_spans", T.StringType()), ("n_chars", T.IntegerType()))])

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(d):
    s = [int(c) for c in d][::-1]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(s)) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


def brute(text):
    text = text or ""
    out = []
    for kind, pattern, ok in (("email", EMAIL, lambda v: True), ("ip", IP, lambda v: all(int(p) <= 255 for p in v.split("."))),
                              ("card", CARD, lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
                              ("phone", PHONE, lambda v: 9 <= len(digits(v)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if ok(m.group())]
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "s", 5) for i, t in enumerate(texts)], SCHEMA)


CARD_OK = "4539 5787-6362 1486"
TEXTS = [None, "", "x", "a@b.c_x@d.e a@b.c.@d.e", "..@-.- %@a.b..c", "1.2.3.4.5.6.7.8 300.1.1.1 001.02.003.0255",
         "12345678901234567890123.1.1.1", f"pay {CARD_OK}, {CARD_OK}x{CARD_OK}", "4539578763621486 4539578763621486", "1 2 3--4 4539578763621486-",
         "+1 (017) 555-7713 +49 30 1234567890123456 +1 ((((", "🙂 a@b.co 漢 10.0.0.1 é +1 (017) 555-7713", "9" * 50_000, "1 " * 40_000, "a" * 100_000 + "@",
         "+1" + " " * 50_000, "bank DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 DE88 3704 0044 0532 0130 00", "ssn 123-45-6789" + " x" * 40 + " item 123-45-6789", "é" * 2000 + "a@b.c"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    bits = ["@", ".", "-", " ", "+", "(", ")", "a", "b1", "_", "%", "é", "🙂", "255", "256", "0", "1", "12", "4539578763621486", "+1 (017) 555-7713", "x.y@z.w", "\n"]
    return TEXTS + ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(600)]


def test_base_spans_equal_brute_force(spark, texts):
    rows = {r.doc_id: r for r in pii.digests(frame(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        want = brute(t)
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert rows[i].spans == shown or rows[i].spans.startswith(shown + ",") or not shown, (t, rows[i].spans, shown)
        assert rows[i].base_sha256 == hashlib.sha256(shown.encode()).hexdigest(), (t, rows[i].spans, shown)
        assert [rows[i][f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in want) for k in pii.BASE]
    assert pii.digests(frame(spark, [])).count() == 0


def test_added_kinds_checksums_and_context(spark):
    rows = {r.doc_id: r for r in pii.find(frame(spark, TEXTS)).collect()}
    iban = TEXTS.index(next(t for t in TEXTS if t and t.startswith("bank")))
    found = [(x.kind, TEXTS[iban][x.start:x.end]) for x in rows[iban].spans]
    assert [v for k, v in found if k == "iban"] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    ssn = TEXTS.index("ssn 123-45-6789" + " x" * 40 + " item 123-45-6789")
    assert [(x.kind, x.start) for x in rows[ssn].spans] == [("ssn", 4)]
    high, low = (pii.find(frame(spark, [f"{w} {CARD_OK}"])).first().spans[0].score for w in ("credit card", "order"))
    assert high > 0.8 > low


def test_redaction(spark, texts):
    got = pii.redact(frame(spark, texts))
    assert got.columns == ["doc_id", "text", "_spans", "n_chars"]
    rows = {r.doc_id: r for r in got.collect()}
    by = {r.doc_id: r.spans for r in pii.find(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        if not by[i]:
            assert rows[i].text == t and rows[i].n_chars == 5
            continue
        at, out = 0, ""
        for x in sorted(by[i], key=lambda x: x.start):
            if x.start >= at:
                out += t[at:x.start] + f"[{x.kind.upper()}]"
            at = max(at, x.end)
        assert rows[i].text == out + t[at:] and rows[i].n_chars == len(rows[i].text)


def test_no_python_in_the_plan(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    for df in (pii.digests(docs), pii.redact(docs)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
