import hashlib
import re

import pytest

from tallyboard.llm import pii

#: The base patterns of the contract.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind, m[0]))
    return sorted(out)


TEXTS = [
    None, "", "plain text", "a@b.c a@b..c a.b@c-d.e.f. x@y@z.com p@q", "me.x%+-@host.example.org_d@e.f", "é𝒳 héé@ñ.com 😀 bob@site.de 😀",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.0003.255 999.1.2.3.4 1..2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111",
    "5500000000000004 0000000000000000000 00000000000000000000 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "+1 (383) 555-6083 +4930123456 +1 2 +123456789 tel +49 (0)30.123-4567-.",
    "++12345678901 +1--------9 +12345678901234567", "4111\x011111 1111\x01 1111 4111111111111111\x01", "1" * 60_000, "1 " * 40_000, "1.2.3.4." * 8000,
    "a@b" + ".c" * 30_000, "x" * 150_000 + "@y.de", "+" + "1(" * 30_000, "4" * 15 + "-" + "2", "a@b.c\n1.1.1.1\n",
]


@pytest.fixture(scope="module")
def model(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_base_spans(spark, model):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)] + [(None, "a@b.c", "y")], "doc_id long, text string, pii_spans string")
    for r in pii.with_spans(docs, model).collect():
        text = TEXTS[r.doc_id] if r.doc_id is not None else "a@b.c"
        found = [(s.start, s.kind, s.end, pii.KINDS[s.kind], s.value) for s in r.pii_spans if s.base]
        assert found == base_spans(text)
        assert [(s.start, s.kind) for s in r.pii_spans] == sorted((s.start, s.kind) for s in r.pii_spans)
        assert all(s.value == text[s.start : s.end] for s in r.pii_spans)


def test_looser_spans_are_added_only_if_sure(spark, model):
    texts = ["call (212) 555-0147 now", "contact: jane.doe", "mail: jane (at) example (dot) com please", "version 212-555-0147x", "order 123 456", "phone +1 (212) 555-0147"]
    rows = pii.with_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).orderBy("doc_id").collect()
    got = [[(pii.KINDS[s.kind], s.value, s.base) for s in r.pii_spans] for r in rows]
    assert got[0] == [("phone", "(212) 555-0147", False)] and got[2] == [("email", "jane (at) example (dot) com", False)]
    assert got[1] == got[3] == got[4] == [] and got[5] == [("phone", "+1 (212) 555-0147", True)]


def test_reliabilities_are_recovered():
    import random
    rng, counts = random.Random(2), {}
    right = (0.95, 0.8, 0.7, 0.6)
    for _ in range(20_000):
        truth = rng.random() < 0.3
        v = tuple((1 if (rng.random() < p) == truth else -1) if rng.random() < 0.9 else 0 for p in right)
        counts[0, v, False] = counts.get((0, v, False), 0) + 1
    m = pii.estimate(counts)
    assert abs(m.share - 0.3) < 0.05
    for name, p in zip(pii.LABELERS, right, strict=True):
        assert abs(m.reliability[name, 1, 1] - 0.9 * p) < 0.06 and abs(m.reliability[name, 0, -1] - 0.9 * p) < 0.06
    assert m.weights["format1"] > m.weights["edge1"] > 0 > m.weights["format-1"]
    assert pii.estimate({}).weights == {}


def test_mask(spark):
    docs = spark.createDataFrame([(1, "x a@b.cd y 1.2.3.4", 7), (2, None, 8), (3, "é", 9)], "doc_id long, text string, other int")
    out = pii.mask(docs)
    assert out.columns == docs.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["x [email] y [ip]", None, "é"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.with_spans(docs, pii.learn(docs)).collect() == [] and pii.mask(docs).collect() == []


def test_query_is_native_and_right(spark):
    from tallyboard.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    texts = dict(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    df = QUERIES["op4_pii"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r.doc_id])
        joined = ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in spans) for k in range(4))
        assert set(joined.split(",")) <= set(r.spans.split(","))
    added = [s for r in rows for s in r.spans.split(",") if s]
    assert len(added) >= sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)
