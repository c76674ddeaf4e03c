import hashlib
import random
import re
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

import rowloom.llm.pii as P
from conftest import DATA
from rowloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, candidates string, c string"
RAW = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def base(text):
    found = []
    for rank, (kind, pattern) in enumerate(RAW.items()):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return sorted(found)


def texts():
    rng = random.Random(2)
    parts = ["a.b", "@", "x-1.com", ".", "+", "4111 1111 1111 1111", "4111111111111112", " ", "é", "(", ")", "-", "1", "49", "10.0.0.1"]
    parts += ["256.1.1.1", "_", "%", "+1 (555) 010-9999", "007.08.09.10", "5500-0000-0000-0004", "\n", "000"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(150)]
    return [None, "", "a" * 200_000 + "@x.com", "1 " * 50_000, "9" * 100_000, "1." * 30_000, "+1" + "(" * 20_000, "a@b.c_d@e.f,g@h.ii", *made, made[9]]


def test_base_against_brute_force(spark):
    docs = list(enumerate(texts())) + [(None, "me@here.org"), (3, "again")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS).repartition(8)
    got = [(r.doc_id, [tuple(s) for s in r.spans if s.kind in P.BASE]) for r in P.find_pii(df).collect()]
    assert sorted(got, key=repr) == sorted(((i, base(t)) for i, t in docs), key=repr)
    assert P.find_pii(df.limit(0)).collect() == []
    assert [r.spans for r in P.find_pii(df.where("text = 'again'")).collect()] == [[]]


def test_added_spans(spark):
    rows = [(i, f"please call (212) 664-{1000 + i} or write to jo{i}@mail.org now") for i in range(30)]
    rows += [(100 + i, f"order 111-222-000{i % 9} ref x000-00-0000y") for i in range(30)]
    rows += [(200, "my ssn 219-40-1234."), (201, "mail joe (at) mail (dot) org"), (202, "nothing"), (203, "call +1 (212) 664-1234 now")]
    got = {r.doc_id: [s.kind for s in r.spans] for r in P.find_pii(spark.createDataFrame([(*r, "", "") for r in rows], DOCS)).collect()}
    assert all(got[i] == ["tel", "email"] for i in range(30))
    assert got[200] == ["id"] and got[201] == ["spelled"] and got[202] == []
    assert got[203] == ["phone"]
    assert all(got[100 + i] == [] for i in range(30))


def test_reliabilities():
    """Votes drawn from known reliabilities: the estimates come close."""
    rng = random.Random(4)
    hit = (0.9, 0.85, 0.8, 0.7, 0.6)
    patterns = Counter()
    for _ in range(20_000):
        y = 1 if rng.random() < 0.4 else -1
        patterns[tuple(0 if rng.random() < 0.3 else y if rng.random() < h else -y for h in hit)] += 1
    model = P.reliabilities(patterns)
    assert model.share == pytest.approx(0.4, abs=0.05)
    for j, h in enumerate(hit):
        assert model.votes[j][1, True] == pytest.approx(0.7 * h, abs=0.05)
    assert model.posterior((1, 1, 1, 1, 1)) > 0.99 > 0.01 > model.posterior((-1, -1, -1, -1, -1))


def test_whole_table(spark):
    want = {}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        found = base(r.text)
        counts = Counter(k for *_, k in found)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in found).encode()).hexdigest()
        want[r.doc_id] = (*[counts[k] for k in P.BASE], digest)
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in QUERIES["op8_pii"](spark, DATA).collect()}
    assert got == want


def test_email_of_many_labels(spark):
    """The shape vote takes a domain of any number of labels, without recursion."""
    texts = ["x@" + "b." * 100_000 + "com", "x@" + "b." * 100_000 + "c0m", "x@b.com", "%x@b.com", "x@b.c"]
    rows = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: r.c for r in rows.select("doc_id", P.candidates(F.col("text")).alias("c")).collect()}
    assert all([(s.start, s.end, s.kind) for s in found[i]] == [(0, len(t), "email")] for i, t in enumerate(texts))
    assert [found[i][0].votes[0] for i in range(5)] == [1, 0, 1, -1, 0]
    assert [len(r.spans) for r in P.find_pii(rows).collect()] == [1] * 5
