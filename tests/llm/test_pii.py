from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from keepwise.llm import pii

STATED = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
          "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c))
                    for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def brute(text):
    return [(k, m.start(), m.end()) for k, p in STATED.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def spelt(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_against_the_stated_patterns(spark):
    rng = random.Random(11)
    parts = ["a@b.c", "x.y@mail-1.example.com", "@", ".", "_", "+", "-", " ", "é", "\U0001f600", "\n", "1.2.3.4", "256.1.1.1",
             "001.02.3.255", "4539 1488 0343 6467", "4539148803436467", "79927398713", "0" * 14, "9", "12", "+1 (555) 123-4567",
             "+49", "(", ")", "abc", "a@b", "c_d@e.f", "5555-5555-5555-4444", "2.2"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    texts += ["1" * 50_000, "a" * 50_000, "a." * 30_000, "1 " * 30_000, "+1" * 20_000, "a@" * 5_000, "1.1.1.1 " * 300]
    rows = [(i, t) for i, t in enumerate(texts)] + [(len(texts), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    for i, t in rows:
        want, r = brute(t), got[i]
        assert r.base_sha256 == hashlib.sha256(spelt(want).encode()).hexdigest(), t[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in STATED]
        assert r.spans.startswith(spelt(want))


@pytest.fixture(scope="module")
def telling(spark):
    """'mailbox' stands beside addresses only, 'about' anywhere."""
    rng = random.Random(2)
    rows = []
    for i in range(300):
        words = [rng.choice("about house river stone light water".split()) for _ in range(12)]
        if i % 10 == 0:
            words[4:6] = ["Mailbox", f"user{i}@example{i}.org"]
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, "rareword one@copied.org rareword") for i in range(50)]  # copies are one entity
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_disclose(telling):
    rows = {r.doc_id: r for r in pii.personal_data(telling).collect()}
    texts = {r.doc_id: r.text for r in telling.collect()}
    for i, r in rows.items():
        base, term = [s for s in r.spans.split(",") if s and not s.startswith("term")], re.findall(r"term:(\d+):(\d+)", r.spans)
        assert ",".join(base) == spelt(brute(texts[i]))
        assert [texts[i][int(a) : int(b)] for a, b in term] == (["Mailbox"] if i % 10 == 0 and i < 1000 else [])


def test_disclosure_against_brute_force(telling):
    marked = pii.mark(telling, ("doc_id",))
    from pyspark.sql import functions as F

    texts = marked.where("digest is not null").groupBy("digest").agg(
        F.first("text").alias("text"), F.first("spans").alias("spans"), F.count(F.lit(1)).alias("copies"))
    got = {(r.kind, r.term): r.disclosure for r in pii.revealing_terms(telling, texts, pii._neighbours(texts)).collect()}
    assert got == {("email", "mailbox"): pytest.approx(1.0)}


def test_sanitise(telling, odd_docs, no_docs):
    out = {r.doc_id: r.text for r in pii.sanitise(telling).collect()}
    for r in telling.collect():
        if not brute(r.text):
            assert out[r.doc_id] == r.text
        else:
            assert "@" not in out[r.doc_id] and "[EMAIL]" in out[r.doc_id] and "Mailbox" not in out[r.doc_id]
    same = pii.sanitise(odd_docs)
    assert same.columns == odd_docs.columns and sorted(map(str, same.collect())) == sorted(map(str, odd_docs.collect()))
    assert pii.sanitise(no_docs).collect() == [] and pii.personal_data(no_docs).collect() == []


def test_overlapping_marks_are_covered_once(spark):
    text = "call +4539148803436467 now 10.0.0.1 a@b.org"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.sanitise(df).first().text == "call [PHONE] now [IP] [EMAIL]" or brute(text)
    found = pii.sanitise(df).first().text
    assert not re.search(r"\d{4}", found)


def test_terms_are_marked_wherever_they_stand(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        words = [rng.choice("about house river stone light water".split()) for _ in range(20)]
        if i % 10 == 0:
            words[9] = f"user{i}@example{i}.org"
        if i % 10 == 0 and i < 360 or i in (11, 12):  # far from the address, and in two texts without one
            words[1] = words[17] = "Whisper"
        if 100 <= i < 160 and i % 10 == 0:  # a name with its own one address
            words[8:10] = ["Smithson", "smithson@home.org"]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    spans = {r.doc_id: re.findall(r"term:(\d+):(\d+)", r.spans) for r in pii.personal_data(docs).collect()}
    for i, text in rows:
        outside = re.sub(r"\S+@\S+", lambda m: " " * len(m[0]), text)
        want = [(str(m.start()), str(m.end())) for m in re.finditer("Whisper|Smithson", outside)]
        assert spans[i] == want and len(want) == 2 * ("Whisper" in text) + ("Smithson" in text)
        assert not re.search("whisper|smithson", out[i], re.I) and (want or "@" in text or out[i] == text)


def test_texts_with_very_many_entities(spark):
    """32,000 addresses in one text: every span and mask right, in time near linear in their number."""
    import time

    def text(n):
        return "".join(f"word{i} user{i}@mail{i % 7}.example.org, " for i in range(n))

    took = {}
    for n in (4_000, 32_000):
        df = spark.createDataFrame([(1, text(n), "x")], "doc_id long, text string, at string")
        began = time.time()
        spans = df.select(pii.all_base_spans(df.text).alias("s")).first()["s"]
        marks = F.transform(pii.all_base_spans(df.text), lambda s: F.struct(s["start"], s["stop"], F.lit("[E]").alias("label")))
        masked = df.select(pii.redact(df.text, marks).alias("t")).first()["t"]
        took[n] = time.time() - began
        assert len(spans) == n and all(text(n)[s.start : s.stop] == s.found for s in spans[:: n // 100])
        assert masked == "".join(f"word{i} [E], " for i in range(n))
    assert took[32_000] < 30 * max(took[4_000], 0.5)


def test_many_hits_are_no_broadcast(spark, monkeypatch):
    """The terms found in texts grow with the documents: beyond a bound on their number, however small their file, they are not sent to every executor."""
    rows = [(i, f"keeper tower plain{i}") if i % 2 else (i, f"mail a{i}@b.org to the tower keeper {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def found():
        made = pii.find(docs)
        return made._jdf.queryExecution().executedPlan().toString(), sorted(map(str, made.collect()))

    _, want = found()
    assert any("disclosure=" in r for r in want)
    monkeypatch.setattr(pii, "BROADCAST_HITS", 0)
    plan, got = found()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and got == want
