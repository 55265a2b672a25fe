"""Fingerprints, quality, toxicity, personal data, the pipeline."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from cases import edge_rows, spans, table
from hypothesis import given, settings
from hypothesis import strategies as st

from driftwell.llm.personal import CUES, SCHEMES, Finder, find_personal, joined
from driftwell.llm.plans import PLANS
from driftwell.llm.prefixes import PrefixHash, fingerprint_documents, likeness
from driftwell.llm.quality import sample, score_quality, scores, train
from driftwell.llm.toxicity import score_toxicity

SF = "/root/testdata/sf0.001"
texts = st.text(alphabet="ab cé\U0001f600", max_size=60)


@given(texts, texts, st.data())
@settings(max_examples=80, deadline=None)
def test_prefix_hashes(a, b, data):
    x, y = PrefixHash.of(a), PrefixHash.of(b)
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    assert x.extension(i, y, j) == n
    m = 0
    while m < min(i, j) and a[i - m - 1] == b[j - m - 1]:
        m += 1
    assert x.back_extension(i, y, j) == m
    z, w = x.spliced(i, y, j), PrefixHash.of(a[:i] + b[:j])
    assert z.fingerprint(z.sketch()) == w.fingerprint(w.sketch())


def test_likeness_follows_shared_spans():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghij ") for _ in range(6000))
    other = "".join(rng.choice("abcdefghij ") for _ in range(6000))
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        k = int(6000 * share)
        got = likeness(PrefixHash.of(text).sketch(), PrefixHash.of(text[:k] + other[k:]).sketch())
        assert abs(got - share) < 0.2
    assert likeness(PrefixHash.of("").sketch(), PrefixHash.of("").sketch()) == 1.0


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_fingerprints(spark, partitions):
    rows = [r for r in edge_rows() if r[0] is not None] + [(None, "last of all", "s")]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fingerprint_documents(table(spark, rows).repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = []
    for k, (i, t, _) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        want.append((i, len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    by_text = {}
    for r, t in ((r, t) for r in got for i, t, _ in rows if i == r.doc_id):
        by_text.setdefault(t or "", set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(f) == 1 for f in by_text.values())
    assert len({f for s in by_text.values() for f in s}) == len(by_text)
    assert fingerprint_documents(table(spark, [])).count() == 0
    assert fingerprint_documents(table(spark, [(5, "alone", "s")])).first().edited_sha256 == hashlib.sha256(b"alo" + b"al").hexdigest()


def labelled(spark, n=300):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        bad, toxic = rng.random() < 0.3, rng.random() < 0.2
        if bad:
            body = [w + "###" for w in body] if i % 2 else [w for w in body[:20] for _ in range(5)]
        if toxic:
            for _ in range(3):
                body.insert(rng.randrange(len(body)), rng.choice(["grumf", "grumpel", "idiot"]) + rng.choice(words)[:2])
        rows.append((i, " ".join(body), "s"))
        labels.append((i, int(not bad), int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def accuracy(got, labels, name):
    y = {r.doc_id: r[name] for r in labels.collect()}
    held = [r for r in got if r.held_out and r.doc_id in y]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    return np.mean([r.predicted == y[r.doc_id] for r in held])


@pytest.mark.parametrize(("score", "name", "threshold"), [(score_quality, "quality", 0.3), (score_toxicity, "toxic", 0.5)])
def test_classifiers(spark, score, name, threshold):
    rows, labels = labelled(spark)
    extra = [(i and i + 100_000, t, s) for i, t, s in edge_rows()]
    docs = table(spark, rows + extra)
    got = score(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    assert accuracy(got, labels, name) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    assert {(1 << 60) + 1 + 100_000, None} <= {r.doc_id for r in got}
    again = score(docs.repartition(7), labels).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert score(table(spark, []), labels).count() == 0
    assert score(docs, labels.limit(0)).count() == len(got)


def test_whole_texts_are_scored(spark):
    rows, labels = labelled(spark)
    table_, constant = train(table(spark, rows), labels)
    good = " ".join(t for i, t, _ in rows if "#" not in t)
    assert scores([good], table_, constant)[0] > scores([good + " w###" * len(good)], table_, constant)[0]


@given(st.text(alphabet="a.@+-%0149 ()é", max_size=40))
@settings(max_examples=400, deadline=None)
def test_base_spans(text):
    assert joined(Finder(text).spans()[0]) == joined(spans(text))


def test_personal(spark):
    text = (
        "mail joe.x+y@mail.example.com or +1 (555) 010-9999, card 4111 1111 1111 1111, host 10.0.0.255 not 10.0.0.256. "
        'token = "0123456789abcdef0123456789abcdef" IBAN: DE89370400440532013000 SSN: 078-05-1120, http://joe:pw@example.com/x, '
        "account number: 12345678 and the token of the day"
    )
    rows = edge_rows() + [(500, text, "s"), (501, "😀 " + text, "s")]
    got = {r.doc_id: r for r in find_personal(table(spark, rows)).collect()}
    kinds = [s.split(":")[0] for s in got[500].spans.split(",")]
    assert sorted(kinds) == sorted(["email", "email", "phone", "card", "ip", "secret", "iban", "ssn", "url", "account"])
    assert got[501].spans == ",".join(f"{k}:{int(a) + 2}:{int(b) + 2}" for k, a, b in (s.split(":") for s in got[500].spans.split(",")))
    for i, t, _ in rows:
        assert got[i].base_sha256 == hashlib.sha256(joined(spans(t or "")).encode()).hexdigest() or i is None
    assert got[3].spans == "" and find_personal(table(spark, [])).count() == 0


@pytest.mark.parametrize(("text", "span"), [
    ("Social Security Number: 078-05-1120", "ssn"), ("API Key: 0123456789abcdef01", "secret"), ("Api_Key = 0123456789abcdef01", "secret"),
    ("apiKey=0123456789abcdef01", "secret"), ("PassPort no.: X1234567", "account"), ("HTTP://joe:pw@example.com/x", "url"), ("Ñ iBaN: DE89370400440532013000", "iban"),
])
def test_cues_in_any_case(text, span):
    found = Finder(text).spans()[1]
    assert span in {k for _, _, k in found}
    start, end = next((a, b) for a, b, k in found if k == span)
    assert 0 <= start < end <= len(text)


@pytest.mark.parametrize("unit", [*CUES, *[c + "=" for c in CUES], *[c + ": a1" for c in CUES], *SCHEMES, "http://a@", "mailto:a@", "mailto:", "ftp://x).,;", "a@", "a.b@c.", "+1 ", "+1((", "1.", "1 ", "1-", "x_", "1", "é"])
def test_time_grows_with_the_text(unit):
    """A megabyte of anything that starts a search, without white space where it matters."""
    text = unit * (1_000_000 // len(unit))
    start = time.perf_counter()
    Finder(text).spans()
    assert time.perf_counter() - start < 20


def test_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(i % 40 if i < 100 else 7, f"text {i}") for i in range(600)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    rows = sample(docs, marks, "quality", 10).collect()
    assert len(rows) == 10 == len({r.doc_id for r in rows})
    assert sorted(rows) == sorted(sample(docs.repartition(7), marks, "quality", 10).collect())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    kept, frame = [ids], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, SF).collect(), docs.schema)
        assert frame.columns == docs.columns, name
        kept.append({r.doc_id for r in frame.collect()})
        assert kept[-1] <= kept[-2]
    rejected = {r.doc_id for r in PLANS["op5_subword_quality"][0](spark, SF).collect() if r.predicted == 0}
    assert kept[1] == ids - rejected
    final = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in final.collect()} == kept[-1]
    # stages take null ids, nulls and repeated rows
    odd = docs.sparkSession.createDataFrame([(i, t, "en", s, 0) for i, t, s in edge_rows()], docs.schema)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, odd, SF).count() > 0
        assert stage(spark, odd.limit(0), SF).count() == 0
    once = corpus_pipeline.distinct_texts(spark, odd, SF).collect()
    assert len({r.text for r in once}) == len(once)
