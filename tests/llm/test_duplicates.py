"""Block naming, SimHash components, repeated passages."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from cases import BLANK, edge_rows, reach, repeats, simhash, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftwell.llm import naming, repeats as passages, simhash as sim


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def named(rows):
    """(doc_id, keep_id, size, sha) per row and how many rows stay per group."""
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(re.sub(BLANK, "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for body, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), hashlib.sha256(body.encode()).hexdigest()) for m in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("block", [4096, 7])
@pytest.mark.parametrize("hashed", [naming.block_hash, lambda b: F.pmod(F.xxhash64(b), F.lit(3)).cast("bigint")])
def test_exact_duplicates(spark, block, hashed):
    """Long documents over many levels, and block hashes that collide."""
    rows = edge_rows()
    if block == 7:
        rows = [(i, t and t[:300], s) for i, t, s in rows]
    got = naming.exact_duplicates(table(spark, rows), block, hashed).collect()
    want, groups = named(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_duplicates_of_nothing(spark):
    assert naming.exact_duplicates(table(spark, [])).count() == 0


def test_components(spark):
    rows = edge_rows()
    got = rows_of(sim.near_duplicates(table(spark, rows)).select("doc_id", "fingerprint", "component_id"))
    prints = [simhash(t) for _, t, _ in rows]
    label = reach(prints, 4)
    least = {g: min((i for (i, _, _), x in zip(rows, label, strict=True) if x == g and i is not None), default=None) for g in set(label)}
    want = sorted(((i, f"{p:016x}", least[g]) for (i, _, _), p, g in zip(rows, prints, label, strict=True)), key=str)
    assert got == want


def test_components_of_nothing(spark):
    assert sim.near_duplicates(table(spark, [])).count() == 0


def test_links_over_chunks_and_chains(spark):
    """Chains of close fingerprints, more at one meeting place than a chunk holds."""
    rng = random.Random(3)
    values = {0}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(30):
            values.add(x)
            for b in rng.sample(range(64), rng.choice([1, 3, 4, 5, 6])):
                x ^= 1 << b
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "bits bigint")
    label = reach(values, 4)
    for chunk in (3, 4096):
        pairs = sim.links(df, chunk=chunk)
        roots = {r.node: r.root for r in sim.components(pairs).collect()}
        signed = [v - (1 << 64) if v >> 63 else v for v in values]
        group = [roots.get(v, v) for v in signed]
        assert len(set(zip(group, label, strict=True))) == len(set(group)) == len(set(label))


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.integers(0, 40))
@settings(max_examples=60, deadline=None)
def test_tiles_lose_no_pair(left, right, radius):
    a, b = np.array(left, np.uint64), np.array(right, np.uint64)
    found = {(int(x), int(y)) for p, q in sim.close_pairs(a, b, radius, tile=4) for x, y in zip(p, q, strict=True)}
    assert found == {(x, y) for x in left for y in right if (x ^ y).bit_count() <= radius}


def test_repeats(spark):
    rows = edge_rows()
    assert rows_of(passages.remove_repeats(table(spark, rows))) == repeats(rows)
    assert passages.remove_repeats(table(spark, [])).count() == 0


def test_repeats_of_edited_copies(spark, monkeypatch):
    """Copies with edits, shifts and low entropy, in batches of a few rows."""
    monkeypatch.setattr(passages, "LOCAL_PHRASES", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rng = random.Random(9)
        base = "".join(rng.choice("abcdefgh ") for _ in range(900))
        rows = [(0, base, "s"), (1, "ab" * 300, "s"), (2, "a" * 350 + base[:140], "s")]
        for i in range(3, 40):
            text = base if i % 3 else base[rng.randrange(300) :] + base[: rng.randrange(200)]
            for _ in range(rng.randrange(6)):
                p = rng.randrange(len(text))
                text = text[:p] + rng.choice(["", "x", "yz"]) + text[p + 1 :]
            rows.append((i, text, "s"))
        assert rows_of(passages.remove_repeats(table(spark, rows).repartition(3))) == repeats(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repeats_under_one_id(spark):
    """Many texts under null and repeated ids, which are not earlier than each other."""
    rng = random.Random(12)
    parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([99, 100, 130, 260]))) for _ in range(8)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(parts)[rng.randrange(20) :] + rng.choice(["", "z", "qq"]) for _ in range(rng.randrange(1, 4)))
        rows.append((rng.choice([None, 4, i]), text, "s"))
    rows += rows[:15]
    assert rows_of(passages_of(spark, rows)) == repeats(rows)


def passages_of(spark, rows):
    return passages.remove_repeats(table(spark, rows).repartition(5))


def test_null_ids_take_no_longer(spark):
    """Time does not grow with the square of the rows that share an id."""
    texts = [" ".join(random.Random(i // 3).choices("abcdefghijklmnop", k=300)) for i in range(3000)]
    took = []
    for ids in (range(3000), [None] * 3000):
        start = time.perf_counter()
        assert passages.remove_repeats(table(spark, [(i, t, "s") for i, t in zip(ids, texts, strict=True)])).agg(F.count("*")).first()[0] == 3000
        took.append(time.perf_counter() - start)
    assert took[1] < 3 * took[0] + 3


def edited_copies():
    """Texts, copies of them with 0 to 8 words changed, chains of such copies, shared passages."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    passage, texts = rng.choices(vocabulary, k=30), [None, "", " ", "one two", "One two", "one two three four five"]
    for k in range(24):
        words = rng.choices(vocabulary, k=rng.choice([20, 80, 150])) + passage * (k % 2)
        texts.append(" ".join(words))
        for edits in (0, 1, 2, 3, 4, 6, 8):
            copy = list(words)
            for p in rng.sample(range(len(copy)), edits):
                copy[p] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
            words = copy if k % 3 == 0 else words
    return texts


def test_pipeline_near_dedup_is_operator_9(spark):
    """Of each component of fingerprints within four bits the smallest id stays, whatever the columns are called."""
    import corpus_pipeline

    texts = edited_copies() + ["word " * 3000, "word " * 3001]
    label = reach([simhash(t) for t in texts], 4)
    rows = [(k, t, "en", "s", 0, 10 * k, "k", "c", 7) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, uid bigint, _key string, _copy string, copies int").repartition(3)
    got = corpus_pipeline.distinct_contents(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(got.collect()) == sorted(r for r in docs.collect() if r.doc_id == min(k for k, x in enumerate(label) if x == label[r.doc_id]))


def test_pipeline_keeps_clashing_columns(spark):
    import corpus_pipeline

    rows = [(k, f"text of {k} words", "en", "ab"[k % 2], 0, 10 * k, f"key{k}", f"copy{k}", 7, "x") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, uid bigint, _key string, copy string, copies int, _UID string")
    for stage in (corpus_pipeline.distinct_texts, corpus_pipeline.distinct_contents, corpus_pipeline.mixture):
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        assert {tuple(r) for r in got.collect()} <= set(rows)
    assert len({r.doc_id for r in corpus_pipeline.distinct_texts(spark, docs, "").collect()}) == 20


def test_pipeline_copies_by_row(spark):
    """Rows that share an id are repeated each by its own."""
    import corpus_pipeline

    rows = [(5, "a " * 9, "en", "s", 0), (5, "b " * 4, "en", "s", 0), (None, "c " * 7, "en", "t", 0), (None, "d", "en", "t", 0), (6, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [tuple(r) for r in corpus_pipeline.mixture(spark, docs, "").collect()]
    assert set(got) <= set(rows) - {rows[4]} and max(got.count(r) for r in rows) <= 3
    assert sum(len(r[1].split()) for r in got) >= 15


def test_pipeline_keeps_rows_that_share_an_id(spark):
    """Different texts under one id or under null ids all stay, and the row decided for is the row kept."""
    import corpus_pipeline

    rng = random.Random(4)
    a, b, *more = [" ".join(rng.choices("abcdefghijklmnop", k=n)) for n in (60, 40, 50, 50, 50, 50)]
    rows = [(3, a), (5, a), (5, b), (None, more[0]), (None, more[1]), (None, more[1]), (7, more[2]), (7, more[3]), (8, more[3] + " ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {(3, a), (5, b), (None, more[0]), (None, more[1]), (7, more[2])}
    got = corpus_pipeline.distinct_texts(spark, docs, "").collect()
    assert len(got) == 6 and {tuple(r) for r in got} == want | {(8, more[3] + " ")}
    got = corpus_pipeline.distinct_contents(spark, docs, "").collect()
    assert len(got) == 6 and {tuple(r) for r in got} == want | {(7, more[3])}
