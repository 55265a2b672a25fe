"""Mixture, packing, shards."""

import itertools
import re
import zlib

import numpy as np
import pytest
from cases import BLANK, edge_rows, table

from driftwell.llm.mixing import mix
from driftwell.llm.packing import best_boundaries, pack
from driftwell.llm.sharding import propagate, shard


def words(text):
    return len([w for w in re.split(BLANK + "+", text or "") if w])


def shares(sizes):
    """Targets by rounds over (source, size) in order."""
    weight = {s: k % 3 + 1 for k, s in enumerate(sizes)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(w for s, w in weight.items() if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / open_weight for s in sizes}
        more = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not more:
            return target
        full |= more


def test_mix(spark):
    rows = edge_rows() + [(100 + i, "w " * (1 + i % 9), f"s{i % 5}") for i in range(300)]
    got = mix(table(spark, rows), per_cell=10).collect()
    sizes = {}
    for s in sorted({s for _, _, s in rows if s is not None}) + [None]:
        sizes[s] = sum(words(t) for _, t, x in rows if x == s)
    target = shares(sizes)
    by_source = {}
    source_of = {(i, words(t)): s for i, t, s in rows}
    for r in got:
        s = source_of[r.doc_id, r["size"]]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        by_source.setdefault(s, []).append(r)
    assert len(got) == len(rows)
    for s, rs in by_source.items():
        largest = max(r["size"] for r in rs)
        # repeated rows share a draw, so half of two documents is the bound
        assert abs(sum(r.taken for r in rs) - target[s]) <= largest, s
    again = mix(table(spark, rows).repartition(5), per_cell=1000).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_mix_by_preference(spark):
    # equal sources: how often a level is taken follows its expected number (the filling of the gap favours short ones by a few in 500)
    lengths = [1, 3, 9, 30, 120]
    rows = [(1000 * s + i, "w " * lengths[i % 5], f"s{s:02d}") for s in range(24) for i in range(500)]
    got = mix(table(spark, rows), per_cell=50).collect()
    size = 100 * sum(lengths)
    by_weight, seen = {}, {}
    for r in got:
        weight = r.doc_id // 1000 % 3 + 1
        by_weight[weight] = r.target
        seen.setdefault((weight, r["size"]), []).append(r.taken / r["size"])
    for weight, target in by_weight.items():
        factor = target / (100 * sum(n * n.bit_length() for n in lengths))
        closed = set()
        while any(n not in closed and factor * n.bit_length() > 3 for n in lengths):
            closed |= {n for n in lengths if factor * n.bit_length() > 3}
            factor = (target - 3 * 100 * sum(closed)) / (100 * sum(n * n.bit_length() for n in lengths if n not in closed))
        for n in lengths:
            want = 3 if n in closed else factor * n.bit_length()
            copies = seen[weight, n]
            assert set(copies) <= {int(want), int(want) + 1} and abs(np.mean(copies) - want) < 0.06, (weight, n, want)
    for s in range(24):
        mine = [r for r in got if r.doc_id // 1000 == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= lengths[-1] / 2, s
    assert all(r.source_size == size for r in got)


def test_mix_of_nothing(spark):
    assert mix(table(spark, [])).count() == 0
    assert [r.taken for r in mix(table(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def test_boundaries_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lengths = np.sort(rng.choice(np.arange(1, 40), 8, replace=False))
        counts, k = rng.integers(1, 20, 8), int(rng.integers(1, 5))

        def padding(ends, lengths=lengths, counts=counts):
            return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts, strict=True))

        best = min(padding((*c, lengths[-1])) for c in itertools.combinations(lengths[:-1], k - 1))
        ends = best_boundaries(lengths, counts, k)
        assert len(ends) <= k and padding(ends) == best


def test_pack(spark):
    rows = edge_rows()
    got = pack(table(spark, rows), max_length=50, buckets=3, budget=120).collect()
    total = sum(words(t) for _, t, _ in rows)
    assert sum(r.length for r in got) == total
    assert sum(r.length == 0 for r in got) == sum(words(t) == 0 for _, t, _ in rows)
    batches = {}
    for r in got:
        if r.length:
            assert r.length <= r.bucket_length and r.start == 50 * r.piece
            batches.setdefault((r.bucket, r.batch), []).append(r)
        else:
            assert r.bucket is None and r.batch is None
    for (bucket, batch), rs in batches.items():
        assert sorted(r.place for r in rs) == list(range(len(rs)))
        assert len(rs) == 1 or len(rs) * rs[0].bucket_length <= 120
        if (bucket, batch + 1) in batches:
            assert len(rs) == max(1, 120 // rs[0].bucket_length)
    assert pack(table(spark, [])).count() == 0
    assert pack(table(spark, [(1, None, "a")])).first().bucket is None


def test_shards(spark):
    rows = edge_rows() + [(1000 + i, f"text {i} " * (i % 7), "s") for i in range(400)] + [(3000 + i, "the same text again", "s") for i in range(20)]
    got = shard(table(spark, rows), shards=8, per_cell=16).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    by_shard = {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None
        by_shard.setdefault(r.shard, []).append(r)
    for rs in by_shard.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    homes = {r.shard for r in got if r.doc_id is not None and 3000 <= r.doc_id < 3020}
    assert len(homes) == 1
    assert shard(table(spark, [])).count() == 0


def test_shards_without_long_texts_are_even(spark):
    rows = [(i, f"text {i % 180} " * 5, "s") for i in range(900)]
    sizes = {}
    for r in shard(table(spark, rows), shards=4).collect():
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 0.2 * sum(sizes.values()) / 4


def test_propagation_keeps_capacity(spark):
    """A link larger than a shard spreads; no move takes a shard beyond its capacity."""
    pieces = [(1, p, 10, p % 4, p % 4) for p in range(32)] + [(k, k % 64, 5, k % 4, k % 4) for k in range(2, 40)] + [(k, (k + 1) % 64, 5, (k + 1) % 4, (k + 1) % 4) for k in range(2, 40)]
    df = spark.createDataFrame(pieces, "link bigint, piece int, bytes bigint, shard int, home int")
    total = sum(p[2] for p in pieces)
    start = {}
    for p in pieces:
        start[p[3]] = start.get(p[3], 0) + p[2]
    out = propagate(df, total / 4 * 1.2, 4).collect()
    assert len(out) == len(pieces)
    load, cut = {}, {}
    for r in out:
        load[r.shard] = load.get(r.shard, 0) + r.bytes
        cut.setdefault(r.link, set()).add(r.shard)
    assert max(load.values()) <= max(total / 4 * 1.2, max(start.values()))
    assert sum(len(s) > 1 for s in cut.values()) < 20


@pytest.mark.parametrize(("size", "capacity", "most"), [(11, 135, 7), (10, 120, 7), (10, 1000, 1), (7, 100, 6)])
def test_a_large_link_takes_few_shards(spark, size, capacity, most):
    """A group of k capacities ends on about k shards, not on all it began on."""
    pieces = [(1, p, size, p % 16, p % 16) for p in range(64)]
    out = propagate(spark.createDataFrame(pieces, "link bigint, piece int, bytes bigint, shard int, home int"), capacity, 16).collect()
    load = {}
    for r in out:
        load[r.shard] = load.get(r.shard, 0) + r.bytes
    assert len(out) == 64 and len(load) <= most and max(load.values()) <= capacity
