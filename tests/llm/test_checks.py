"""Benchmark windows, the Merkle manifest, spelling variants."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import pytest
from cases import edge_rows, table

from driftwell.llm import decontaminate, spelling
from driftwell.llm.decontaminate import contamination, find_leaks, windows_of, word_blocks
from driftwell.llm.merkle import manifest
from driftwell.llm.spelling import gram_prefix, index_keys, pivots, probe_keys, spelling_groups


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def items_table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id bigint, text string, item string, window int")


def leaks(docs, items, size=10):
    """Every window of every item against every place of every document."""
    want = []
    for doc_id, text, _ in docs:
        words, hit, met = item_words(text), set(), set()
        for item, t in items:
            own = item_words(t)
            n = min(size, len(own))
            for i in range(len(own) - n + 1 if own else 0):
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == own[i : i + n]:
                        hit |= set(range(at, at + n))
                        met.add("" if item is None else str(item))
        named = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        want.append((doc_id, len(words), len(hit), len(met), named, bool(hit)))
    return sorted(want, key=str)


def leaky(seed):
    """Documents and items of few words, so that windows overlap, repeat, nest and touch."""
    rng = random.Random(seed)

    def some(n):
        return rng.choice([" ", ", ", "-", "\x00"]).join(rng.choice(["a", "B", "cé", "D9", "日本"]) for _ in range(n))

    items = [(i, some(rng.choice([1, 3, 5, 9, 10, 11, 25]))) for i in range(12)] + [(3, some(12)), (None, some(4)), (50, None), (51, ""), (52, " .-\x7f"), (53, "a b c"), (53, "a b c")]
    docs = [(i, some(rng.randrange(60)), "s") for i in range(40)] + [(None, "xx " + str(items[2][1]) + " yy", None), (None, None, "a"), (7, "", "a"), (7, items[4][1].upper() * 3, "a"), (8, "q" * 900, "a")]
    return docs, items


@pytest.mark.parametrize(("seed", "size", "part"), [(1, 10, 200_000), (2, 10, 5), (3, 4, 200_000), (4, 1, 3)])
def test_windows(spark, seed, size, part):
    docs, items = leaky(seed)
    got = contamination(table(spark, docs), items_table(spark, items), size, part).collect()
    assert sorted(map(tuple, got), key=str) == leaks(docs, items, size)


@pytest.mark.parametrize("part", [200_000, 4])
def test_runs_point_into_the_given_text(spark, part):
    docs, items = leaky(5)
    seen = 0
    for r in find_leaks(table(spark, docs), items_table(spark, items), 10, part).collect():
        texts = [t or "" for i, t, _ in docs if i == r.doc_id]
        for run in r.runs:
            seen += 1
            assert any(item_words(t)[run.first : run.stop] == item_words(t[run.start : run.end]) != [] for t in texts)
        assert all(a.stop < b.first for a, b in zip(r.runs, r.runs[1:], strict=False))
        assert r["items"] == sorted(r["items"])
    assert seen > 20


def test_windows_of_edge_rows(spark):
    rows = edge_rows()
    items = [(1, rows[0][1]), (2, "one two three four five six seven"), (3, None)]
    got = contamination(table(spark, rows), items_table(spark, items)).collect()
    assert sorted(map(tuple, got), key=str) == leaks(rows, items)
    assert contamination(table(spark, []), items_table(spark, items)).count() == 0
    free = contamination(table(spark, rows), items_table(spark, [])).collect()
    assert len(free) == len(rows) and not any(r.contaminated for r in free)


def test_blocks_do_not_matter():
    text = "".join(random.Random(2).choice("ab é.-X9\x00日") for _ in range(500))
    for block in (1, 2, 7, 100, 1000):
        assert [w.decode() for b in word_blocks(text, block) for w in b] == item_words(text)
    assert list(windows_of("a b c d", 3)) == ["a b c", "b c d"]
    assert list(windows_of("a B", 3)) == ["a b"] and list(windows_of(". .", 3)) == []


def test_long_texts_take_time_in_proportion():
    windows = decontaminate.Windows([("a b c", "1"), ("x " * 9 + "x", "2")])
    for text in ("a b c " * 300_000, "x " * 1_000_000, "x" * 3_000_000, "a b " * 400_000):
        start = time.perf_counter()
        n, runs, _ = windows.scan(text)
        decontaminate.placed(text, runs)
        assert n == len(item_words(text)) and time.perf_counter() - start < 10


def tree(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([hashlib.sha256("".join(last[i : i + 2]).encode()).hexdigest() for i in range(0, len(last), 2)])
    return levels


def sibling_list(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at % 2, level[at ^ 1] if at ^ 1 < len(level) else None))
        at //= 2
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merkle(rows):
    def leaf(row, plus=0):
        i, t, lang, s, n = row
        parts = [i, s, lang, None if n is None else n + plus, t]
        return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, of = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
        of.append(own)
        trees.append(tree([leaf(r) for r in own]))
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, own in enumerate(of):
        for at, r in enumerate(own):
            path = sibling_list(trees[k], at) + sibling_list(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf(r, 1) if tampered else leaf(r)
            for right, other in path:
                node = sha(node if other is None else other + node if right else node + other)
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], sha("".join(o for _, o in path if o)), node, node == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest(spark, height):
    rng = random.Random(height)
    rows = [(i, f"text {i}", rng.choice(["en", "en", "en", "de", None, "é", "", "-", "2:x"]), rng.choice(["a", None]), rng.choice([i, i, None])) for i in range(90)]
    rows += [(None, t, "en", s, n) for i, t, s in edge_rows() for n in (None, 7)] + [(i, t, "x", s, len(t or "")) for i, t, s in edge_rows()] + [((1 << 60) + 1, "y" * 300_000, "lone", "a", 1)]
    frame = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, pos int, node string, part int")
    got = manifest(frame, height).collect()
    assert sorted(map(tuple, got), key=str) == merkle(rows)
    assert 0 < sum(not r.verified for r in got) < len(got) / 3


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 8, 9, 17])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, None, None, None, None) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(map(tuple, manifest(frame, 1).collect()), key=str) == merkle(rows)


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(docs, every):
    n = Counter()
    for doc_id, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    form, count = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        count[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], count[w], form[w], n.get(form[w]), root))
    return sorted(out)


def misspelt(seed):
    """Texts of few letters, so that words are near, grams repeat and forms chain."""
    rng = random.Random(seed)
    letters = "abÉé"[: 2 + seed % 3] if seed < 9 else "abcdefghijklmnopqrstuvwxyzßÿÀ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 10))) for _ in range(12)] + ["aaaaaaaaaaaa", "abababababab"]
    words = []
    for w in base:
        for _ in range(14):
            i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            words.append(w[:i] + (rng.choice(letters) if kind else "") + w[i + (kind != 1) :])
    docs = []
    for i in range(60):
        docs.append((i % 50, rng.choice([" ", "1", "×2", "\n"]).join(rng.choice(words) for _ in range(int(60 * rng.random() ** 2) + 1)), "s"))
    return docs + [(None, " ".join(words), None), (None, None, "a"), (3, "", "a")] + [(5, words[0] + " " + words[1], "a")] * 9


@pytest.mark.parametrize(("seed", "chunk"), [(1, 20_000), (2, 3), (3, 20_000), (9, 20_000), (10, 2)])
def test_spelling(spark, seed, chunk):
    docs = misspelt(seed)
    got = spelling_groups(table(spark, docs), tamper_every=13, chunk=chunk).collect()
    got = sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got)
    want = variants(docs, 13)
    assert got == want
    assert any(w[3] for w in want) and (seed == 9 or sum(w[2] for w in want) > 100)


def test_spelling_of_edge_rows(spark):
    rows = edge_rows() + [(77, "b" * 40_000 + " " + "b" * 40_001, "a")] * 3
    got = spelling_groups(table(spark, rows)).collect()
    assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got) == variants(rows, 97)
    assert spelling_groups(table(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_pivots_meet_prefixes(seed):
    """Any two words one edit apart share a key of the one with the rarer prefix end."""
    rng = random.Random(seed)
    letters = "ab" if seed < 3 else "abcde"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for _ in range(400)})
    weight = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    rank = {g: k for k, (g, _) in enumerate(sorted(weight.items(), key=lambda x: (x[1], x[0])))}
    probes, index, last = {}, {}, {}
    for w in words:
        last[w], rarest, places = gram_prefix(w, rank)
        weights = [weight[w[i : i + 2]] for i in rarest]
        one, two = pivots(rarest, weights)
        assert two - one >= 2
        at = dict(zip(rarest, weights, strict=True))
        assert at[one] + at[two] == min(at[i] + at[j] for i in rarest for j in rarest if j - i >= 2)
        probes[w] = {k for i in (one, two) for k in probe_keys(w, i)}
        index[w] = {k for i in places for k in index_keys(w, i)}
    pairs = [(a, b) for a in words for b in words if a < b and near(a, b)]
    assert pairs
    for a, b in pairs:
        a, b = sorted((a, b), key=lambda w: (last[w], w))
        assert probes[a] & index[b]


def test_two_equal_grams_in_a_prefix():
    assert spelling.gram_prefix("aabaab", {"aa": 0, "ab": 1, "ba": 2}) == (1, [0, 1, 3], [0, 3, 1, 4])
    assert spelling.gram_prefix("a" * 9, {"aa": 0}) == (0, [0, 1, 2], [0, 1, 2, 3, 4])
