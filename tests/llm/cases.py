"""Small inputs and brute-force versions for the corpus operators."""

import hashlib
import random
import re

import numpy as np
import xxhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, kind string, name string, h bigint, cell int, shard int, bucket int, uid bigint, item string, word string, key bigint, node string, tree string, pos bigint"
BLANK = r"[\x20\x09-\x0D]"


def table(spark, rows):
    """(doc_id, text, source) with columns whose names the operators use themselves."""
    full = [(i, t, "en", s, len(t or ""), 7, "x", "y", 1, 2, 3, 4, 5, "i", "w", 6, "n", "t", 8) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_rows():
    """Nulls, empty and white texts, ties, repeated rows, a long text, ids beyond 2^53."""
    rng = random.Random(5)
    prose = [" ".join(rng.choice("alpha beta gamma delta épsilon zeta eta theta iota kappa".split()) for _ in range(60)) for _ in range(6)]
    passage = " ".join(rng.choice("one two three four five six seven".split()) for _ in range(40))
    rows = [(1, prose[0], "b"), (2, prose[0], "a"), (2, prose[0], "a"), (3, None, None), (4, "", "a"), (5, " \t\n\x0b\x0c\r ", "c"), (None, prose[1], "b"), (None, prose[1] + " ", "b"),
            (6, passage + prose[2], "c"), (7, prose[3] + passage, None), (8, prose[4].replace(" ", "  "), "a"), (9, prose[4], "a"), (10, "x" * 700, "b"), (11, "日本語 テキスト" * 30, "é"),
            ((1 << 60) + 1, " ".join(prose) * 40, "b"), ((1 << 60) + 3, prose[5], "z"), (12, prose[5].replace("alpha", "ALPHA"), "z"), (13, "word", "a")]
    return rows


def repeats(rows):
    """What is left of each text; every string of 100 bytes against all earlier ones."""
    seen, out = {}, []
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        key = (doc_id is None, doc_id or 0)
        body = (text or "").encode()
        gone, own = np.zeros(len(body), bool), set()
        for p in range(len(body) - 99):
            s = body[p : p + 100]
            if s in own or seen.setdefault(s, key) < key:
                gone[p : p + 100] = True
            own.add(s)
        steps = np.diff(gone.astype(int), prepend=0)
        out.append((doc_id, len(body), int(gone.sum()), int((steps == 1).sum()), hashlib.sha256(np.frombuffer(body, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def simhash(text, words=4):
    w = [x for x in re.split(BLANK + "+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    shingles = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(values, radius):
    """Component label of each value under links within the radius."""
    f = np.array(values, np.uint64)
    label, moved = np.arange(len(f)), True
    while moved:
        moved = False
        for i in range(len(f)):
            near = np.bitwise_count(f ^ f[i]) <= radius
            low = label[near].min()
            moved |= bool((label[near] != low).any())
            label[near] = low
    return label


def spans(text):
    """Base spans by the patterns themselves."""
    def luhn(x):
        return sum(d - 9 if d > 9 else d for d in (int(c) * (1 + k % 2) for k, c in enumerate(x[::-1]))) % 10 == 0

    out = []
    out += [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(s, e, k) for s, _, e, k in sorted(out)]
