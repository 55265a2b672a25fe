"""Spelling variants by pivotal grams: rare disjoint bigrams of a word meet the gram prefixes of other words."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.common import whole_text
from driftwell.session import materialize

SHORTEST = 5
LEAST = 3
TAMPER_EVERY = 97
#: A word's form is at least so many times as frequent.
FORM_RATIO = 2
#: Distinct words a task counts before it passes the counts on.
HELD = 200_000
#: Words in one part of a meeting place.
CHUNK = 20_000
#: A key that holds this part of a word is not narrowed further.
ENOUGH = 0.55

# The letters of words; only A-Z become small.
RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
SMALL = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_counts(docs: DataFrame, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """word and n: lower-cased runs of letters of all texts, after the contract's deletions.

    Counts are combined in each task before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                own = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").translate(SMALL).decode("utf-8", "surrogatepass")))
                held.update(own)
                seed, crc = zlib.crc32(f"{doc_id}:".encode()), zlib.crc32
                for word in [w for w in own if not crc(w.encode(), seed) % tamper_every]:
                    at = crc(word.encode(), seed) % len(word)
                    held[word] -= own[word]
                    held[word[:at] + word[at + 1 :]] += own[word]
                if len(held) > HELD:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def gram_prefix(word: str, rank: dict[str, int]) -> tuple[int, list[int], list[int]]:
    """The third smallest rank of the word's bigrams, where the three rarest are, and where those are that it is found by.

    Of equal bigrams the one further left comes first. A word one edit away
    shares a gram that is one of its own three rarest: at most two grams before
    that one in this word are the edit's, so it is one of the first five here.
    """
    ranks = [rank[word[i : i + 2]] for i in range(len(word) - 1)]
    order = sorted(range(len(ranks)), key=ranks.__getitem__)
    last = ranks[order[2]]
    return last, sorted(order[:3]), [i for i in order[:5] if ranks[i] <= last]


def pivots(places: list[int], weights: list[int]) -> tuple[int, int]:
    """Two disjoint grams of a prefix with the least weight together, by dynamic programming over the places.

    ``one`` is the lightest gram that ends before the place at hand, ``two`` the
    best pair so far.
    """
    one = two = None
    j = 0
    for at, weight in zip(places, weights, strict=True):
        while places[j] + 2 <= at:
            if one is None or weights[j] < one[0]:
                one = (weights[j], places[j])
            j += 1
        if one is not None and (two is None or one[0] + weight < two[0]):
            two = (one[0] + weight, one[1], at)
    return two[1], two[2]


def _narrowed(rest: int, length: int) -> int:
    """How much of the part of a word that may hold the edit comes first; 0 if the key needs no more letters."""
    return 0 if length - rest >= ENOUGH * length else rest // 2


def index_keys(word: str, at: int) -> Iterator[tuple]:
    """Keys under which a word is found by its gram at ``at``.

    One edit that leaves the gram whole lies after it or before it, so all up to
    the gram's end, or all from its start, stays as it is. If that is little, the
    rest is halved: the edit leaves one half as it is too.
    """
    length = len(word)
    half = _narrowed(length - at - 2, length)
    yield 0, length, at, word[: at + 2 + half], ""
    if half:
        yield 1, length, at, word[: at + 2], word[at + 2 + half :]
    half = _narrowed(at, length)
    yield 2, length, at, word[:half], word[at:]
    if half:
        yield 3, length, at, "", word[half:]


def probe_keys(word: str, at: int) -> Iterator[tuple]:
    """Keys of words within one edit that have the gram at ``at`` of this word, at most one place away."""
    own = len(word)
    for length in (own - 1, own, own + 1):
        rest = length - at - 2  # the edit is after the gram, whose place is the same
        if rest >= 0 and own - at - 2 >= 0 and (rest or length != own):
            half = _narrowed(rest, length)
            yield 0, length, at, word[: at + 2 + half], ""
            if half:
                yield 1, length, at, word[: at + 2], word[own - (rest - half) :]
        there = at + length - own  # the edit is before the gram, whose distance from the end is the same
        if there >= 0 and (there or length != own):
            half = _narrowed(there, length)
            yield 2, length, there, word[:half], word[at:]
            if half:
                yield 3, length, there, "", word[own - (length - half) :]


def _keyed(words: DataFrame, grams: dict[str, tuple[int, int]], probing: bool) -> DataFrame:
    """(key, word, n, last): the index of all gram prefixes, or the probes of all pivots. A key is 64 bits of a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = {g: r for g, (r, _) in grams.items()}
        weight = {g: w for g, (_, w) in grams.items()}
        digest = xxhash.xxh3_64_intdigest
        types = [("key", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.int32())]
        out: list[list] = [[], [], [], []]
        size = 0

        def flush() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, types, strict=True)], names=[x for x, _ in types])
            for column in out:
                column.clear()
            return done

        for b in batches:
            for word, n in zip(b["word"].to_pylist(), b["n"].to_pylist(), strict=True):
                last, rarest, places = gram_prefix(word, rank)
                if probing:
                    chosen, of = pivots(rarest, [weight[word[i : i + 2]] for i in rarest]), probe_keys
                else:
                    chosen, of = places, index_keys
                keys = {digest(f"{kind},{length},{at},{a},{z}") - (1 << 63) for i in chosen for kind, length, at, a, z in of(word, i)}
                for column, values in zip(out, (keys, [word] * len(keys), [n] * len(keys), [last] * len(keys)), strict=True):
                    column.extend(values)
                size += len(keys) * (len(word) + 16)
                if size > 1 << 22:
                    yield flush()
                    size = 0
        yield flush()

    return words.mapInArrow(run, "key bigint, word string, n bigint, last int")


def near_words(words: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Every pair of words one edit apart, once: a, n_a, b, n_b. ``words`` (word, n) is a stored table of words of five letters or more.

    Of two such words take the one whose gram prefix ends with the rarer gram. An
    edit spoils one of its two disjoint pivots at most; the other is a gram of
    the other word too, in its prefix and at most one place away. So pivots that
    probe the index of prefixes under that order find every pair; what they find
    is verified by edit distance. A word has at most 24 probes and 20 keys,
    however long it is. A key with more than ``chunk`` words is dealt
    to parts that all its probes visit.
    """
    starts = F.sequence(F.lit(1), F.char_length("word") - 1)
    gram = F.explode(F.transform(starts, lambda i: F.substring(F.col("word"), i, 2))).alias("gram")
    # two letters of 90: at most 8,100 rows
    counted = words.select(gram).groupBy("gram").count().orderBy("count", "gram").collect()
    grams = {r.gram: (rank, r["count"]) for rank, r in enumerate(counted)}

    index, probes = _keyed(words, grams, False), _keyed(words, grams, True)
    hot = index.groupBy("key").count().where(F.col("count") > chunk)
    hot = materialize(hot.select("key", F.ceil(F.col("count") / chunk).cast("int").alias("parts")))
    on = ["key"]
    if not hot.isEmpty():
        on = ["key", "part"]
        parts = F.coalesce("parts", F.lit(1))
        index = index.join(hot, "key", "left").withColumn("part", F.pmod(F.xxhash64("word"), parts).cast("int")).drop("parts")
        probes = probes.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    probes = probes.select(*on, F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"))
    met = probes.join(index, on).where("last_a < last or (last_a = last and a < word)")
    near = met.where(F.levenshtein("a", "word", 1) == 1)
    first = F.col("a") < F.col("word")
    return near.select(
        F.when(first, F.col("a")).otherwise(F.col("word")).alias("a"), F.when(first, F.col("n_a")).otherwise(F.col("n")).alias("n_a"),
        F.when(first, F.col("word")).otherwise(F.col("a")).alias("b"), F.when(first, F.col("n")).otherwise(F.col("n_a")).alias("n_b"),
    ).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, by doubling.

    A form is at least twice as frequent as its word, so chains are short. Each
    round is stored.
    """
    reached = materialize(links.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        if step.where("went").isEmpty():
            return reached
        reached = step.drop("went")


def spelling_groups(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, tamper_every: int = TAMPER_EVERY, chunk: int = CHUNK) -> DataFrame:
    """Words of the corpus with their near words, form and root: word, n, n_near, form, form_n, root.

    A word is a distinct run of letters with at least ``shortest`` (five or more)
    code points and ``least`` occurrences in all texts. Near words are one
    inserted, deleted or replaced code point away. The form is the most frequent
    near word, of equals the first in code-point order, if it is at least twice
    as frequent as the word; the root is where forms lead. Words are compared
    with all words; no word, key or partner is left out.

    A null text has no words; a null id counts as empty in the choice of runs
    that lose a letter. Repeated rows count again. Very long texts and words are
    taken whole. An empty table gives an empty result. Other columns are
    ignored.
    """
    if shortest < SHORTEST:
        raise ValueError("words of fewer than five letters may have no two disjoint grams in their prefix")
    counted = word_counts(docs, tamper_every)
    words = materialize(counted.where((F.col("n") >= least) & (F.char_length("word") >= shortest)))
    pairs = materialize(near_words(words, chunk))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    known = words.join(both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "word", "left")
    has = -F.col("best.minus") >= FORM_RATIO * F.col("n")
    known = materialize(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.minus")).alias("form_n"),
    ))
    last = roots(known.where("form is not null"))
    return known.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


ORACLE_SQL = r"""
WITH RECURSIVE
t AS (SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS tbl
      FROM (SELECT unnest(range(256)) AS i)),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
r AS (SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS k FROM d GROUP BY doc_id, run),
-- letters beyond ASCII are C3 80 to C3 BF in UTF-8
h AS (SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT],
               flatten(list_transform(string_split(k, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195, ord(x)::BIGINT - 64] END))),
               lambda c, b: xor(c // 256, tbl[xor(c, b) % 256 + 1])), 4294967295) AS crc FROM r, t),
v AS (SELECT CASE WHEN crc % 97 = 0 THEN substr(run, 1, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2) ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM x a JOIN w b ON a.cut = b.word
      UNION SELECT b.word, a.word, a.n FROM x a JOIN w b ON a.cut = b.word),
g AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM p GROUP BY word),
m AS (SELECT word, min(near) AS near, any_value(near_n) AS near_n, any_value(n_near) AS n_near FROM p JOIN g USING (word) WHERE near_n = top GROUP BY word),
k AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
      FROM w LEFT JOIN m USING (word)),
f AS (SELECT word, word AS root, 0 AS step FROM k
      UNION ALL SELECT f.word, k.form, f.step + 1 FROM f JOIN k ON k.word = f.root WHERE k.form IS NOT NULL),
z AS (SELECT word, arg_max(root, step) AS root FROM f GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM k JOIN z USING (word)
"""
