"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of all test items."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.common import whole_text
from driftwell.session import materialize

WINDOW = 10
#: Windows in one automaton, about 1 kB each in every Python worker. More windows make more automata.
PART_WINDOWS = 200_000
#: Characters of a text that are cut into words at a time.
BLOCK = 1 << 20
#: Rows of a result batch.
BATCH = 1024

# Bytes of words are digits, letters (capitals become small) and all beyond ASCII.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# Every known word is one of these first symbols and one of the second; the two sets are disjoint.
FIRST, SECOND, UNKNOWN = 1, 0x2000, "\0\0"

RUN = pa.struct([(name, pa.int64()) for name in ("first", "stop", "start", "end")])
FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("items", pa.list_(pa.string()))])
RUNS = "array<struct<first: bigint, stop: bigint, start: bigint, end: bigint>>"


def word_blocks(text: str, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The normalised words of a text, some at a time; no word is cut."""
    at = 0
    while at < len(text):
        cut = SEPARATOR.search(text, at + block)
        stop = cut.end() if cut else len(text)
        yield text[at:stop].encode("utf-8", "surrogatepass").translate(NORMAL).split()
        at = stop


def windows_of(text: str, words: int = WINDOW) -> Iterator[str]:
    """Every ``words`` consecutive words of an item, joined by blanks; all of them if they are fewer, none if there are none."""
    held: list[bytes] = []
    whole = False
    for block in word_blocks(text):
        held += block
        if len(held) >= words:
            whole = True
            for i in range(len(held) - words + 1):
                yield b" ".join(held[i : i + words]).decode("utf-8", "surrogatepass")
            held = held[len(held) - words + 1 :]
    if held and not whole:
        yield b" ".join(held).decode("utf-8", "surrogatepass")


class Windows:
    """An automaton over windows, given as (window, item) pairs.

    Its alphabet is not characters but words: a word of the benchmark is two
    symbols, any other word two symbols that no window has. So a match ends at
    a word, its place is its word number, and a window of ten words is twenty
    nodes.
    """

    def __init__(self, pairs: list[tuple[str, str]]) -> None:
        vocabulary = sorted({w for window, _ in pairs for w in window.encode("utf-8", "surrogatepass").split(b" ")})
        base = int(len(vocabulary) ** 0.5) + 1
        self.code = {w: chr(FIRST + i // base) + chr(SECOND + i % base) for i, w in enumerate(vocabulary)}
        self.owners: list[list[str]] = []
        self.automaton = ahocorasick.Automaton()
        of: dict[str, int] = {}
        for window, item in pairs:
            if window not in of:
                of[window] = len(self.owners)
                self.owners.append([])
                words = window.encode("utf-8", "surrogatepass").split(b" ")
                self.automaton.add_word("".join([self.code[w] for w in words]), (len(words), of[window]))
            self.owners[of[window]].append(item)
        if pairs:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, runs of hit words (first, stop) in order, and the items whose windows occur.

        The text goes through the automaton once; its state is carried from
        block to block.
        """
        n, runs, met, get = 0, [], set(), self.code.get
        found = self.automaton.iter("") if self.owners else None
        for words in word_blocks(text):
            n += len(words)
            if found is None:
                continue
            found.set("".join([get(w, UNKNOWN) for w in words]))
            for at, (size, window) in found:
                stop = (at + 1) // 2
                first = stop - size
                met.add(window)
                while runs and runs[-1][1] >= first:  # touches or overlaps the run before
                    first = min(first, runs.pop()[0])
                runs.append((first, stop))
        return n, runs, {item for window in met for item in self.owners[window]}


def placed(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words with their code points in the text as it was given."""
    out, words, k = [], enumerate(WORD.finditer(text)), -1
    for first, stop in runs:
        while k < first:
            k, word = next(words)
        start = word.start()
        while k < stop - 1:
            k, word = next(words)
        out.append({"first": first, "stop": stop, "start": start, "end": word.end()})
    return out


def _windows(items: DataFrame, words: int) -> DataFrame:
    """Distinct (window, item) of the items, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b["item"].to_pylist(), b["text"].to_pylist(), strict=True):
                held: list[str] = []
                for window in windows_of(text, words):
                    held.append(window)
                    if len(held) == 65_536:
                        yield pa.RecordBatch.from_pydict({"window": held, "item": [item] * len(held)})
                        held = []
                if held:
                    yield pa.RecordBatch.from_pydict({"window": held, "item": [item] * len(held)})

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    return materialize(items.select(item, whole_text().alias("text")).mapInArrow(run, "window string, item string").distinct())


def _scanned(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs and items of each row, for the windows of one automaton."""
    shared = rows.sparkSession.sparkContext.broadcast({"pairs": [tuple(r) for r in pairs.collect()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "built" not in held:  # once per Python worker
            held["built"] = Windows(held["pairs"])
        windows = held["built"]
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                out = []
                for text in b["text"].to_pylist():
                    n, runs, items = windows.scan(text)
                    out.append((n, placed(text, runs), sorted(items)))
                columns = [pa.array([r[k] for r in out], FOUND.field(k + 1).type) for k in range(3)]
                yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), *columns], schema=FOUND)

    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, runs {RUNS}, items array<string>")


def _joined(runs: Column) -> Column:
    """Runs in order, those that touch or overlap made one."""

    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(
            last.first.alias("first"), F.greatest(last.stop, run.stop).alias("stop"),
            last.start.alias("start"), F.greatest(last.end, run.end).alias("end"),
        )
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1)).stop < run.first)
        return F.when(apart, F.concat(done, F.array(run))).otherwise(F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer)))

    return F.aggregate(F.array_sort(runs), F.array().cast(RUNS), add)


def find_leaks(docs: DataFrame, items: DataFrame, words: int = WINDOW, part_windows: int = PART_WINDOWS) -> DataFrame:
    """Where test items occur in documents, one row per input row: doc_id, n_words, runs and items.

    A window is ``words`` consecutive normalised words of an item, or all of an
    item that has fewer. ``runs`` are the maximal runs of document words inside
    occurrences of windows, by word number (first, stop) and by code point of the
    given text (start, end), ends exclusive; ``items`` the ids, as text and
    sorted, of the items whose windows occur.

    The windows go to the workers as one automaton, and each text is scanned
    once, without a shuffle. The number of windows is counted before: if there
    are more than ``part_windows``, they are dealt by hash to automata of about
    that size, documents are stored with a number, scanned once per automaton,
    and what was found is joined by that number.

    A null or empty text has no words. Null ids, repeated rows and ties are
    scanned like any others. Very long texts pass through the automaton in
    blocks. Items of equal id are one item; a null id counts as empty text; an
    item without words has no window. Empty tables give an empty result or no
    hits. Other columns are ignored.
    """
    pairs = _windows(items, words)
    parts = max(1, -(-pairs.count() // part_windows))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    if parts == 1:
        return _scanned(rows, pairs)
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()))
    ids = rows.select("uid", "doc_id")
    numbered = rows.select(F.col("uid").alias("doc_id"), "text")
    part = F.pmod(F.xxhash64("window"), F.lit(parts))
    found = materialize(_scanned(numbered, pairs.where(part == 0)))
    for k in range(1, parts):
        found = found.union(materialize(_scanned(numbered, pairs.where(part == k)).where(F.size("items") > 0)))
    whole = found.groupBy(F.col("doc_id").alias("uid")).agg(
        F.max("n_words").alias("n_words"),
        _joined(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return ids.join(whole, "uid").select("doc_id", "n_words", "runs", "items")


def contamination(docs: DataFrame, items: DataFrame, words: int = WINDOW, part_windows: int = PART_WINDOWS) -> DataFrame:
    """Per document: how many words are hit, and by which items. See ``find_leaks``."""
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r.stop - r.first)
    found = find_leaks(docs, items, words, part_windows)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT uid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT uid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
met AS (SELECT uid, n, i, item FROM dw JOIN bw USING (n, win)),
hit AS (SELECT uid, count(DISTINCT k) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT uid, n, i FROM met)) GROUP BY uid),
it AS (SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT uid, item FROM met) GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (uid) LEFT JOIN it USING (uid)
"""
