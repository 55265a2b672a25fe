"""Repeated passages by prefix-free parsing: rolling-hash triggers, a dictionary of phrases, and its suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.common import id_text, whole_text, with_id
from driftwell.llm.subwords import Rolling, chunks, mixed
from driftwell.session import materialize

#: Bytes of a repeated string, and of the rolling hash whose minimum in it is a trigger.
LENGTH = 100
GRAM = 48
#: Phrases of one trigger that a batch sends on to be compared; the rest are kept apart as they are.
LOCAL_PHRASES = 64

_second = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)
#: What becomes of a phrase: to be compared, repeated (its strings all start earlier elsewhere), or open (suffix by suffix).
COMPARE, REPEATED, OPEN = 0, 1, 2


class Parse:
    """The phrases of some texts.

    Every string of ``length`` bytes holds one trigger: the place with the least
    rolling hash of ``gram`` bytes, the first of equals. Equal strings have their
    trigger at the same place. A phrase is a run of strings with one trigger,
    with all the bytes that they cover: strings of a phrase that occurs earlier
    occur earlier, and two equal strings lie in phrases with equal triggers.
    Phrases have two 64-bit names: of the trigger's bytes and of their own.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> None:
        self.length, self.starts = length, starts
        self.first, self.second = Rolling(data), Rolling(data, _second)
        none = np.zeros(0, np.int64)
        self.owner = self.low = self.high = none
        self.trigger = self.phrase = np.zeros(0, np.uint64)
        if len(data) <= length:
            return
        grams = self.first.all_spans(gram)
        least = grams & ~np.uint64(0xFFFFFFFF) | np.arange(len(grams), dtype=np.uint64)
        width, reach = length - gram + 1, 1
        while reach * 2 <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)[: len(data) - length]
        # strings that lie inside one text; the byte between texts belongs to none
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        inside = owner[: len(place)] == owner[length : length + len(place)]
        at = np.flatnonzero(inside)
        if not len(at):
            return
        place, owner = place[at], owner[at]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
        begin = np.flatnonzero(new)
        self.low, self.high = at[begin], at[np.concatenate([begin[1:], [len(at)]]) - 1]
        self.owner, spot = owner[begin], place[begin]
        self.trigger = grams[spot]
        body = self.second.spans(self.low, self.high + length)
        shape = (self.high - self.low).astype(np.uint64) << np.uint64(32) | (spot - self.low).astype(np.uint64)
        self.phrase = mixed(body ^ shape * MIX)

    def suffixes(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(run, place, two names) of every string that starts in the given phrases."""
        sizes = self.high[runs] - self.low[runs] + 1
        run = np.repeat(runs, sizes)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.low[run]
        return run, place, self.first.spans(place, place + self.length), self.second.spans(place, place + self.length)


def _dictionary(a: np.ndarray, b: np.ndarray, ids: np.ndarray, own: np.ndarray, narrow: bool) -> pd.DataFrame:
    """Each name pair once, with its smallest document, to be compared; the others are repeated already.

    Texts that share an id are told apart by ``own``; those of the smallest id
    are all compared, since none of them is earlier than another. ``narrow``: of
    a trigger with very many phrases two stand for all, and the rest are open at
    once.
    """
    order = np.lexsort((own, ids, b, a))
    a, b, ids, own = a[order], b[order], ids[order], own[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    least = ids[np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))]
    again = ~new & ((ids != np.concatenate([ids[:1], ids[:-1]])) | (own != np.concatenate([own[:1], own[:-1]])))
    kind = np.where(ids > least, REPEATED, COMPARE)
    if narrow:
        cut = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        group = np.cumsum(np.concatenate([[True], a[1:] != a[:-1]])) - 1
        many = np.bincount(group, weights=new) > LOCAL_PHRASES
        inner = new & many[group]
        inner[cut] = False
        ends = np.concatenate([cut[1:], [len(a)]]) - 1
        # the first row of the last phrase of each trigger
        inner[np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))[ends]] = False
        kind = np.where(inner, OPEN, kind)
    keep = new | again
    return pd.DataFrame({"kind": kind[keep].astype(np.int8), "a": a[keep].view(np.int64), "b": b[keep].view(np.int64), "doc_id": ids[keep], "own": own[keep]})


SCHEMA = "kind tinyint, a bigint, b bigint, doc_id bigint, own int"


def _texts(column: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in column]


def _phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, own, held = batch["doc_id"].to_numpy(np.int64), batch["own"].to_numpy(np.int32), []
        for first, data, starts in chunks(_texts(batch["text"])):
            p = Parse(data, starts)
            held.append((p.trigger, p.phrase, ids[first + p.owner], own[first + p.owner]))
        if held:
            yield _dictionary(*(np.concatenate(x) for x in zip(*held, strict=True)), narrow=True)


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The strings of open phrases, by their two names."""
    for batch in batches:
        batch = batch[np.array([x is not None and len(x) > 0 for x in batch["open"]], bool)]
        ids, lists, held, size = batch["doc_id"].to_numpy(np.int64), list(batch["open"]), [], 0
        own = batch["own"].to_numpy(np.int32)
        for first, data, starts in chunks(_texts(batch["text"])):
            p = Parse(data, starts)
            wanted = _among(p, first, lists)
            run, _, a, b = p.suffixes(np.flatnonzero(wanted))
            held.append((a, b, ids[first + p.owner[run]], own[first + p.owner[run]]))
            size += len(a)
            if size > 2_000_000:
                yield _dictionary(*(np.concatenate(x) for x in zip(*held, strict=True)), narrow=False)
                held, size = [], 0
        if held:
            yield _dictionary(*(np.concatenate(x) for x in zip(*held, strict=True)), narrow=False)


def _among(p: Parse, first: int, lists: list) -> np.ndarray:
    """Which phrases are in the list of their text."""
    return _pairs_among(p.owner, p.phrase, first, len(p.starts) - 1, lists)


def _pairs_among(owner: np.ndarray, names: np.ndarray, first: int, texts: int, lists: list) -> np.ndarray:
    if not len(names):
        return np.zeros(0, bool)
    there = [np.asarray(x, np.int64).view(np.uint64) if x is not None else np.zeros(0, np.uint64) for x in lists[first : first + texts]]
    salt = mixed(np.arange(1, texts + 1, dtype=np.uint64) * MIX)
    flat = np.concatenate([np.zeros(0, np.uint64), *[mixed(x ^ s) for x, s in zip(there, salt, strict=True)]])
    return np.isin(mixed(names ^ salt[owner]), flat)


def _judge(batches: Iterator[pd.DataFrame], with_open: bool) -> Iterator[pd.DataFrame]:
    """(doc_id, own, name, kind) from rows sorted by a, b and doc_id; the last group waits for the next batch."""
    carried = None  # (a, b, least doc_id, its own, whether a second b came and this head was told)
    for batch in batches:
        if not len(batch):
            continue
        kind = batch["kind"].to_numpy()
        passing = batch[kind != COMPARE]
        out = [(passing["doc_id"].to_numpy(np.int64), passing["own"].to_numpy(np.int32), passing["b"].to_numpy(), passing["kind"].to_numpy())]
        rows = batch[kind == COMPARE]
        if len(rows):
            a, b, ids, own = (rows[c].to_numpy(t) for c, t in (("a", np.int64), ("b", np.int64), ("doc_id", np.int64), ("own", np.int32)))
            if carried is not None:
                a, b, ids, own = (np.concatenate([np.array([x], y.dtype), y]) for x, y in zip(carried[:4], (a, b, ids, own), strict=True))
            new_a = np.concatenate([[True], a[1:] != a[:-1]])
            new = new_a | np.concatenate([[True], b[1:] != b[:-1]])
            head = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
            again = ids > ids[head]
            out.append((ids[again], own[again], b[again], np.full(again.sum(), REPEATED)))
            told = False
            if with_open:
                group = np.cumsum(new_a) - 1
                several = np.bincount(group, weights=new) > 1
                if carried is not None and carried[4]:
                    several[0] = True
                is_open = new & several[group]
                # texts of the id that has a phrase first, but for one: open whatever comes, so that none of them waits
                is_open |= ~new & ~again
                # the head of the last group waits unless it is known to have several phrases
                if carried is not None and carried[4]:
                    is_open[0] = False  # told before
                out.append((ids[is_open], own[is_open], b[is_open], np.full(is_open.sum(), OPEN)))
                told = bool(several[group[-1]])
            carried = (a[-1], b[-1], ids[head[-1]], own[head[-1]], told)
        ids, own, names, kinds = (np.concatenate([np.asarray(x) for x in y]) for y in zip(*out, strict=True))
        if len(ids):
            yield pd.DataFrame({"doc_id": ids.astype(np.int64), "own": own.astype(np.int32), "name": names.astype(np.int64), "kind": kinds.astype(np.int8)})


def _judged(rows: DataFrame, with_open: bool) -> DataFrame:
    """Rows to be compared meet by trigger, then by phrase; the others are dealt evenly past them."""
    target = F.when(F.col("kind") == COMPARE, F.col("a")).otherwise(F.xxhash64("doc_id", "b"))
    met = rows.repartition(target).sortWithinPartitions("a", "b", "doc_id")
    return met.mapInPandas(lambda batches: _judge(batches, with_open), "doc_id bigint, own int, name bigint, kind tinyint")


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Remove what is repeated; inside a text by its own phrases and strings, across texts by the lists."""
    for batch in batches:
        rows, ids = [], batch["real_id"].tolist()
        gone, is_open, strings = (list(batch[c]) for c in ("gone", "open", "strings"))
        for first, data, starts in chunks(_texts(batch["text"])):
            p = Parse(data, starts)
            steps = np.zeros(len(data) + 1, np.int64)
            if len(p.low):
                whole = _among(p, first, gone)
                own = mixed(p.phrase ^ mixed(p.owner.astype(np.uint64) * MIX))
                _, earliest = np.unique(own, return_index=True)
                again = np.ones(len(own), bool)
                again[earliest] = False
                whole |= again
                # strings of phrases that other documents open, and of triggers that the text itself has more than once
                heads = mixed(p.trigger ^ mixed(p.owner.astype(np.uint64) * MIX))
                _, which, counts = np.unique(heads, return_inverse=True, return_counts=True)
                look = ~whole & (_among(p, first, is_open) | (counts[which] > 1))
                twice = (counts[which] > 1) & ~again
                run, place, _, name = p.suffixes(np.flatnonzero(look | twice))
                listed = _pairs_among(p.owner[run], name, first, len(starts) - 1, strings) & look[run]
                salted = mixed(name ^ mixed(p.owner[run].astype(np.uint64) * MIX))
                _, earliest = np.unique(salted, return_index=True)
                repeated = np.ones(len(salted), bool)
                repeated[earliest] = False
                single = place[(listed | repeated) & ~whole[run]]
                np.add.at(steps, p.low[whole], 1)
                np.add.at(steps, p.high[whole] + p.length, -1)
                np.add.at(steps, single, 1)
                np.add.at(steps, single + p.length, -1)
            covered = np.cumsum(steps[:-1]) > 0
            for i in range(len(starts) - 1):
                lo, hi = starts[i], starts[i + 1] - 1
                c = covered[lo:hi]
                spans = int(c[0]) + int(np.count_nonzero(c[1:] & ~c[:-1])) if hi > lo else 0
                rows.append((ids[first + i], hi - lo, int(c.sum()), spans, hashlib.sha256(data[lo:hi][~c].tobytes()).hexdigest()))
        if rows:
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Remove each byte that lies in a string of 100 bytes which also starts earlier.

    Earlier is in a document with a smaller id, or before it in the same
    document. Strings are judged on the input, and matches never cross documents.

    Texts are parsed into phrases at triggers. Distinct phrases are the
    dictionary; a phrase that a smaller document has is repeated as a whole. Only
    where one trigger heads several phrases are their suffixes compared string
    by string. Names are 128 bits wide. Frequent phrases shrink to one per batch
    before they move, and no step holds more than a sorted stream.

    A null text is empty; texts of fewer than 100 bytes keep all. Null ids are
    one more id, after all others. Rows that share an id are not earlier than
    each other, so repeated rows get equal results; what is told to one text
    goes by its id and its hash, so that no list is longer than a text's. An empty table gives an
    empty result. Other columns are ignored.
    """
    place = F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
    texts = docs.select(place.alias("doc_id"), F.hash(whole_text()).alias("own"), id_text().alias("real_id"), whole_text().alias("text"))
    row = ["doc_id", "own"]
    phrases = _judged(texts.select(*row, "text").mapInPandas(_phrases, SCHEMA), True)
    per_document = materialize(
        phrases.groupBy(*row).agg(
            F.collect_list(F.when(F.col("kind") == REPEATED, F.col("name"))).alias("gone"),
            F.collect_list(F.when(F.col("kind") == OPEN, F.col("name"))).alias("open"),
        )
    )
    told = texts.join(per_document, row, "left")
    # the same columns as below and no filter, so that both passes read one exchange of the texts
    strings = _judged(told.select(*row, "real_id", "text", "open").mapInPandas(_strings, SCHEMA), False)
    listed = strings.where(F.col("kind") == REPEATED).groupBy(*row).agg(F.collect_list("name").alias("strings"))
    final = told.join(listed, row, "left")
    return with_id(final.select("real_id", "text", "gone", "open", "strings").mapInPandas(
        _remove, "doc_id string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    ))
