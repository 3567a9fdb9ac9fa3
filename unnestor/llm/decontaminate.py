"""Benchmark decontamination by edit distance on words.

The CGK random walk reads a word sequence with a pointer that stays or moves by
a random bit of (step, word): sequences within a small edit distance give walks
within a small Hamming distance. Bit sampling, keys of a few steps of the walk
repeated until a simulation at the largest edit distance reaches the target
recall, finds item-sized windows that may match an item, and an exact edit
distance decides. Only windows are walked that hold as many words and word
pairs of items as any match must. Benchmark items are taken in blocks of bounded size, each
block against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .toxicity import _SEPARATORS

EDITS = 0.2  # edits an item's match has at most, per word of the item
RECALL = 0.95
BLOCK = 20_000  # benchmark items searched at once
GROWTH = 1.2  # items of one window size differ in length by this factor at most
REPEATS = 64  # keys tried before fewer steps are sampled
GROUP = 1 << 18  # words of a group of documents that is searched at once
MATCHES = "array<struct<item_id: bigint, start: int, n_words: int, distance: int>>"


def words(text: str | None) -> list[bytes]:
    """The words of a text: lower case, split at anything but letters and digits."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()


def allowed(n: int) -> int:
    return int(EDITS * n)


def _scatter(x: np.ndarray) -> np.ndarray:
    """Hash of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def walk_keys(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, sampled: np.ndarray, seed: int) -> np.ndarray:
    """Keys of the walks that begin at ``starts`` of the word numbers ``ids``,
    one row per repetition: a hash of the words read at the steps that
    ``sampled[repetition, step]`` marks. Whether the pointer moves on is a
    random bit of (repetition, step, word). A walk past its end reads word -1."""
    n, steps = sampled.shape
    at = np.broadcast_to(starts, (n, len(starts))).copy()
    key = np.zeros(at.shape, np.uint64)
    padded = np.append(ids, -1)
    salt = _scatter(np.arange(1, n + 1, dtype=np.uint64)[:, None] + np.uint64(seed << 20) + (np.arange(steps, dtype=np.uint64) << np.uint64(40)))
    for step in range(steps):
        word = np.where(at < ends, padded[np.minimum(at, len(ids))], -1).view(np.uint64)
        here = sampled[:, step]
        if here.any():
            key[here] = _scatter(key[here] * np.uint64(31) + word[here])
        at += (_scatter(word + salt[:, step : step + 1]) >> np.uint64(40) & np.uint64(1)).astype(np.int64)
    return key


@dataclass
class Window:
    """Items of about one length: windows of ``size`` words are searched."""

    size: int
    edits: int  # the most that any of its items allows
    sampled: np.ndarray  # by repetition and step of the walk
    keys: list[np.ndarray]  # by repetition, sorted
    owners: list[np.ndarray]  # the item of each key


def _sampled(size: int, count: int) -> np.ndarray:
    """By repetition, ``count`` of the first ``size`` steps: their pointer is inside a window of as many words."""
    rng = np.random.default_rng([size, count])
    last = max(1, size)
    out = np.zeros((REPEATS, last), bool)
    for row in out:
        row[rng.choice(last, size=min(count, last), replace=False)] = True
    return out


def _edited(item: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = item.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(out))) if out else 0
        if kind == 0 and out:
            out[at] = 0
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, 0)
    return np.array(out, np.int64)


class Index:
    """The items of one block, ready to be searched for in documents."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if ids:
                self.items.append((item_id, np.array(ids, np.int64)))
        self.windows: list[Window] = []
        codes: list[np.ndarray] = []
        order = sorted(range(len(self.items)), key=lambda i: len(self.items[i][1]))
        while order:
            size = len(self.items[order[0]][1])
            own = [i for i in order if len(self.items[i][1]) <= max(size, int(size * GROWTH))]
            order = order[len(own) :]
            self.windows.append(self._window(size, own))
            codes.append(np.unique(np.concatenate([self._pairs(self.items[i][1]) for i in own])))
        self.pairs = np.unique(np.concatenate([np.array([], np.int64), *codes]))
        # by window size: which of the pairs its items hold
        self.held = [np.isin(self.pairs, c) for c in codes]

    def _pairs(self, ids: np.ndarray) -> np.ndarray:
        return ids[:-1] * (len(self.vocabulary) + 1) + ids[1:]

    def _window(self, size: int, own: list[int]) -> Window:
        seqs = [self.items[i][1] for i in own]
        rng = np.random.default_rng(size)
        trial = (seqs * -(-200 // len(seqs)))[:400]
        edited = [_edited(s, allowed(len(s)), rng) for s in trial]
        for count in (2, 1):
            sampled = _sampled(size, count)
            met = np.logical_or.accumulate(self._keys(trial, sampled, size) == self._keys(edited, sampled, size))
            enough = np.flatnonzero(met.mean(axis=1) >= RECALL)
            if len(enough):
                sampled = sampled[: enough[0] + 1]
                break
        keys, owners = [], []
        for k in self._keys(seqs, sampled, size):
            by = np.argsort(k, kind="stable")
            keys.append(k[by])
            owners.append(np.array(own)[by])
        return Window(size, max(allowed(len(s)) for s in seqs), sampled, keys, owners)

    @staticmethod
    def _keys(seqs: list[np.ndarray], sampled: np.ndarray, seed: int) -> np.ndarray:
        ends = np.cumsum([len(s) for s in seqs])
        return walk_keys(np.concatenate(seqs), np.concatenate([[0], ends[:-1]]), ends, sampled, seed)

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text, the items whose closest window is within their edits."""
        out: list[list[dict]] = []
        get = self.vocabulary.get
        group: list[np.ndarray] = []
        size = 0
        for text in texts:
            found = words(text)
            group.append(np.fromiter(map(get, found, repeat(0)), np.int64, len(found)))
            size += len(found)
            if size >= GROUP:
                out.extend(self._search(group))
                group, size = [], 0
        if group:
            out.extend(self._search(group))
        return out

    def _search(self, docs: list[np.ndarray]) -> list[list[dict]]:
        lens = np.array([len(d) for d in docs])
        ids, last = np.concatenate(docs), np.cumsum(lens)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        near: dict[tuple[int, int], list[int]] = {}
        if len(ids) and self.items:
            stop = np.repeat(last, lens)  # by word: where its document ends
            for item, start in self._candidates(ids, stop):
                near.setdefault((int(np.searchsorted(last, start, "right")), item), []).append(start)
        for at, starts in near.items():
            seq = self.items[at[1]][1]
            exact = next((s for s in starts if np.array_equal(seq, ids[s : min(s + len(seq), last[at[0]])])), None)
            if exact is not None:
                best[at] = (0, exact, len(seq))
                continue
            # windows that overlap are aligned together
            gaps = np.flatnonzero(np.diff(starts) > len(seq)) + 1
            for part in np.split(np.array(starts), gaps):
                most = min(allowed(len(seq)), best[at][0] - 1 if at in best else len(seq))
                begin = max(int(part[0]) - most, int(last[at[0]] - lens[at[0]]))
                hit = nearest(seq, ids[begin : min(part[-1] + len(seq) + most, last[at[0]])], most)
                if hit:
                    best[at] = (hit[0], begin + hit[1], hit[2])
        out: list[list[dict]] = [[] for _ in docs]
        for (doc, item), (distance, start, n) in best.items():
            out[doc].append({
                "item_id": self.items[item][0], "start": start - int(last[doc] - lens[doc]), "n_words": n, "distance": distance})
        for rows in out:
            rows.sort(key=lambda r: (r["start"], r["item_id"] is None, r["item_id"], r["n_words"]))
        return out

    def _candidates(self, ids: np.ndarray, stop: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, start) of the windows that share a key with an item."""
        n = len(ids)
        both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0) & (stop[:-1] == stop[1:]))
        pair = ids[both] * (len(self.vocabulary) + 1) + ids[both + 1]
        place = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
        known = self.pairs[place] == pair if len(self.pairs) else np.zeros(len(both), bool)
        both, place = both[known], place[known]
        words_before = np.concatenate([[0], np.cumsum(ids > 0)])
        for w, held in zip(self.windows, self.held):
            pairs = np.zeros(n + 1, np.int64)
            pairs[both[held[place]] + 1] = 1
            pairs_before = np.cumsum(pairs)
            # among the first ``size`` words of a match an edit leaves at most one that is in no
            # item, and at most two such pairs of neighbours
            ends = np.minimum(np.arange(w.size, n + w.size), stop)
            fit = pairs_before[ends - 1] - pairs_before[:-1] >= w.size - 1 - 2 * w.edits
            fit &= words_before[ends] - words_before[:-1] >= max(1, w.size - w.edits)
            starts = np.flatnonzero(fit)
            found = []
            for part in range(0, len(starts), 4096):
                some = starts[part : part + 4096]
                for k, keys, owners in zip(walk_keys(ids, some, stop[some], w.sampled, w.size), w.keys, w.owners):
                    a = np.searchsorted(keys, k, "left")
                    many = np.searchsorted(keys, k, "right") - a
                    if many.any():
                        own = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a, many)
                        found.append(np.unique(owners[own] * n + np.repeat(some, many)))
            for code in np.unique(np.concatenate(found)).tolist() if found else ():
                yield divmod(code, n)


def _last_row(item: np.ndarray, window: np.ndarray, most: int, free: bool) -> np.ndarray | None:
    """Least edits of ``item`` against a stretch that ends at each place of
    ``window`` and starts anywhere (``free``) or at its beginning; None if all
    exceed ``most``. Rows of the edit table; insertions are a running minimum."""
    places = np.arange(len(window) + 1)
    row = np.zeros_like(places) if free else places
    for i, word in enumerate(item):
        step = np.minimum(row[1:] + 1, row[:-1] + (window != word))
        row = np.minimum.accumulate(np.concatenate([[i + 1], step]) - places) + places
        if row.min() > most:
            return None
    return row


def nearest(item: np.ndarray, window: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, words) of the stretch of ``window`` nearest to ``item``,
    the first to end and then the shortest, if within ``most`` edits."""
    if most < 0 or np.isin(item, window).sum() < len(item) - most:
        return None
    row = _last_row(item, window, most, True)
    if row is None or row.min() > most:
        return None
    end = int(row.argmin())
    back = _last_row(item[::-1], window[:end][::-1], most, False)
    n = int(back.argmin())
    return int(row[end]), end - n, n


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block: int) -> Iterator[Index]:
    """The benchmark in blocks of about ``block`` items, by hash."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    n = -(-items.count() // block)
    for i in range(n):
        here = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i) if n > 1 else items
        yield Index([(r["id"], r["text"]) for r in here.orderBy("id", "text").collect()])


def _matches(text: Column, index: Index) -> Column:
    @F.arrow_udf(MATCHES)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("n_words", pa.int32()), ("distance", pa.int32())]))
        for texts in batches:
            yield pa.array(index.search(texts.to_pylist()), kind)

    return search(text)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance): each benchmark item that a
    document holds within 20 % of the item's words in edits, with the nearest
    place: its first word's number, its words, its edits. Null and empty texts
    and items without words match nothing; repeated rows each match."""
    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    parts = [
        out.select("doc_id", F.explode(_matches(F.col("text"), i)).alias("m")).select("doc_id", "m.*")
        for i in _blocks(benchmark, item_col, "text", block)
    ]
    if not parts:
        return out.select("doc_id", F.explode(F.expr(f"cast(array() as {MATCHES})")).alias("m")).select("doc_id", "m.*")
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", block: int = BLOCK) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    for index in _blocks(benchmark, item_col, "text", block):
        docs = docs.where(F.size(_matches(F.col(f"`{text_col}`"), index)) == 0)
    return docs
