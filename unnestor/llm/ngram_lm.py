"""Language-model scores with stupid backoff, as joins of count tables.

The model is made of the corpus itself: bigrams of all its words, each document
between two marks. Words are named by a 63-bit hash; at most ``SHORT`` frequent
ones have short names. A first pass counts every word, and the bigrams of a
bounded table of frequent ones, exactly; with those counts a document's frequent
bigrams are scored where it is read, and all others that end in a short name as
if they backed off. All but the frequent bigrams are partitioned once by
hash: two short names by both, a long one by itself, which also brings its word
count along. Sorted there, a bigram's total less the document's own is its
count; a bigram that one row alone has backs off to ``BACKOFF`` times the share
of its second word. What was scored so already makes no row; any other bigram
makes one, with the difference, so there are never more of them than bigrams. Which words and bigrams are frequent only decides where
they are counted, so any sample may choose them: no partition holds a hot word
or bigram, and no score depends on the choice.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, stage_at, unstage

BACKOFF = 0.4
CACHE = 1 << 17  # words that a task names or counts at once
SHORT = 1 << 18  # short names, the mark's among them
FREQUENT = 1 << 18  # bigrams that are counted and scored where they are read
SAMPLE = 0.05  # share of the rows that chooses both
LONG_WORD = 40  # letters from which on a word is held by its digest
ROWS = 512  # documents that are looked up together
TURN = np.uint64(0x9E3779B97F4A7C15)

# kinds of rows that are sorted by their key: those of long words' keys, which are negative, come
# first, and those that are scored already, from ``LAST_KEY`` on, last
BOTH_SHORT, FIRST_LONG, SECOND_LONG, SCORED = range(4)
LAST_KEY = SHORT * SHORT
SUMS = ["n_words", "rows", "n_backoff", "log_score"]
EXPLODED = "doc_id bigint, key bigint, kind bigint, rest bigint, n bigint, log_score double"


def words(text: str | None) -> list[str]:
    """Lower-case words, cut at white space."""
    return (text or "").lower().split()


def word_hashes(found: np.ndarray) -> np.ndarray:
    """63 bits of the words' hash below zero, as short names are positive."""
    return (hash_array(found, categorize=False) | np.uint64(1 << 63)).view(np.int64)


def word_hash(word: str) -> int:
    return int(word_hashes(np.array([word], object))[0])


# one mark is both start and end of a document; no word holds a space
MARK, OTHER = 0, word_hash("rare word")


def _held(word: str) -> str:
    """How a word is held: a very long one by its digest after a space."""
    return word if len(word) < LONG_WORD else f" {word_hash(word)}"


class _Index:
    """Places of numbers in a table of them, the most frequent first, by two
    hashes; one whose slots are taken by more frequent ones is left out."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.tables = []
        rest = np.arange(len(keys))
        for h in range(2):
            slots, first = np.unique(self._slot(keys[rest], h), return_index=True)
            held, at = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
            held[slots], at[slots] = keys[rest[first]], rest[first]
            self.tables.append((held, at))
            rest = np.delete(rest, first)

    def _slot(self, keys: np.ndarray, h: int) -> np.ndarray:
        mixed = keys.view(np.uint64) * (TURN if h == 0 else np.uint64(0xC2B2AE3D27D4EB4F))
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it isn't held; no key is -1."""
        out = np.full(len(keys), -1, np.int64)
        for h, (held, at) in enumerate(self.tables):
            slot = self._slot(keys, h)
            hit = held[slot] == keys
            out[hit] = at[slot[hit]]
        return out


@dataclass
class _Reader:
    """Turns texts into bigrams of names."""

    names: dict[str, int]
    known: np.ndarray | None = None  # words not in it, if given, are one class

    def _named(self, met: list[str]) -> np.ndarray:
        """Short names, and hashes of all other words."""
        ids = np.fromiter(map(self.names.get, met, repeat(-1)), np.int64, len(met))
        rest = np.flatnonzero(ids < 0)
        other = np.array([met[i] for i in rest.tolist()], object)
        ids[rest] = word_hashes(other)
        for i, word in zip(rest.tolist(), other):
            if len(word) >= LONG_WORD:
                ids[i] = self.names.get(_held(word), ids[i])
        return ids

    def bigrams(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first, second) of every bigram of some texts, in their order."""
        met: list[str] = []
        parts, ends, size = [], [], 0
        for t in texts:
            own = words(t.as_py())
            met += own
            size += len(own)
            ends.append(size)
            if len(met) >= CACHE:
                parts.append(self._named(met))
                met = []
        ids = np.concatenate([*parts, self._named(met)])
        if self.known is not None:
            ids[~np.isin(ids, self.known)] = OTHER
        ids = np.append(MARK, np.insert(ids, ends, MARK))
        return np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0) + 1), ids[:-1], ids[1:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def _short_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first * SHORT + second


def _short_names(docs: DataFrame) -> dict[str, int]:
    """Names of at most ``SHORT`` words that are frequent in a sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told() -> pa.RecordBatch:
            return _batch(word=pa.array([_held(w) for w in held], pa.string()), n=np.fromiter(held.values(), np.int64, len(held)))

        for batch in batches:
            for t in batch.column(0):
                held.update(words(t.as_py()))
                if len(held) >= CACHE:
                    yield told()
                    held.clear()
        yield told()

    counted = docs.select("text").sample(SAMPLE, 1).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = counted.where("n > 1").orderBy(F.desc("n"), "word").limit(SHORT - 1).select("word").toArrow()
    return {word: i for i, word in enumerate(found.column("word").to_pylist(), MARK + 1)}


def _frequent_bigrams(docs: DataFrame, reader: _Reader) -> np.ndarray:
    """Keys of at most ``FREQUENT`` bigrams of short names that are frequent in
    a sample, the most frequent first."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            _, first, second = reader.bigrams(block.column(0))
            both = (first >= 0) & (second >= 0)
            key, n = np.unique(_short_key(first[both], second[both]), return_counts=True)
            yield _batch(key=key, n=n.astype(np.int64))

    counted = docs.select("text").sample(SAMPLE, 1).mapInArrow(explode, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    found = counted.where("n > 1").orderBy(F.desc("n"), "key").limit(FREQUENT).select("key").toArrow()
    return found.column("key").to_numpy().astype(np.int64)


def _counted(docs: DataFrame, reader: _Reader, frequent: np.ndarray) -> DataFrame:
    """(word, key, n): how often every word occurs, one mark a row included, and
    every frequent bigram; of word and key one is null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(frequent)
        short, pairs = np.zeros(SHORT, np.int64), np.zeros(len(frequent), np.int64)
        for block in _blocks(batches):
            _, first, second = reader.bigrams(block.column(0))
            long = first < 0
            word, n = np.unique(first[long], return_counts=True)
            yield _batch(word=word, key=pa.nulls(len(word), pa.int64()), n=n.astype(np.int64))
            both = ~long & (second >= 0)
            at = index.find(_short_key(first[both], second[both]))
            np.add.at(pairs, at[at >= 0], 1)
            np.add.at(short, first[~long], 1)
        word, at = np.flatnonzero(short), np.flatnonzero(pairs)
        yield _batch(word=word, key=pa.nulls(len(word), pa.int64()), n=short[word])
        yield _batch(word=pa.nulls(len(at), pa.int64()), key=frequent[at], n=pairs[at])

    rows = docs.select("text").mapInArrow(count, "word bigint, key bigint, n bigint")
    return rows.groupBy("word", "key").agg(F.sum("n").alias("n"))


@dataclass
class _Model:
    """Counts of the words with short names and of the frequent bigrams."""

    count: np.ndarray  # of each short name
    frequent: np.ndarray
    total: np.ndarray  # of each frequent bigram
    everything: float
    backoff: float

    def shared(self, n: np.ndarray) -> np.ndarray:
        """Scores of words that are backed off to, by their counts."""
        return np.log10(self.backoff * n / self.everything)


def _explode(docs: DataFrame, reader: _Reader, model: _Model) -> DataFrame:
    """One row for each of a document's bigrams that isn't frequent, and one
    with the score of those that are and, as if they backed off, of the others
    that end in a short name."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(model.frequent)
        for block in _blocks(batches):
            ids = block.column("doc_id")
            row, first, second = reader.bigrams(block.column("text"))
            n_words = np.bincount(row, minlength=len(ids)) - 1
            _, at, n = np.unique(
                (first.view(np.uint64) * TURN + second.view(np.uint64)) * TURN + row.astype(np.uint64), return_index=True, return_counts=True)
            order = np.argsort(at)  # documents together
            at, n = at[order], n[order]
            row, first, second = row[at], first[at], second[at]
            both = (first >= 0) & (second >= 0)
            key = np.where(both, _short_key(first, second), np.where(first < 0, first, second))
            place = np.where(both, index.find(key), -1)
            here = place >= 0
            other = np.zeros(len(n), np.int64)
            other[here] = model.total[place[here]] - n[here]
            told = second >= 0
            back = (other == 0)[told]
            score = model.shared(model.count[second[told]])
            score[~back] = np.log10(other[told][~back] / model.count[first[told][~back]])
            yield _batch(
                doc_id=ids, key=LAST_KEY + np.arange(len(ids)) + len(ids) * n_words, kind=np.full(len(ids), SCORED),
                rest=np.bincount(row[told], back * n[told], len(ids)).astype(np.int64), n=n_words,
                log_score=np.bincount(row[told], score * n[told], len(ids)).astype(float))
            row, first, second, n, key, both = (c[~here] for c in (row, first, second, n, key, both))
            yield _batch(
                doc_id=ids.take(pa.array(row)), key=key, kind=np.where(both, BOTH_SHORT, np.where(first < 0, FIRST_LONG, SECOND_LONG)),
                rest=np.where(both, 0, np.where(first < 0, second, first)), n=n, log_score=pa.nulls(len(n), pa.float64()))

    return docs.select("doc_id", "text").mapInArrow(explode, EXPLODED)


def _scores(rows: pa.Table, model: _Model, told: bool = False) -> pa.RecordBatch:
    """The rows of some keys, all of each key, in the order of key. If ``told``,
    what ``_explode`` has scored is taken off, and rows it has settled are left out."""
    long, last = np.searchsorted(rows.column("key").to_numpy(), [0, LAST_KEY])
    key, kind, rest, n = (rows.column(c).to_numpy()[:last] for c in ("key", "kind", "rest", "n"))
    # two short names have the key to themselves
    order = np.append(np.lexsort((rest[:long], kind[:long], key[:long])), np.arange(long, last))
    kind, rest, n = kind[order], rest[order], n[order]
    n_back, score = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows)
    n_back[last:], score[last:] = rows.column("rest").to_numpy()[last:], rows.column("log_score").to_numpy()[last:]
    unknown, left = np.zeros(rows.num_rows, bool), np.ones(rows.num_rows, bool)
    if last:
        new_key = np.append(True, key[1:] != key[:-1])
        new = new_key | np.append(True, (kind[1:] != kind[:-1]) | (rest[1:] != rest[:-1]))
        total = np.add.reduceat(n, np.flatnonzero(new))[np.cumsum(new) - 1]
        # how often the long word of the key occurs
        own = np.add.reduceat(np.where(kind == FIRST_LONG, n, 0), np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
        short = lambda word: model.count[np.maximum(word, 0)]
        first = np.where(kind == BOTH_SHORT, short(key // SHORT), np.where(kind == FIRST_LONG, own, short(rest)))
        second = np.where(kind == BOTH_SHORT, short(key % SHORT), np.where(kind == FIRST_LONG, short(rest), own))
        other = total - n
        back = other == 0
        unknown[:last] = back & (kind == FIRST_LONG) & (rest < 0)
        n_back[:last] = np.where(back, n, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            score[:last] = np.where(back, model.shared(second), np.log10(np.maximum(other, 1) / first)) * n
        score[unknown] = 0
        if told:
            ends_short = (kind == BOTH_SHORT) | (kind == FIRST_LONG) & (rest >= 0)
            left[:last] = ~(ends_short & back)
            taken = np.flatnonzero(ends_short & ~back)
            n_back[taken] = -n[taken]
            score[taken] -= model.shared(second[taken]) * n[taken]
    doc_id = rows.column("doc_id").combine_chunks()
    scored = np.arange(rows.num_rows) >= last
    return _batch(
        doc_id=doc_id.take(pa.array(np.append(order, np.arange(last, rows.num_rows))[left])),
        word=pa.array(np.append(rest, np.zeros(rows.num_rows - last, np.int64))[left], mask=~unknown[left]),
        n_words=np.where(scored, rows.column("n").to_numpy(), 0)[left], rows=scored[left].astype(np.int64), n_backoff=n_back[left], log_score=score[left])


def _found(exploded: DataFrame, model: _Model) -> DataFrame:
    """Scores of documents: a row for each that ``_explode`` has begun, and one
    for each bigram that it hasn't settled."""

    def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            begin = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if held and held[-1].column("key")[-1].as_py() == key[-1]:
                held.append(batch)
                continue
            held.append(batch.slice(0, begin))
            whole = pa.Table.from_batches(held)
            held = [batch.slice(begin)]
            if whole.num_rows:
                yield whole
        if held:
            yield pa.Table.from_batches(held)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_keys(batches):
            yield _scores(rows, model, told=True)

    # by one number, which Spark sorts by its digits
    placed = exploded.repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(score, "doc_id bigint, word bigint, n_words bigint, rows bigint, n_backoff bigint, log_score double")


def _looked_up(exploded: DataFrame, model: _Model) -> DataFrame:
    """Sums of each document's scores; a backed off bigram of two long names
    has the second as ``word``, whose share is still to be added."""
    return _summed(_found(exploded, model), "doc_id", "word")


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def _frequent(docs: DataFrame, reader: _Reader, rare: float) -> np.ndarray:
    """Names of the words that make up at least ``rare`` of all: at most 1 / rare."""
    counted, at = stage_at(_counted(docs, reader, np.array([], np.int64)).where(F.col("word") != MARK), "word-counts")
    n_words = counted.agg(F.sum("n")).first()[0] or 0
    known = counted.where(F.col("n") >= rare * n_words).select("word").toArrow().column("word").to_numpy().astype(np.int64)
    unstage(docs.sparkSession, at)
    return known


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: float = 0.0, backoff: float = BACKOFF) -> DataFrame:
    """One row per id: doc_id, n_words, n_backoff (bigrams that backed off, the
    one with the end mark included), log_score (sum of the base-10 logarithms
    of all bigrams' scores) and word_score (its mean).

    Rows that share an id, null among them, are added up; "the document's own"
    are the counts of each row. Null and empty texts have the bigram of the two
    marks alone. Very long texts are read whole. An empty table gives no rows.
    Every word counts as itself, unless ``rare`` is given: words under that
    share of all are then one class.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    reader = _Reader(_short_names(texts))
    if rare:
        reader = _Reader(reader.names, _frequent(texts, reader, rare))
    frequent = _frequent_bigrams(texts, reader)
    counted, counted_at = stage_at(_counted(texts, reader, frequent), "counts")
    everything = float(counted.where("word is not null").agg(F.sum("n")).first()[0] or 0)
    # at most SHORT and FREQUENT rows
    short = counted.where("word >= 0").select("word", "n").toArrow()
    pairs = counted.where("key is not null").select("key", "n").toArrow()
    count = np.zeros(SHORT, np.int64)
    count[short.column("word").to_numpy()] = short.column("n").to_numpy()
    total = np.zeros(len(frequent), np.int64)
    by_key = np.argsort(frequent)
    total[by_key[np.searchsorted(frequent, pairs.column("key").to_numpy(), sorter=by_key)]] = pairs.column("n").to_numpy()
    model = _Model(count, frequent, total, everything, backoff)
    found, found_at = stage_at(_looked_up(_explode(texts, reader, model), model), "bigram-scores")
    long = counted.where("word < 0").select("word", F.col("n").alias("count"))
    back = found.where("word is not null").join(long.hint("merge"), "word").withColumn(
        "log_score", F.col("n_backoff") * F.log10(F.lit(backoff) * F.col("count") / F.lit(everything)))
    done = stage(_summed(found.where("word is null").unionByName(back.drop("count")).drop("word"), "doc_id"), "document-scores")
    unstage(spark, counted_at)
    unstage(spark, found_at)
    return done.select(
        "doc_id", "n_words", "n_backoff", "log_score", (F.col("log_score") / (F.col("n_words") + F.col("rows"))).alias("word_score"))
