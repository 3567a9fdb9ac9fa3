"""Phrase collocations by SON partitioning.

Every ``SHARDS``-th partition of the documents belongs to the same shard. A phrase that occurs ``support``
times in all occurs at least ``local_support(support)`` times in one of them,
so mining every shard completely at that support finds every frequent phrase.
Tasks count hashed phrases of their rows, the counts of a shard come together
by hash, and the union of all shards' locally frequent phrases is kept as a
bitmap over the hashes: a superset of the candidates. A second pass over all
texts counts every candidate exactly, by its words.

The bitmap has a fixed greatest size. A larger corpus makes it less selective,
so more phrases are counted exactly; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, partitions, stage_at, unstage

SHARDS = 7
LONGEST = 4  # words of a phrase
CHUNK = 1 << 19  # words that a task counts at a time
SEGMENT = 1 << 22  # bytes of a long text that are cut at a time
MAP_BITS = 27  # of the bitmap: 16 MB
GROUP = 1 << 23  # bytes of text whose phrases meet in one group of hashes
MERGED = 1 << 10  # rows that bring the bitmap to the driver
SALTS = 64

# What ends a piece, and what parts words
_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
END = b"."


def local_support(support: int, shards: int = SHARDS) -> int:
    """Occurrences in one of the shards at least, of a phrase with ``support`` in all."""
    return -(-support // shards)


def _segments(text: bytes) -> Iterator[bytes]:
    """The text with one sign for all piece ends, a long one cut at such a sign."""
    text = text.lower().translate(_ENDS)
    at = 0
    while len(text) - at > SEGMENT:
        cut = text.rfind(END, at, at + SEGMENT)
        cut = text.find(END, at + SEGMENT) if cut < 0 else cut
        if cut < 0:
            break
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:] + END


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of each segment; ``END`` stands between pieces."""
    for part in _segments(text):
        yield part.replace(END, b" . ").split()


class _Ids(dict):
    """Numbers of the words of a chunk, and their hashes; 0 is ``END``."""

    def __init__(self):
        super().__init__({END: 0})
        self.hashes, self.names = [0], [END]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return n


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Ids, np.ndarray, np.ndarray, list[str]]]:
    """(word numbers, words, language number of each word, languages) of about
    ``CHUNK`` words each. Texts end with ``END``."""
    ids, held, langs, names, size = _Ids(), [], [], {}, 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            k = names.setdefault(lang, len(names))
            for part in words(text.as_py() or b""):
                held.append(np.fromiter(map(ids.__getitem__, part), np.int64, len(part)))
                langs.append(np.full(len(part), k, np.int64))
                size += len(part)
                if size >= CHUNK:
                    yield ids, np.concatenate(held), np.concatenate(langs), list(names)
                    ids, held, langs, names, size = _Ids(), [], [], {lang: 0}, 0
                    k = 0
    if held:
        yield ids, np.concatenate(held), np.concatenate(langs), list(names)


def _hashes(ids: _Ids, seq: np.ndarray, lang: np.ndarray, langs: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, hashes) of the phrases of n words, for n from 1 to ``LONGEST``."""
    word = np.array(ids.hashes, np.uint64)[seq]
    seeds = np.array([xxhash.xxh64_intdigest(name, seed=1) for name in langs], np.uint64)[lang]
    inside = seq > 0
    at, h = np.flatnonzero(inside), None
    for n in range(1, LONGEST + 1):
        if n > 1:
            at = at[at + n - 1 < len(seq)]
            at = at[inside[at + n - 1]]
            h = h_all[at]
        else:
            h = seeds[at]
        h = (h ^ word[at + n - 1]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        yield n, at, h
        h_all = np.zeros(len(seq), np.uint64)
        h_all[at] = h


def _locally_frequent(docs: DataFrame, support: int, n_groups: int) -> np.ndarray:
    """The bitmap of the union of what every shard finds frequent. Each task
    serves one shard; hashes are dealt to ``n_groups`` groups by their upper
    bits, and each group has its own stretch of the bitmap."""
    spark = docs.sparkSession
    bits = n_groups.bit_length() - 1
    stretch = MAP_BITS - bits
    least = local_support(support)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % SHARDS
        for chunk in _chunks(batches):
            found, n = np.unique(np.concatenate([h for _, _, h in _hashes(*chunk)]), return_counts=True)
            low = (found >> np.uint64(32 - bits)).astype(np.uint32)
            n = np.minimum(n, 255).astype(np.uint8)
            group, first = np.unique(found >> np.uint64(64 - bits) if bits else np.zeros(len(found), np.uint64), return_index=True)
            cuts = [*first.tolist(), len(found)]
            yield pa.RecordBatch.from_arrays([
                pa.array(group.astype(np.int32)), pa.array(np.full(len(group), shard, np.int32)),
                pa.array([low[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([n[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ], names=["group", "shard", "low", "n"])

    def mine(key: tuple, rows: pa.Table) -> pa.Table:
        found = np.zeros(1 << stretch, bool)
        shards = rows.column("shard").to_numpy()
        for s in np.unique(shards):
            own = rows.filter(pa.array(shards == s))
            low = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in own.column("low")])
            n = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in own.column("n")])
            order = np.argsort(low, kind="stable")
            low = low[order]
            first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
            frequent = np.add.reduceat(n[order], first, dtype=np.int64) >= least
            found[low[first][frequent] >> np.uint32(32 - stretch)] = True
        return pa.table({"group": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(found).tobytes()], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, bytearray] = {}
        for batch in batches:
            for group, found in zip(batch.column("group").to_pylist(), batch.column("bits").to_pylist()):
                own = held.setdefault(group // per, bytearray(per * size))
                own[group % per * size : (group % per + 1) * size] = found
        for part, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bytes(own)], pa.binary())], names=["part", "bits"])

    size, per = 1 << (stretch - 3), -(-n_groups // MERGED)
    counted = docs.mapInArrow(count, "group int, shard int, low binary, n binary")
    mined = counted.groupBy("group").applyInArrow(mine, "group int, bits binary")
    merged = mined.repartition(partitions(spark), F.floor(F.col("group") / per)).mapInArrow(merge, "part int, bits binary")
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for row in merged.collect():  # the bitmap, in at most MERGED rows
        found = np.frombuffer(row["bits"], np.uint8)
        out[row["part"] * per * size :][: len(found)] = found
    return out


def _candidate_counts(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(lang, n_words, phrase, n): occurrences, by task, of the phrases that
    are in the bitmap with all their parts, and with n_words 0 of all words."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, seq, lang, langs in _chunks(batches):
            totals = np.bincount(lang[seq > 0], minlength=len(langs))
            out = [(np.arange(len(langs)), 0, [b""] * len(langs), totals)]
            before = None
            for n, at, h in _hashes(ids, seq, lang, langs):
                bit = (h >> np.uint64(64 - MAP_BITS)).astype(np.int64)
                ok = np.zeros(len(seq) + 1, bool)
                ok[at] = (shared.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1
                if before is not None:  # a frequent phrase has frequent parts
                    ok[:-1] &= before[:-1] & before[1:]
                before = ok
                at = np.flatnonzero(ok)
                if not len(at):
                    break
                # exact: a phrase is its language and the numbers of its words, two in a key
                span = np.int64(len(ids.names))
                keys = [lang[at] * span + seq[at]]
                if n > 1:
                    keys[0] = keys[0] * span + seq[at + 1]
                if n > 2:
                    keys.append(seq[at + 2] * span + (seq[at + 3] if n > 3 else 0))
                order = np.lexsort(keys[::-1])
                keys = [k[order] for k in keys]
                first = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
                here = at[order[first]]
                parts = [seq[here + i].tolist() for i in range(n)]
                names = [b" ".join(map(ids.names.__getitem__, p)) for p in zip(*parts)]
                out.append((lang[here], n, names, np.diff(np.r_[first, len(order)])))
            for k, n, names, counts in out:
                yield pa.RecordBatch.from_arrays([
                    pa.array(langs, pa.string()).take(pa.array(k)), pa.array(np.full(len(k), n, np.int32)), pa.array(names, pa.binary()), pa.array(counts, pa.int64()),
                ], names=["lang", "n_words", "phrase", "n"])

    return docs.mapInArrow(count, "lang string, n_words int, phrase binary, n bigint")


def frequent_phrases(docs: DataFrame, support: int) -> tuple[DataFrame, str]:
    """(lang, n_words, phrase, f), staged: exact counts of all phrases of up to
    ``LONGEST`` words that occur ``support`` times in their language, and with
    n_words 0 the number of its words."""
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_groups = 1
    while n_groups < min(size / GROUP, 1 << (MAP_BITS - 3)):
        n_groups *= 2
    bitmap = _locally_frequent(texts, support, n_groups)
    counts = _candidate_counts(texts, bitmap).groupBy("lang", "n_words", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("f"))
    return stage_at(counts.where((F.col("n_words") == 0) | (F.col("f") >= support)), "frequent")


def collocations(docs: DataFrame, support: int = 30, top: int = 2000, contained: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each
    language by score, a (both falling) and phrase.

    Candidates are phrases of 2 to ``LONGEST`` words with a >= ``support``
    occurrences. Each is scored by its weakest cut, floor(2000000 a / (l + r))
    of the counts of both parts, the shortest first part winning ties. A
    candidate inside a longer one that has at least ``contained`` percent of
    its occurrences is dropped. All counts are exact; sums of products are
    decimals.

    Null texts are empty, a null lang is ``und``; empty texts and texts of
    separators have no words. Rows that repeat count each time, ids aren't
    read, other columns are ignored. A long text is counted whole, in
    segments cut at piece ends. Ties in all but the phrase are in the order
    of its UTF-8 bytes. A language without candidates, and an empty table,
    give no rows.
    """
    spark = docs.sparkSession
    counted, counted_at = frequent_phrases(docs, support)
    phrases = counted.where("n_words > 0").select("lang", "n_words", "phrase", "f")
    found = phrases.where("n_words > 1").select("lang", "n_words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cut = found.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("first"), part(F.col("cut") + 1, F.size("w")).alias("rest"))
    parts = phrases.select("lang", F.col("phrase").alias("part"), "f")
    cut = attach(cut, parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = attach(cut, parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("cast(2000000 * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    scored = cut.select("lang", "phrase", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("s"))
    scored, scored_at = stage_at(scored.groupBy("lang", "phrase", "a").agg(F.min("s").alias("s")).select(
        "lang", "phrase", "a", "s.l", "s.r", "s.score"), "scored")

    inner = found.where("n_words > 2").select(
        "lang", "a", "w", "n_words", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("k"))
    inner = inner.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("k") + 1)).alias("at"))
    inner = inner.groupBy("lang", part(F.col("at"), F.col("k")).alias("phrase")).agg(F.max("a").alias("longer"))
    inner, inner_at = stage_at(inner, "contained")
    kept = scored.join(inner.hint("merge"), ["lang", "phrase"], "left").where(
        F.expr(f"longer is null or 100 * cast(longer as decimal(20,0)) < {int(contained)} * cast(a as decimal(20,0))"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of SALTS parts of a language, then the best of these
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).where(F.col("rank") <= top)
    totals = counted.where("n_words = 0").select("lang", F.col("f").alias("n"))
    result, _ = stage_at(attach(ranked, totals, ["lang"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    for path in (counted_at, scored_at, inner_at):
        unstage(spark, path)
    return result
