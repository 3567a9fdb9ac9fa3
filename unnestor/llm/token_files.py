"""Token ids in patched frame-of-reference files.

Documents are range partitioned by id and encoded; each task writes its ids as
segments, one row each of a Parquet table, whose bytes are the format below.
The format cuts a segment's ids into blocks of ``BLOCK``: the block's minimum
is subtracted and the rest packed at the width that ``SHARE`` of them need;
wider values are exceptions. All numbers are little-endian.

    "PFR1", u32 documents, u64 ids, u64 ids before it in its partition, u32 blocks, u32 exceptions
    per document: i64 id, u8 is it null?, u64 ids
    per block:    u32 minimum, u8 width, u32 place of its packed values, u32 exceptions before it
    exceptions:   u8 place in the block, u32 value less the minimum
    packed values, from the lowest bit on, a block padded to ``BLOCK`` values
"""

from __future__ import annotations

import gc
import re
import struct
import sys
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, partitions

BLOCK = 128
SHARE = 0.9
SEGMENT = 1 << 20  # ids after which a segment is written
CACHE = 1_500_000  # pieces of texts whose ids a Python worker keeps
JOINED = 256  # texts whose ids are put together at once
END = 2  # the id that ends a document

MAGIC = b"PFR1"
HEAD = "<4sIQQII"
DOCS = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u8")])
BLOCKS = np.dtype([("low", "<u4"), ("width", "u1"), ("at", "<u4"), ("patches", "<u4")])
PATCHES = np.dtype([("place", "u1"), ("value", "<u4")])

SCHEMA = "part int, seq int, n_docs bigint, n_ids bigint, data binary"


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values at ``width`` bits each."""
    word = 2 if width <= 16 else 4
    bits = np.unpackbits(values.astype(f"<u{word}").view(np.uint8).reshape(*values.shape, word), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(len(values), -1), axis=1, bitorder="little")


def _unpack(data: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values from ``width`` bits each, of the bytes that a value may lie in."""
    begin = np.arange(BLOCK) * width
    data = np.pad(data, ((0, 0), (0, 4)))
    kind = np.uint32 if width <= 25 else np.uint64
    values = np.zeros((len(data), BLOCK), kind)
    for i in range((width + 14) // 8):
        values |= data[:, begin // 8 + i].astype(kind) << kind(8 * i)
    return (values >> (begin % 8).astype(kind) & kind((1 << width) - 1)).astype(np.uint32)


def write_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, before: int) -> bytes:
    """The bytes of a segment: ``ids`` of documents with ``counts`` ids each."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    values = np.zeros((n_blocks, BLOCK), np.uint32)
    if n:
        flat = values.reshape(-1)
        flat[:n], flat[n:] = ids, ids[-1]
    low = values.min(axis=1) if n else np.zeros(0, np.uint32)
    rest = values - low[:, None]
    place = min(BLOCK - 1, int(BLOCK * SHARE))
    share = np.partition(rest, place, axis=1)[:, place] if n else low
    widths = np.searchsorted(np.uint64(1) << np.arange(33, dtype=np.uint64), share.astype(np.uint64), "right").astype(np.int64)
    wide = rest.astype(np.uint64) >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    row, col = np.nonzero(wide)
    patches = np.zeros(len(row), PATCHES)
    patches["place"], patches["value"] = col, rest[row, col]
    rest[row, col] = 0
    sizes = widths * (BLOCK // 8)
    blocks = np.zeros(n_blocks, BLOCKS)
    blocks["low"], blocks["width"] = low, widths
    blocks["at"] = np.cumsum(sizes) - sizes
    in_block = wide.sum(axis=1)
    blocks["patches"] = np.cumsum(in_block) - in_block
    packed = np.zeros(int(sizes.sum()), np.uint8)
    for w in np.unique(widths):
        own = np.flatnonzero(widths == w)
        if w:
            to = blocks["at"][own].astype(np.int64)[:, None] + np.arange(w * (BLOCK // 8))
            packed[to] = _pack(rest[own], int(w))
    docs = np.zeros(len(doc_ids), DOCS)
    docs["id"] = [0 if d is None else d for d in doc_ids]
    docs["null"] = [d is None for d in doc_ids]
    docs["n"] = counts
    head = struct.pack(HEAD, MAGIC, len(docs), n, before, n_blocks, len(patches))
    return b"".join([head, docs.tobytes(), blocks.tobytes(), patches.tobytes(), packed.tobytes()])


def read_segment(data: bytes) -> tuple[np.ndarray, int, np.ndarray]:
    """(documents, ids before the segment in its partition, ids) of a segment."""
    magic, n_docs, n, before, n_blocks, n_patches = struct.unpack_from(HEAD, data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = struct.calcsize(HEAD)
    tables = []
    for kind, count in ((DOCS, n_docs), (BLOCKS, n_blocks), (PATCHES, n_patches)):
        tables.append(np.frombuffer(data, kind, count, at))
        at += kind.itemsize * count
    docs, blocks, patches = tables
    packed = np.frombuffer(data, np.uint8, offset=at)
    values = np.zeros((n_blocks, BLOCK), np.uint32)
    for w in np.unique(blocks["width"]):
        own = np.flatnonzero(blocks["width"] == w)
        if w:
            values[own] = _unpack(packed[blocks["at"][own].astype(np.int64)[:, None] + np.arange(int(w) * (BLOCK // 8))], int(w))
    in_block = np.diff(np.append(blocks["patches"], n_patches).astype(np.int64))
    values[np.repeat(np.arange(n_blocks), in_block), patches["place"]] = patches["value"]
    values += blocks["low"][:, None]
    return docs, before, values.reshape(-1)[:n]


# letters that all versions of Unicode know, and punctuation that ends a word on its own
STEM = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


# the characters that a byte-level model has for bytes that aren't visible in Latin-1
HIDDEN = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}


def _visible_end(piece: str) -> bool:
    return piece[-1:].isprintable() and piece != "" and not piece[-1].isspace()


class Encoder:
    """Ids of texts by a byte-level tokenizer, word by word. Its pattern never
    joins a space to the visible character before it, so the ids of a text are
    those of its pieces between such places; nor does it join letters and the
    punctuation after them, nor, if it is so on trial, a line break between
    these and letters to either. Letters go to the tokenizer's model at once,
    which takes them as they are. Pieces recur, so their ids are kept. Texts
    that hold an added token, such as <|endoftext|>, are encoded whole."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # whatever the case and the form, as added tokens may be matched after normalization
        self.added = re.compile("|".join(map(re.escape, added)), re.I) if added else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # bytes of each id: a token has a character for each
        self.width = np.zeros(max([*vocabulary.values(), *self.tokenizer.get_added_tokens_decoder()], default=0) + 1, np.int64)
        self.width[list(vocabulary.values())] = list(map(len, vocabulary))
        self.width[list(self.tokenizer.get_added_tokens_decoder())] = 0
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(" a.\nB\nc d") if self.tokenizer.pre_tokenizer else []
        self.by_line = [at for _, at in cut] == [(0, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 9)]
        trial = ["the", "Über", "naïve", "ɏAble", "Thoughts"]
        self.by_word = self.tokenizer.normalizer is None and all(
            self._word_ids(trial, mark) == self._ids([mark + w for w in trial]) for mark in ("", " "))
        self.line = self._ids(["\n"])[0]
        self.later: dict[str, bytes] = {}  # of pieces after a space
        self.older: dict[str, bytes] = {}  # of those met before ``later`` was begun
        self.lines: dict[str, bytes] = {}  # of letters after a line break, the break's among them
        self.tails: dict[str, bytes] = {"": b""}
        self.first: dict[str, bytes] = {"": b""}  # of pieces that begin a text

    def _ids(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _word_ids(self, found: list[str], mark: str = "") -> list[bytes]:
        """Ids of letters, after the mark, by the model itself."""
        tokenize, ids, cuts = self.tokenizer.model.tokenize, [], [0]
        mark = mark.translate(HIDDEN)
        for w in found:
            ids += [t.id for t in tokenize(mark + (w if w.isascii() else w.encode().decode("latin-1").translate(HIDDEN)))]
            cuts.append(4 * len(ids))
        raw = np.array(ids, "<u4").tobytes()
        return [raw[x:y] for x, y in zip(cuts, cuts[1:])]

    def _learn_after(self, mark: str, pieces: list[str], held: dict[str, bytes]) -> None:
        """Ids of pieces after a mark, the mark's among them, many in one text,
        in which the bytes of the ids tell where a piece ends."""
        for i in range(0, len(pieces), 4096):
            part = [f"{mark}{p}" for p in pieces[i : i + 4096]]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, "<u4")
            places = np.append(0, np.cumsum(self.width[ids]))
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, part)), np.int64, len(part)))
            at = np.searchsorted(places, ends)
            if at[-1] != len(ids) or (places[at] != ends).any():
                held.update(zip(pieces[i : i + 4096], self._ids(part)))
                continue
            raw, cuts = ids.tobytes(), [0, *(4 * at).tolist()]
            held.update(zip(pieces[i : i + 4096], [raw[x:y] for x, y in zip(cuts, cuts[1:])]))

    def _spaced_ids(self, pieces: list[str]) -> None:
        """Ids of pieces after a space, kept in ``later``; either all are letters alone or none."""
        if self.by_word and pieces and STEM.fullmatch(pieces[0]):
            self.later.update(zip(pieces, self._word_ids(pieces, " ")))
        else:
            self._learn_after(" ", pieces, self.later)

    def _unmet(self, pieces: list[str]) -> list[str]:
        """The pieces that aren't in ``later``, to which those that were met before are brought."""
        new = []
        for p in pieces:
            if (i := self.older.get(p)) is not None:
                self.later[p] = i
            elif p not in self.later:
                new.append(p)
        return new

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pieces after a space, kept in ``later``; those that end in
        white space, to whose last word the next space may belong, are left out."""
        # strings alone: millions of small tuples would keep the garbage collector busy
        found = list(map(STEM.fullmatch, pieces))
        alone = [p for p, m in zip(pieces, found) if m and not m[2]]
        tailed = [m for m in found if m and m[2]]
        rest = list(filter(_visible_end, (p for p, m in zip(pieces, found) if not m)))
        broken = []
        if self.by_line:
            cut = [(p, list(map(STEM.fullmatch, p.split("\n")))) for p in rest if "\n" in p]
            broken = [(p, parts) for p, parts in cut if all(parts)]
            rest = list(set(rest).difference([p for p, _ in broken]))
        stems = [m[1] for m in tailed]
        spaced = alone + self._unmet(list({*stems, *(parts[0][1] for _, parts in broken)}.difference(alone)))
        after = [w for w in {m[1] for _, parts in broken for m in parts[1:]} if w not in self.lines]
        self._spaced_ids(spaced)
        if self.by_word:
            self.lines.update(zip(after, [self.line + i for i in self._word_ids(after)]))
        else:
            self._learn_after("\n", after, self.lines)
        tails = [m[2] for m in tailed]
        ends = [t for t in {*tails, *(m[2] for _, parts in broken for m in parts)} if t not in self.tails]
        self.tails.update(zip(ends, self._ids(ends)))
        self.later.update(zip([m[0] for m in tailed], map(bytes.__add__, map(self.later.__getitem__, stems), map(self.tails.__getitem__, tails))))
        for p, (first, *others) in broken:
            self.later[p] = b"".join([self.later[first[1]], self.tails[first[2]], *(x for m in others for x in (self.lines[m[1]], self.tails[m[2]]))])
        self._spaced_ids([p for p in rest if "\0" not in p])
        zeros = [p for p in rest if "\0" in p]
        self.later.update(zip(zeros, self._ids([f" {p}" for p in zeros])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of unsigned 32-bit numbers."""
        whole = np.array([bool(self.added and self.added.search(t)) for t in texts])
        split = pc.split_pattern(pa.array(["" if w else t for t, w in zip(texts, whole)], pa.large_string()), " ")
        ends = split.offsets.to_numpy()
        begins, ends = ends[:-1], ends[1:]
        coded = split.values.dictionary_encode()
        codes, pieces = coded.indices.to_numpy().copy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        heads = codes[begins]
        codes[begins] = -1
        ids = list(map(self.later.get, pieces))
        used = np.bincount(codes[codes >= 0], minlength=len(pieces)) > 0
        new = [k for k in np.flatnonzero(used).tolist() if ids[k] is None and pieces[k]]
        if len(self.later) + len(self.lines) + len(self.tails) + len(self.first) + 2 * len(new) > CACHE // 2:  # a piece's letters are kept as well
            self.older, self.later = self.later, {p: i for p, i in zip(pieces, ids) if i is not None}
            self.lines, self.tails, self.first = {}, {"": b""}, {"": b""}
        self._learn(self._unmet([pieces[k] for k in new]))
        for k in new:
            ids[k] = self.later.get(pieces[k])
        # first pieces have no space before them
        opening = [p for k in np.unique(heads).tolist() if (p := pieces[k]) not in self.first and _visible_end(p)]
        self.first.update(zip(opening, self._ids(opening)))
        codes[begins] = len(ids) + np.arange(len(texts))
        ids += [self.first.get(pieces[k]) for k in heads.tolist()]
        unsafe = np.append(0, np.cumsum(np.array([i is None for i in ids])[codes]))
        slow = whole | (unsafe[ends] > unsafe[begins]) | (ends - begins < 2)
        known = [i or b"" for i in ids]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts, kept = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(known), "<u4")
        out: list[bytes] = []
        for a in range(0, len(texts), JOINED):
            here = codes[begins[a] : ends[min(a + JOINED, len(texts)) - 1]]
            n = sizes[here]
            to = np.append(0, np.cumsum(n))
            raw = kept[np.repeat(starts[here] - to[:-1], n) + np.arange(to[-1])].tobytes()
            at = (4 * to[np.append(begins[a : a + JOINED], ends[a : a + JOINED][-1]) - begins[a]]).tolist()
            out += [raw[x:y] for x, y in zip(at, at[1:])]
        slow = np.flatnonzero(slow).tolist()
        for i, found in zip(slow, self._ids([texts[i] for i in slow])):
            out[i] = found
        return out


def worker_encoder(tokenizer_file: str) -> Encoder:
    """The encoder that all tasks of a Python worker share."""
    store = sys.modules.setdefault("_token_encoders", ModuleType("_token_encoders")).__dict__
    if tokenizer_file not in store:
        store[tokenizer_file] = Encoder(tokenizer_file)
        gc.freeze()
    return store[tokenizer_file]


def write(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> None:
    """Write the ids of all documents to ``path`` in ascending order of the id
    (null first; equal ids by the hash of the text). Null texts are empty, so
    an empty text has the end id alone. The tokenizer's file must lie at the
    same place on every executor. An empty table writes no segments."""
    spark = docs.sparkSession

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq, before = worker_encoder(tokenizer_file), TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        size, last = 0, struct.pack("<I", end)

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            data = write_segment(doc_ids, [len(h) // 4 for h in held], ids, before)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "n_docs": len(doc_ids), "n_ids": len(ids), "data": data}], schema=kind)

        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for i in range(0, len(texts), 2048):
                for d, own in zip(ids[i : i + 2048], encoder.encode(texts[i : i + 2048])):
                    doc_ids.append(d)
                    held.append(own + last)
                    size += len(own) // 4 + 1
                    if size >= SEGMENT:
                        yield segment()
                        seq, before = seq + 1, before + size
                        doc_ids, held, size = [], [], 0
        if doc_ids:
            yield segment()

    kind = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("tie"), F.monotonically_increasing_id().alias("row"),
    )
    order = ["doc_id", "tie", "row"]
    ranged = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ranged.select("doc_id", "text").mapInArrow(segments, SCHEMA).write.mode("errorifexists").option("compression", "none").parquet(path)


def read(spark, path: str) -> DataFrame:
    """One row per document of the files at ``path``: doc_id, start (ids of all
    documents before it), n_tokens and ids_crc32 (of its ids as little-endian
    unsigned 32-bit numbers)."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    # one row per partition that wrote
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("before"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, offset in zip(batch.column("data"), batch.column("before").to_pylist()):
                docs, inside, ids = read_segment(data.as_py())
                ends = np.cumsum(docs["n"].astype(np.int64))
                begins = ends - docs["n"].astype(np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs["id"], mask=docs["null"].astype(bool)), pa.array(begins + inside + offset, pa.int64()),
                    pa.array(docs["n"].astype(np.int64)), pa.array(sums, pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = attach(stored.select("part", "data"), starts, ["part"]).select("data", "before")
    return placed.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
