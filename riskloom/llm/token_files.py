"""Token-ID files of patched frame-of-reference blocks.

``write_token_files`` encodes whole texts, appends an end id, and writes one file
per range of document ids, in ascending order; ``read_token_files`` reads them.
Files go through Spark's own committed writer (a segment is one record of a text
file, ended by one newline byte), so any Hadoop file system serves and a lost task
leaves nothing behind; size files by the number of shuffle partitions.

Segment (little-endian): magic, documents, ids, blocks, body bytes, continued flag
(its first document began in the segment before); then document ids (int64), null
flags (u8), ids per document (u32), block starts (u32 each, relative to the first block),
then the blocks. A block holds 1024 ids as offsets from its minimum: minimum (u32),
width (u8), exceptions (u16), 32*width words of packed low bits (value 32*r + c in
lane c at bit r*width), then the exceptions' places (u16) and high bits (u32). The
width is the cheapest of those that hold all or a percentile of the offsets.
"""
from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, slices
from .textscan import LOWER
from .wordtable import WordTable

MAGIC = 0x4B544C52
HEAD = struct.Struct("<IIIIIB")
BLOCK_HEAD = struct.Struct("<IBH")
BLOCK = 1024
#: shares of a block's offsets that the packed width may hold
PERCENTILES = (1.0, 0.99, 0.97, 0.94, 0.9)
BITS16 = np.array([int(i).bit_length() for i in range(1 << 16)], np.uint8)


def bit_lengths(v: np.ndarray) -> np.ndarray:
    high = (v >> np.uint32(16)).astype(np.uint16)
    return np.where(high > 0, BITS16[high] + np.uint8(16), BITS16[(v & np.uint32(0xFFFF)).astype(np.uint16)])


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of 1024 ids (the last is filled up with its minimum)."""
    n = -(-len(ids) // BLOCK)
    padded = np.empty(n * BLOCK, np.uint32)
    padded[: len(ids)] = ids
    padded[len(ids):] = ids[(n - 1) * BLOCK:].min() if n else 0
    v = padded.reshape(n, BLOCK)
    low = v.min(axis=1)
    v = v - low[:, None]
    bits = bit_lengths(v)
    counts = np.bincount((np.arange(n)[:, None] * 33 + bits).ravel(), minlength=33 * n).reshape(n, 33)
    held = np.cumsum(counts, axis=1)                      # offsets of at most that many bits
    width = np.zeros(n, np.int64)
    best = np.full(n, np.iinfo(np.int64).max)
    for p in PERCENTILES:
        w = (held >= p * BLOCK).argmax(axis=1)
        cost = 128 * w + 6 * (BLOCK - held[np.arange(n), w])
        width, best = np.where(cost < best, w, width), np.minimum(cost, best)
    out: list[bytes] = [b""] * n
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        lanes = (v[rows] & np.uint32((1 << int(w)) - 1)).reshape(-1, 32, 32)
        words = np.zeros((len(rows), int(w), 32), np.uint32)
        for r in range(32 if w else 0):
            k, s = divmod(r * int(w), 32)
            words[:, k] |= lanes[:, r] << np.uint32(s)
            if s + w > 32:
                words[:, k + 1] |= lanes[:, r] >> np.uint32(32 - s)
        row, place = np.nonzero(bits[rows] > w)
        high = (v[rows][row, place] >> np.uint32(w)).astype("<u4") if w < 32 else np.empty(0, "<u4")
        cuts = np.searchsorted(row, np.arange(len(rows) + 1))
        place = place.astype("<u2")
        for i, b in enumerate(rows):
            a, z = cuts[i], cuts[i + 1]
            out[b] = BLOCK_HEAD.pack(int(low[b]), int(w), z - a) + words[i].astype("<u4").tobytes() + place[a:z].tobytes() + high[a:z].tobytes()
    return out


def unpack_blocks(data: bytes, starts: np.ndarray, n_ids: int) -> np.ndarray:
    """Ids of the blocks that start at ``starts`` in ``data``; any run of blocks can be read alone."""
    n = len(starts)
    heads = [BLOCK_HEAD.unpack_from(data, s) for s in starts]
    out = np.empty((n, BLOCK), np.uint32)
    width = np.array([h[1] for h in heads], np.int64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        size = 128 * int(w)
        v = np.zeros((len(rows), 32, 32), np.uint32)
        if w:
            words = np.frombuffer(b"".join(data[starts[b] + BLOCK_HEAD.size: starts[b] + BLOCK_HEAD.size + size] for b in rows), "<u4").reshape(-1, int(w), 32)
            mask = np.uint32((1 << int(w)) - 1)
            for r in range(32):
                k, s = divmod(r * int(w), 32)
                part = words[:, k] >> np.uint32(s)
                if s + w > 32:
                    part = part | (words[:, k + 1] << np.uint32(32 - s))
                v[:, r] = part & mask
        v = v.reshape(-1, BLOCK)
        for i, b in enumerate(rows):
            low, _, extra = heads[b]
            if extra:
                at = int(starts[b]) + BLOCK_HEAD.size + size
                place = np.frombuffer(data, "<u2", extra, at)
                v[i, place] |= np.frombuffer(data, "<u4", extra, at + 2 * extra) << np.uint32(w)
            v[i] += np.uint32(low)
        out[rows] = v
    return out.ravel()[:n_ids]


def segment(doc_ids: list[int | None], lens: list[int], ids: np.ndarray, continued: bool) -> bytes:
    blocks = pack_blocks(ids)
    starts = np.concatenate(([0], np.cumsum([len(b) for b in blocks])[:-1])).astype("<u4") if blocks else np.empty(0, "<u4")
    body = b"".join([
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array(lens, "<u4").tobytes(), starts.tobytes(), *blocks])
    return HEAD.pack(MAGIC, len(doc_ids), len(ids), len(blocks), len(body), continued) + body


def read_segments(data: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray, bool]]:
    """(document ids, ids per document, ids, continued) of each segment of a file."""
    at = 0
    while at < len(data):
        magic, docs, n_ids, blocks, size, continued = HEAD.unpack_from(data, at)
        if magic != MAGIC or data[at + HEAD.size + size: at + HEAD.size + size + 1] != b"\n":
            raise ValueError(f"not a token segment at byte {at}")
        p = at + HEAD.size
        doc_ids = np.frombuffer(data, "<i8", docs, p)
        null = np.frombuffer(data, np.uint8, docs, p + 8 * docs)
        lens = np.frombuffer(data, "<u4", docs, p + 9 * docs)
        starts = np.frombuffer(data, "<u4", blocks, p + 13 * docs).astype(np.int64) + p + 13 * docs + 4 * blocks
        yield [None if z else int(d) for d, z in zip(doc_ids, null)], lens, unpack_blocks(data, starts, n_ids), bool(continued)
        at = p + size + 1


#: a word of Latin-1 letters and marks after it: one pre-token of the word BPE each
LETTERS_MARKS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:%&#$*()|]*)")


class TextEncoder:
    """Ids of whole texts by a tokenizers file.

    With ``by_piece`` the tokenizer must split at white space, drop it and lower-case (as the word BPE does):
    a text's ids are then those of its pieces between spaces and line feeds in a row, and only
    pieces not seen before are encoded. Texts with special-token strings are encoded whole.
    """

    def __init__(self, path: str, by_piece: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_piece, self.table = Tokenizer.from_file(path), by_piece, WordTable(self._encode_words)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of pieces; words of letters, and those with marks after them, many in one call, cut at word ends."""
        out: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
        plain = [(i, m[2] != "") for i, m in enumerate(map(LETTERS_MARKS.fullmatch, words)) if m]
        for at in range(0, len(plain), 2000):
            group = plain[at: at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words[i] for i, _ in group)], add_special_tokens=False)[0].ids, np.int32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            tokens = np.cumsum([1 + marks for _, marks in group])
            if len(cuts) != tokens[-1]:  # not a vocabulary with word ends
                continue
            for (i, _), part in zip(group, np.split(ids, cuts[tokens[:-1] - 1])):
                out[i] = part
        rest = [i for i, o in enumerate(out) if o is None]
        for i, ids in zip(rest, self._encode([words[i] for i in rest])):
            out[i] = ids
        return out

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of each text in order; a null text is empty."""
        for at, data, bounds in slices(texts, 1 << 20):
            if not self.by_piece:
                raw = data.tobytes()
                yield from enumerate(self._encode([raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:])]), at)
                continue
            gap = (data == 32) | (data == 10)
            change = np.zeros(len(data) + 1, bool)
            change[1:-1] = gap[1:] != gap[:-1]
            change[bounds] = True
            starts = np.flatnonzero(change[:-1])
            sizes = np.diff(np.append(starts, len(data)))
            ids, ends = self.table(data, starts, sizes, LOWER)
            cuts = ends[np.searchsorted(starts, bounds)]
            open_mark = (data[:-1] == 60) & (data[1:] == 124)  # "<|" of special tokens
            special = np.diff(np.concatenate(([0], np.cumsum(open_mark), [open_mark.sum()]))[np.minimum(bounds, len(data))]) > 0
            for i in range(len(bounds) - 1):
                if special[i]:
                    yield at + i, self._encode([data[bounds[i]: bounds[i + 1]].tobytes().decode()])[0]
                else:
                    yield at + i, ids[cuts[i]: cuts[i + 1]]


@cache
def text_encoder(path: str, by_piece: bool) -> TextEncoder:
    """One encoder, with the words it has seen, for all tasks of a Python worker."""
    return TextEncoder(path, by_piece)


def _segments(path: str, end_id: int, by_piece: bool, seg_ids: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(path, by_piece)
        end = np.array([end_id], np.int32)
        docs: list[int | None] = []
        lens: list[int] = []
        parts: list[np.ndarray] = []
        held, continued = 0, False

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([segment(docs, lens, np.concatenate(parts).astype(np.uint32), continued)], pa.binary())], names=["segment"])

        for b in batches:
            names = b.column(0).to_pylist()
            for row, ids in encode(b.column(1)):
                ids = np.concatenate([ids, end])
                at = 0
                while at < len(ids):  # a long document goes on in the next segment
                    take = min(len(ids) - at, seg_ids - held)
                    docs.append(names[row])
                    lens.append(take)
                    parts.append(ids[at: at + take])
                    held += take
                    at += take
                    if held == seg_ids:
                        yield flush()
                        docs, lens, parts, held, continued = [], [], [], 0, at < len(ids)
        if docs:
            yield flush()
    return fn


def write_token_files(docs: DataFrame, out: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                      by_piece: bool = True, seg_ids: int = 1 << 18) -> None:
    """Write the ids of every row's text and an end id to ``out``, in ascending id order (nulls first).

    A null text is empty (its end id alone); rows of one id follow each other in the order of
    their texts; an empty table writes no segments; other columns are ignored.
    ``by_piece`` needs a tokenizer that splits at white space, drops it and lower-cases, as the word BPE does.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    segs = arrow_map(ordered, _segments(tokenizer_path, end_id, by_piece, seg_ids), "segment binary")
    segs.select(F.col("segment").cast("string").alias("value")).write.option("compression", "none").text(out)


def read_token_files(spark: SparkSession, path: str, per_document: Callable[[np.ndarray], tuple] | None = None, schema: str = "") -> DataFrame:
    """(file, at, doc_id, start, n_tokens, ids array<int>) per document; ``start`` counts from the file's beginning.

    With ``per_document`` (ids so far, state or None -> state) and ``schema`` of the state, the
    ids are replaced by the state after a document's last id, so long documents are never held whole.
    """
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                found: list[list] = []
                start = 0
                for docs, lens, ids, continued in read_segments(data.as_py()):
                    cuts = np.concatenate(([0], np.cumsum(lens.astype(np.int64))))
                    for i, doc in enumerate(docs):
                        part = ids[cuts[i]: cuts[i + 1]]
                        if continued and i == 0:
                            found[-1][4] += len(part)
                            found[-1][5] = per_document(part, found[-1][5]) if per_document else np.concatenate([found[-1][5], part])
                        else:
                            found.append([name, len(found), doc, start, len(part), per_document(part, None) if per_document else part])
                        start += len(part)
                if found:
                    cols = list(zip(*found))
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), None if per_document else pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["file", "at", "doc_id", "start", "n_tokens", "state"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    out = arrow_map(files, fn, f"file string, at long, doc_id long, start long, n_tokens long, state {schema or 'array<int>'}")
    return out if per_document else out.withColumnRenamed("state", "ids")


def crc_of(ids: np.ndarray, crc: int | None) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes(), crc or 0)
