"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

Texts are cut into words (a run of word-start marks and what follows up to the next; no piece crosses
that) and at characters that are in no piece. Words not seen before are searched, those of equal length
together: the hash of every substring of up to the longest piece's length probes
the sorted hashes of the pieces, and a vectorised maximum over the starts stores the
back pointer of each end.

The result is the segmentation of the highest total piece score (ties: the earlier start, that is the
longer last piece), with byte pieces for characters that no piece covers. That is
the encoding of a unigram model. A model file of the BPE type is encoded by its library by
merges instead, which is no best path: ``method="merge"`` does that, with the same batches, hashes
and maxima, and gives the library's ids for such a file. Both decode to the same text.

Words of more than ``LONG`` characters (a base64 blob) are searched by themselves in time about linear in their length,
with the same results. Null and empty texts have no ids; an empty table gives an empty result; repeated rows stay.
"""
from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices
from .wordtable import WordTable

MARK = "▁"
#: bytes as they are, for word hashes
SAME = np.arange(256, dtype=np.uint64)
#: characters above which a word is searched by itself, and how many of its starts are probed at once
LONG, WINDOW = 2048, 1 << 16
BASE = np.uint64(0x9E3779B97F4A7C15)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) pairs of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield key >> 3, data[at: at + size]
            at += size


class Pieces:
    """Pieces, scores and white-space rules of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            spec = dict(_fields(next(v for k, v in _fields(f.read()) if k == 3)))
        if spec.get(2) or spec.get(4, 1) or not spec.get(5, 1):
            raise ValueError("the model's normaliser rewrites texts; only the identity with escaped white space is done here")
        self.dummy_prefix = bool(spec.get(3, 1))
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        normal = [i for i in range(self.size) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        text = {i: sp.id_to_piece(i) for i in normal}
        if any(MARK in t.lstrip(MARK) for t in text.values()):
            raise ValueError("a piece goes on over a word start")
        self.byte_ids = np.full(256, sp.unk_id(), np.int32)
        for i in range(self.size):
            if sp.is_byte(i):
                self.byte_ids[int(sp.id_to_piece(i)[3:-1], 16)] = i
        self.longest = max(map(len, text.values()), default=1)
        keys = np.array([self.key(t) for t in text.values()], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal, np.int32)[order]
        self.scores = np.array([sp.get_score(i) for i in normal])[order]
        self.lengths = {i: len(t) for i, t in text.items()}
        self.unknown_score = self.scores.min() - 10 if normal else -10.0
        chars = "".join(sorted(set("".join(text.values()))))
        self.strange = re.compile(f"([^{re.escape(chars)}])", re.S)  # characters of no piece
        self.as_bytes = [b""] * self.size
        for i, t in text.items():
            self.as_bytes[i] = t.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            if i != sp.unk_id():
                self.as_bytes[i] = bytes([b])
        self.as_bytes[sp.unk_id()] = " ⁇ ".encode()

    @staticmethod
    def key(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def spell(self, text: str) -> np.ndarray:
        return self.byte_ids[np.frombuffer(text.encode(), np.uint8)]

    def viterbi(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words of one length."""
        n, size = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, size).astype(np.uint64) + np.uint64(1)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, size + 1), np.int32)     # length of the last piece
        last = np.full((n, size + 1), -1, np.int32)  # its id; -1: unknown character
        hashes = [chars]
        for k in range(1, min(self.longest, size)):
            hashes.append(hashes[-1][:, : size - k] * BASE + chars[:, k:])
        found = [self._probe(h) for h in hashes]
        for end in range(1, size + 1):
            for k in range(min(self.longest, end), 0, -1):
                score, piece = found[k - 1][0][:, end - k], found[k - 1][1][:, end - k]
                if k == 1:
                    score = np.where(piece < 0, self.unknown_score, score)
                total = best[:, end - k] + score
                up = total > best[:, end]
                best[up, end] = total[up]
                back[up, end] = k
                last[up, end] = piece[up]
        ids = np.full((n, size), -2, np.int32)  # filled from the right
        at = np.full(n, size)
        rows = np.arange(n)
        step = size
        while len(rows):
            step -= 1
            ids[rows, step] = last[rows, at[rows]]
            at[rows] -= back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        out = []
        for row, word in zip(ids, words):
            row = row[row != -2]
            if (row == -1).any():
                parts, p = [], 0
                for i in row:
                    if i == -1:
                        parts.append(self.spell(word[p]))
                        p += 1
                    else:
                        parts.append(np.array([i], np.int32))
                        p += self.lengths[i]
                row = np.concatenate(parts)
            out.append(row)
        return out

    def viterbi_long(self, words: list[str]) -> list[np.ndarray]:
        """The same for long words, one by one: substrings are probed in windows of starts, and only those that are pieces are followed."""
        return [self._viterbi_long(w) for w in words]

    def _viterbi_long(self, word: str) -> np.ndarray:
        size = len(word)
        chars = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        best = np.full(size + 1, -np.inf)
        best[0] = 0
        back, last = np.zeros(size + 1, np.int32), np.full(size + 1, -1, np.int32)
        for at in range(0, size, WINDOW):
            to = min(at + WINDOW, size)
            h = chars[at:to]
            ends, lengths, scores, ids = [], [], [], []
            for k in range(1, min(self.longest, size - at) + 1):
                if k > 1:
                    h = h[: min(to, size - k + 1) - at] * BASE + chars[at + k - 1: min(to, size - k + 1) + k - 1]
                score, piece = self._probe(h)
                hit = np.flatnonzero((piece >= 0) if k > 1 else np.ones(len(h), bool))      # a single character always has a score
                ends.append(at + hit + k)
                lengths.append(np.full(len(hit), k, np.int32))
                scores.append(np.where(piece[hit] < 0, self.unknown_score, score[hit]))
                ids.append(piece[hit])
            ends, lengths, scores, ids = (np.concatenate(x) for x in (ends, lengths, scores, ids))
            # by start, so that its best score is settled; of equal totals the longer piece came first, as in the batch
            order = np.lexsort((-lengths, ends - lengths))
            window = best[at: min(to + self.longest, size) + 1].tolist()
            for end, k, score, piece in zip(ends[order].tolist(), lengths[order].tolist(), scores[order].tolist(), ids[order].tolist()):
                total = window[end - k - at] + score
                if total > window[end - at]:
                    window[end - at] = total
                    back[end], last[end] = k, piece
            best[at: at + len(window)] = window
        out, at = [], size
        while at:
            out.append(self.spell(word[at - 1])[::-1] if last[at] == -1 else last[at: at + 1])
            at -= int(back[at])
        return np.concatenate(out)[::-1].astype(np.int32)

    def merge_long(self, words: list[str]) -> list[np.ndarray]:
        """Ids of long words by merges, one by one: a heap of neighbours instead of a scan for each merge."""
        return [self._merge_long(w) for w in words]

    def _merge_long(self, word: str) -> np.ndarray:
        size, mask, base = len(word), 0xFFFFFFFFFFFFFFFF, int(BASE)
        chars = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        scores, _ = self._probe(chars[:-1] * BASE + chars[1:])
        heap = [(-score, i, i + 1, 2) for i, score in zip(np.flatnonzero(scores > -np.inf).tolist(), scores[scores > -np.inf].tolist())]
        heapq.heapify(heap)
        table = dict(zip(self.keys.tolist(), self.scores.tolist()))
        h, length, after, before = chars.tolist(), [1] * size, list(range(1, size + 1)), list(range(-1, size - 1))
        power: dict[int, int] = {}

        def push(left: int, right: int) -> None:
            n = length[right]
            p = power.setdefault(n, pow(base, n, 1 << 64))
            score = table.get((h[left] * p + h[right]) & mask)
            if score is not None:
                heapq.heappush(heap, (-score, left, right, length[left] + n))

        while heap:
            _, left, right, n = heapq.heappop(heap)
            if length[left] + (length[right] if right < size else 0) != n or not length[left] or not length[right] or after[left] != right:
                continue        # one of them has been merged since
            h[left] = (h[left] * power.setdefault(length[right], pow(base, length[right], 1 << 64)) + h[right]) & mask
            length[left], length[right] = n, 0
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
                push(left, after[left])
            if before[left] >= 0:
                push(before[left], left)
        starts = np.flatnonzero(np.array(length))
        ids = self._probe(np.array([h[i] for i in starts.tolist()], np.uint64))[1]
        if (ids >= 0).all():
            return ids.astype(np.int32)
        return np.concatenate([self.spell(word[i]) if k < 0 else np.array([k], np.int32) for i, k in zip(starts.tolist(), ids.tolist())])

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words of one length by merges: the best-scored neighbours that join to a piece go first (ties: the left ones)."""
        n, size = len(words), len(words[0])
        h = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, size).astype(np.uint64) + np.uint64(1)
        power = np.full((n, size), BASE, np.uint64)          # BASE to each token's length
        count = np.full(n, size)
        score, _ = self._probe(h[:, :-1] * power[:, 1:] + h[:, 1:])
        row = np.arange(n) if size > 1 else np.empty(0, np.int64)
        while len(row):
            at = score[row].argmax(axis=1)
            some = score[row, at] > -np.inf
            row, at = row[some], at[some]
            if not len(row):
                break
            h[row, at] = h[row, at] * power[row, at + 1] + h[row, at + 1]
            power[row, at] *= power[row, at + 1]
            # close the gap at the merged token
            cols = np.arange(size - 1)
            shift = cols[None, :] + (cols[None, :] > at[:, None])
            h[row, :-1], power[row, :-1] = h[row[:, None], shift], power[row[:, None], shift]
            if size > 2:
                score[row, :-1] = score[row[:, None], shift[:, :-1]]
            score[row, -1] = -np.inf
            count[row] -= 1
            for side in (at - 1, at):
                ok = (side >= 0) & (side + 1 < count[row])
                r, c = row[ok], side[ok]
                score[r, c] = self._probe(h[r, c] * power[r, c + 1] + h[r, c + 1])[0]
                bad = (side >= 0) & ~ok
                score[row[bad], np.minimum(side[bad], size - 2)] = -np.inf
        ids = self._probe(h)[1]
        out = []
        for r, (word, k) in enumerate(zip(words, count)):
            mine = ids[r, :k]
            if (mine < 0).any():  # a character that only stands inside longer pieces
                parts, p = [], 0
                for i in mine:
                    parts.append(self.spell(word[p]) if i < 0 else np.array([i], np.int32))
                    p += 1 if i < 0 else self.lengths[i]
                mine = np.concatenate(parts)
            out.append(mine)
        return out

    def _probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of substring hashes; -inf and -1 where there is no piece."""
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = self.keys[at] == h
        return np.where(hit, self.scores[at], -np.inf), np.where(hit, self.ids[at], -1)

    def units(self, word: str) -> list[str]:
        """A word as it is searched: cut before word starts and at characters of no piece."""
        words = re.findall(f"{MARK}+[^{MARK}]*|^[^{MARK}]+", word.replace(" ", MARK))
        return [x for w in words for x in self.strange.split(w) if x]


@cache
def pieces(path: str) -> Pieces:
    """The pieces of a model file, read once by a Python worker."""
    return Pieces(path)


class Encoder:
    """Ids of texts; words not seen before are searched in groups of one length."""

    def __init__(self, path: str, method: str = "viterbi"):
        self.pieces, self.method, self.table = pieces(path), method, WordTable(self._encode_words)
        self.apart = bool(self.pieces.strange.fullmatch("\n"))

    def _encode_words(self, words: list[str]) -> list[np.ndarray]:
        p, found, by_size = self.pieces, {}, {}
        cut = [p.units(w) for w in words]
        for u in set().union(*cut):
            if len(u) == 1 and p.strange.fullmatch(u):
                found[u] = p.spell(u)
            else:
                by_size.setdefault(len(u), []).append(u)
        for size, group in by_size.items():
            if size > LONG:
                found.update(zip(group, getattr(p, f"{self.method}_long")(group)))
                continue
            most = max(1, (1 << 20) // (size * min(size, p.longest)))
            for at in range(0, len(group), most):
                found.update(zip(group[at: at + most], getattr(p, self.method)(group[at: at + most])))
        return [found[us[0]] if len(us) == 1 else np.concatenate([found[u] for u in us]) for us in cut]

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of each text in order; a null or empty text has none."""
        for at, data, bounds in slices(texts, 1 << 20):
            size = np.diff(bounds)
            if self.pieces.dummy_prefix:  # a space before every text that isn't empty
                some = np.flatnonzero(size)
                data = np.insert(data, bounds[:-1][some], 32)
                bounds = bounds + np.concatenate(([0], np.cumsum(size > 0)))
            space = data == 32
            change = np.zeros(len(data) + 1, bool)
            change[1:-1] = space[1:] & ~space[:-1]
            if self.apart:  # line feeds are in no piece
                feed = np.flatnonzero(data == 10)
                change[feed] = change[feed + 1] = True
            change[bounds] = True
            starts = np.flatnonzero(change[:-1])
            ids, ends = self.table(data, starts, np.diff(np.append(starts, len(data))), SAME)
            cuts = ends[np.searchsorted(starts, bounds)]
            # a written word-start mark may join with the space after it
            marks = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
            marked = np.diff(np.searchsorted(marks, bounds)) > 0
            for i in range(len(bounds) - 1):
                if marked[i]:
                    yield at + i, self._encode_words([data[bounds[i]: bounds[i + 1]].tobytes().decode()])[0]
                else:
                    yield at + i, ids[cuts[i]: cuts[i + 1]]


@cache
def encoder(path: str, method: str) -> Encoder:
    """One encoder, with the words it has seen, for all tasks of a Python worker."""
    return Encoder(path, method)


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(parts) if parts else np.empty(0, np.int32))


def _cut(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` elements (bytes or ids) of a column."""
    col = batch.column(column)
    col = col.cast(pa.binary()) if pa.types.is_string(col.type) else col
    sizes = np.array([0 if not v.is_valid else len(v.as_buffer()) if pa.types.is_binary(col.type) else len(v) for v in col])
    at, total = 0, 0
    for i, s in enumerate(sizes):
        total += int(s)
        if total >= most:
            yield batch.slice(at, i + 1 - at)
            at, total = i + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def _parts(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of all batches; memory that a batch has freed goes back before the next is read, or each worker keeps it."""
    for b in batches:
        yield from _cut(b, column, most)
        pa.default_memory_pool().release_unused()


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", method: str = "viterbi") -> DataFrame:
    """(id_col, text, ids array<int>) per row, by the ``viterbi`` search or by ``merge``. A null or empty text has no ids; repeated rows and null ids keep their rows; other columns are ignored."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model_path, method)
        for b in _parts(batches, "text", 1 << 22):
            ids = [part for _, part in encode(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text"), _list_array(ids)], names=["id", "text", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, fn, "id long, text string, ids array<int>").withColumnRenamed("id", id_col)


def decode_pieces(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids_col``: pieces joined, byte pieces as UTF-8 (what isn't: U+FFFD), the first word's mark dropped.

    Null ids give a null text, ids outside the model fail.
    """
    at = rows.columns.index(ids_col)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_path)
        for b in _parts(batches, ids_col, 1 << 20):
            texts = []
            for v in b.column(at):
                if not v.is_valid:
                    texts.append(None)
                    continue
                ids = v.values.to_numpy()
                if len(ids) and (ids.min() < 0 or ids.max() >= p.size):
                    raise ValueError("an id outside the model")
                text = b"".join(map(p.as_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
                texts.append(text[1:] if p.dummy_prefix and text[:1] == " " else text)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return arrow_map(rows, fn, f"{schema}, `{out_col}` string")
