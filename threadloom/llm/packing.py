"""Concatenate and cut: all documents as one token stream, cut into windows of equal length.

The first pass tokenizes each text once and stores, with the ids, its partition and the tokens that
stand before it there. The prefix sums of the partition totals (one row per partition) turn this into a
global offset. The second pass cuts each document at the multiples of the window and returns a record
for each piece, so only the last window is padded.

Texts are tokenized by chunk, cut where a byte-level BPE with the usual pattern always begins a new
pre-token: before a space or line feed that a printable character follows, and between letters, digits
and punctuation. The ids of a text are those of its chunks one after the other, and a worker tokenizes
each distinct chunk once. Texts that spell out a special token are tokenized whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.scratch import Scratch
from threadloom.llm.words import slices, span_hashes, text_bytes
from threadloom.session import broadcast_if_small

#: Distinct chunks a worker remembers, about 25 bytes each; bytes and chunks that it handles at once.
CACHE_CHUNKS, SLICE_BYTES, LEARN_CHUNKS = 1_000_000, 1 << 18, 4000

# classes of bytes: letters, digits, punctuation; 0 is all else, and the apostrophe, which opens contractions
_LETTER, _DIGIT, _POINT = 1, 2, 3
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _POINT
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[0x27] = 0
_OPENS = np.zeros(256, bool)
_OPENS[0x21:0x7F] = True
_OPENS[0xC3] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin in consecutive texts."""
    if not len(data):
        return np.zeros(0, np.int64)
    kind = _CLASS[data]
    # U+00C0 to U+00FF, but for the signs of multiplication and division, are letters of two bytes
    after = data[1:]
    lead = np.flatnonzero((data[:-1] == 0xC3) & (after >= 0x80) & (after < 0xC0) & (after != 0x97) & (after != 0xB7))
    kind[lead] = kind[lead + 1] = _LETTER
    opens = np.zeros(len(data), bool)
    opens[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    blank = np.zeros(len(data), bool)
    blank[:-1] = _BLANK[data[:-1]] & _OPENS[after]
    ends = offsets[1:][offsets[1:] > 0] - 1
    blank[ends] = False
    opens |= blank
    opens[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(opens)


class ChunkTokenizer:
    """Token ids of texts, through a cache of chunks: sorted hashes, and where the ids lie in a pool."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end_id = end_id
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int32)
        # the end id is at 0
        self.pool, self.used = np.full(1 << 16, self.end_id, np.uint32), 1

    def _learn(self, place: np.ndarray, hashes: np.ndarray, chunks: list[str]) -> None:
        parts, counts = [], []
        for first in range(0, len(chunks), LEARN_CHUNKS):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(chunks[first:first + LEARN_CHUNKS], add_special_tokens=False)]
            counts += map(len, found)
            parts.append(np.array([i for one in found for i in one], np.uint32))
        lengths, flat = np.array(counts, np.int32), np.concatenate(parts)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(flat)] = flat
        begins = (self.used + np.cumsum(lengths) - lengths).astype(np.int32)
        self.used += len(flat)
        self.known = np.insert(self.known, place, hashes)
        self.starts, self.lengths = np.insert(self.starts, place, begins), np.insert(self.lengths, place, lengths)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of consecutive texts, each closed by the end id."""
        raw = data.tobytes()
        if not any(s in raw for s in self.special):
            return self._encode(data, offsets, raw)
        parts = []
        for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if any(x in raw[s:e] for x in self.special):
                parts.append(np.array([*self.tokenizer.encode(raw[s:e].decode(), add_special_tokens=False).ids, self.end_id], np.uint32))
            else:
                parts.append(self._encode(data[s:e], np.array([0, e - s]), raw[s:e])[0])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _encode(self, data: np.ndarray, offsets: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHE_CHUNKS:
            self.clear()
        starts = chunk_starts(data, offsets)
        stops = np.append(starts[1:], len(data))[:len(starts)]
        distinct, example, inverse = np.unique(span_hashes(data, starts, stops), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        found = np.zeros(len(distinct), bool)
        inside = place < len(self.known)
        found[inside] = self.known[place[inside]] == distinct[inside]
        if not found.all():
            new = np.flatnonzero(~found)
            chunks = [raw[s:e].decode() for s, e in zip(starts[example[new]].tolist(), stops[example[new]].tolist())]
            self._learn(place[new], distinct[new], chunks)
            place = np.searchsorted(self.known, distinct)
        chunk_bounds = np.searchsorted(starts, offsets)
        which = np.insert(place[inverse], chunk_bounds[1:], -1)
        end = which < 0
        lengths = np.where(end, 1, self.lengths[which] if len(self.lengths) else 1)
        begins = np.where(end, 0, self.starts[which] if len(self.starts) else 0)
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.pool[np.repeat(begins - total[:-1], lengths) + np.arange(total[-1])]
        return ids, total[chunk_bounds + np.arange(len(chunk_bounds))]


#: One tokenizer per worker process: its cache serves all tasks of the worker.
_tokenizers: dict[tuple[str, int], ChunkTokenizer] = {}


def tokenizer_for(path: str, end_id: int) -> ChunkTokenizer:
    if (path, end_id) not in _tokenizers:
        _tokenizers[path, end_id] = ChunkTokenizer(path, end_id)
    return _tokenizers[path, end_id]


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_for(path, end_id)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in slices(offsets, SLICE_BYTES):
                cut = offsets[first:last + 1]
                ids, bounds = tokenizer.encode(data[cut[0]:cut[-1]], cut - cut[0])
                raw = pa.py_buffer(ids.astype("<u4").tobytes())
                n = last - first
                stored = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((bounds * 4).astype(np.int32).tobytes()), raw])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(np.full(n, part, np.int32)),
                    pa.array(before + bounds[:-1]), pa.array(np.diff(bounds)), stored],
                    names=["doc_id", "part", "before", "doc_tokens", "ids"])
                before += int(bounds[-1])
    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_tokens, begin = batch.column("doc_tokens").to_numpy(), batch.column("begin").to_numpy()
            lowest, highest = begin // window, (begin + n_tokens - 1) // window
            pieces = highest - lowest + 1
            row = np.repeat(np.arange(batch.num_rows), pieces)
            first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
            sequence = lowest[row] + np.arange(len(row)) - first[row]
            start = np.maximum(sequence * window - begin[row], 0)
            stop = np.minimum((sequence + 1) * window - begin[row], n_tokens[row])
            ids = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(stop - start),
                pa.array(n_tokens[row]), pa.array(sequence), pa.array(begin[row] + start - sequence * window),
                pa.array([ids[r][4 * s:4 * e] for r, s, e in zip(row.tolist(), start.tolist(), stop.tolist())], pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text; more columns are ignored) in windows of ``window`` tokens.

    One row per piece: doc_id, start (its document's tokens before it), length, doc_tokens (with the end
    id), sequence_id, offset (in the sequence), ids (little-endian unsigned 32-bit). Null and empty texts
    are one end id. Rows with equal or null doc_id are packed one by one. The order of the documents is
    that of the input's partitions.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = scratch.store(named.mapInArrow(
        _tokenize(tokenizer_path, end_id), "doc_id long, part int, before long, doc_tokens long, ids binary"), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    # one row per partition of the input, so a single ordered sum is small
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = scratch.store(totals.select("part", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("base")), "base")
    placed = tokens.join(broadcast_if_small(base), "part").select(
        "doc_id", "doc_tokens", "ids", (F.col("base") + F.col("before")).alias("begin"))
    return placed.mapInArrow(
        _cut(window), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
