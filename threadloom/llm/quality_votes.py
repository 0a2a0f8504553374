"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes a bag of hashed terms: its words, the shapes of its tokens (upper case, lower case, digits and
the very punctuation marks, runs squeezed) and a few terms for how many of its words are repeats. Weights are
1 + log(tf) times an inverse document frequency; the leading singular directions of the labelled texts
span the latent space. Their unit vectors are sent to the tasks, which take the cosine of every text with every labelled vector,
block by block, and let the nearest ones vote with the similarity as weight.

Labelled rows that are not held out enter, at most ``MAX_PER_CLASS`` of each class, chosen by a hash of the id.
They are hashed where they are read, so the driver receives at most ``BUCKETS`` pairs of numbers for each,
however long the texts are. Scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.words import ALNUM, SPACED, Words, hash_words, mix, slices, span_hashes, text_bytes
from threadloom.session import broadcast_if_small

#: Bound on the labelled rows of each class that are used for fitting and for voting.
MAX_PER_CLASS = 1500
BUCKETS = 1 << 14
#: Latent dimensions, neighbours that vote, and the power of the similarity that weights a vote.
LATENT, NEIGHBOURS, SHARPNESS = 48, 15, 8
#: A term counts if this many labelled texts hold it.
MIN_TEXTS = 3
#: Rounds of the subspace iteration for the singular directions, and directions beyond those kept.
ROUNDS, SPARE = 6, 12
#: Classes of repetition and the weight of that term against the logarithm of the words.
REPEAT_STEPS = 12
#: Texts compared with all labelled vectors at once, and cosines that count as equal.
BLOCK, TIE = 512, 1e-6

_SALTS = {"word": np.uint64(1), "shape": np.uint64(0x5BD1E995), "repeat": np.uint64(0xC2B2AE35)}


def _shape_table() -> np.ndarray:
    """Bytes to shape classes: A, a, 0, punctuation as it is, nothing for the parts of non-ASCII characters."""
    table = np.zeros(256, np.uint8)
    for byte in range(1, 128):
        char = chr(byte)
        table[byte] = ord("A" if "A" <= char <= "Z" else "a" if "a" <= char <= "z" else "0" if "0" <= char <= "9" else char)
    return table


SHAPES = _shape_table()


def token_shapes(data: np.ndarray, tokens: Words) -> np.ndarray:
    """A hash of each token's shape: its classes of characters, equal neighbours written once."""
    if not len(tokens.starts):
        return np.zeros(0, np.uint64)
    shape = SHAPES[data]
    places = np.flatnonzero(shape)
    owner = np.searchsorted(tokens.starts, places, side="right") - 1
    inside = (owner >= 0) & (places < tokens.ends[np.maximum(owner, 0)])
    places, owner = places[inside], owner[inside]
    # a class counts where it differs from the one before in its token
    changed = np.ones(len(places), bool)
    changed[1:] = (shape[places[1:]] != shape[places[:-1]]) | (owner[1:] != owner[:-1])
    kept = places[changed]
    return span_hashes(shape[kept], np.searchsorted(kept, tokens.starts), np.searchsorted(kept, tokens.ends))


def term_bags(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, weight before idf) of the terms of texts that lie one after the other in ``data``."""
    n = len(offsets) - 1
    words, tokens = hash_words(data, offsets, ALNUM), hash_words(data, offsets, SPACED)
    owners = [np.repeat(np.arange(n), np.diff(x.bounds)) for x in (words, tokens)]
    terms = [mix(words.hashes ^ _SALTS["word"]), mix(token_shapes(data, tokens) ^ _SALTS["shape"])]
    size = np.uint64(BUCKETS)
    row, bucket = np.concatenate(owners), (np.concatenate(terms) % size).astype(np.int64)
    cell, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    # repeats: the share of a text's words that stand earlier in it, as one of a few terms
    total = np.diff(words.bounds)
    pair = np.lexsort((words.hashes, owners[0]))
    fresh = np.ones(len(pair), bool)
    if len(pair):
        fresh[1:] = (words.hashes[pair][1:] != words.hashes[pair][:-1]) | (owners[0][pair][1:] != owners[0][pair][:-1])
    distinct = np.bincount(owners[0][pair][fresh], minlength=n)
    share = 1 - distinct / np.maximum(total, 1)
    step = np.minimum((share * REPEAT_STEPS).astype(np.int64), REPEAT_STEPS - 1)
    with np.errstate(over="ignore"):
        code = (mix(step.astype(np.uint64) ^ _SALTS["repeat"]) % size).astype(np.int64)
    has = total > 0
    rows = np.concatenate([cell // BUCKETS, np.flatnonzero(has)])
    return rows, np.concatenate([cell % BUCKETS, code[has]]), np.concatenate([1 + np.log(count), 1 + np.log(np.maximum(total, 1))[has]])


@dataclass
class Model:
    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    #: label times weight, and weight, of each labelled vector
    votes: np.ndarray
    #: the score of a text without neighbours, and the vote share that becomes 0.5
    prior: float
    cut: float

    def latent(self, rows: np.ndarray, buckets: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
        """Unit latent vectors; zero for texts without a known term."""
        return _units(_times(rows, buckets, (weights * self.idf[buckets]).astype(np.float32), self.directions, n))

    def shares(self, latent: np.ndarray, skip: np.ndarray | None = None) -> np.ndarray:
        """The weighted share of label 1 among the nearest labelled vectors, NaN without any.

        ``skip`` names a labelled vector to leave out for each row.
        """
        out = np.full(len(latent), np.nan)
        nearest = min(NEIGHBOURS, len(self.vectors) - (skip is not None))
        if nearest < 1:
            return out
        for first in range(0, len(latent), BLOCK):
            cosine = latent[first:first + BLOCK] @ self.vectors.T
            if skip is not None:
                cosine[np.arange(len(cosine)), skip[first:first + BLOCK]] = -1
            # all vectors as near as the last of the nearest vote, so ties need no order
            last = np.partition(cosine, -nearest, axis=1)[:, -nearest, None]
            similarity = np.where(cosine >= last - TIE, np.maximum(cosine, 0), 0) ** SHARPNESS
            label, total = (similarity @ self.votes).T
            some = total > 0
            out[first:first + BLOCK][some] = label[some] / total[some]
        return out

    def scores(self, share: np.ndarray) -> np.ndarray:
        """Vote shares bent so that the calibrated cut becomes 0.5; the prior where there is no vote."""
        below, above = max(self.cut, 1e-9), max(1 - self.cut, 1e-9)
        bent = np.where(share < self.cut, 0.5 * share / below, 0.5 + 0.5 * (share - self.cut) / above)
        return np.where(np.isnan(share), self.prior, np.clip(bent, 0, 1))


def _times(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, dense: np.ndarray, n: int) -> np.ndarray:
    """A sparse matrix of n rows, given by its entries sorted or not by row, times a dense one."""
    out = np.zeros((n, dense.shape[1]), np.float32)
    order = np.argsort(rows, kind="stable")
    rows, columns, values = rows[order], columns[order], values[order]
    step = 1 << 16
    for first in range(0, len(rows), step):
        part = dense[columns[first:first + step]] * values[first:first + step, None]
        owner = rows[first:first + step]
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[starts]] += np.add.reduceat(part, starts, axis=0)
    return out


def _units(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def fit(rows: np.ndarray, buckets: np.ndarray, weights: np.ndarray, labels: np.ndarray,
        class_weights: tuple[float, float] = (1.0, 1.0), seed: int = 11) -> Model:
    """The latent space and the votes of labelled texts, given by the entries of their term bags."""
    n = len(labels)
    holders = np.bincount(buckets, minlength=BUCKETS)
    idf = np.where(holders >= MIN_TEXTS, np.log((1 + n) / (1 + holders)) + 1, 0.0)
    values = (weights * idf[buckets]).astype(np.float32)
    # rows of unit length, so that long texts do not own the space
    length = np.sqrt(np.bincount(rows, weights=values.astype(np.float64) ** 2, minlength=n))
    unit = (values / np.where(length > 0, length, 1)[rows]).astype(np.float32)
    size = max(1, min(LATENT, n))
    basis = np.random.default_rng(seed).normal(size=(BUCKETS, size + SPARE)).astype(np.float32)
    for _ in range(ROUNDS):
        image = _times(rows, buckets, unit, basis, n)
        basis = np.linalg.qr(_times(buckets, rows, unit, image, BUCKETS))[0].astype(np.float32)
    image = _times(rows, buckets, unit, basis, n).astype(np.float64)
    _, turn = np.linalg.eigh(image.T @ image)
    directions = (basis @ turn[:, ::-1][:, :size]).astype(np.float32)
    own = np.where(labels == 1, class_weights[1], class_weights[0])
    prior = float((own * labels).sum() / own.sum())
    model = Model(idf, directions, np.zeros((0, size), np.float32), np.stack([own * labels, own], axis=1), prior, 0.5)
    model.vectors = model.latent(rows, buckets, weights, n)
    share = model.shares(model.vectors, skip=np.arange(n))
    voted = ~np.isnan(share)
    model.cut = best_cut(share[voted], labels[voted], own[voted])
    return model


def best_cut(share: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the cut with the best balanced accuracy, each labelled text judged by the others."""
    values = np.unique(share)
    if len(values) < 2:
        return 0.5
    cuts = (values[1:] + values[:-1]) / 2
    order = np.argsort(share, kind="stable")
    below = [np.concatenate([[0.0], np.cumsum(np.where(labels[order] == y, weight[order], 0))]) for y in (0, 1)]
    at = np.searchsorted(share[order], cuts)
    quality = below[0][at] / max(below[0][-1], 1e-300) + 1 - below[1][at] / max(below[1][-1], 1e-300)
    best = np.flatnonzero(quality >= quality.max() - 1e-12)
    return float(cuts[best[len(best) // 2]])


def held_out(doc_id):
    """Whether a document's label is kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, y, buckets, weights) of labelled texts."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last in slices(offsets):
            cut = offsets[first:last + 1]
            rows, buckets, weights = term_bags(data[cut[0]:cut[-1]], cut - cut[0])
            order = np.argsort(rows, kind="stable")
            bounds = pa.array(np.searchsorted(rows[order], np.arange(last - first + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, last - first), batch.column("y").slice(first, last - first),
                pa.ListArray.from_arrays(bounds, pa.array(buckets[order].astype(np.int32))),
                pa.ListArray.from_arrays(bounds, pa.array(weights[order].astype(np.float32)))], names=["doc_id", "y", "buckets", "weights"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_per_class: int = MAX_PER_CLASS) -> Model | None:
    """Fits on labelled rows that are not held out; None unless both labels occur.

    ``docs`` has doc_id and text, ``labels`` doc_id and ``label`` (0 or 1; other values and null ids are
    ignored). A document with both labels enters with each of them, a repeated row of ``docs`` with each copy.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    totals = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    chosen = [usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class) for y in (0, 1)]
    # at most 2 * max_per_class rows of two numbers
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(sample, "doc_id")
    found = named.mapInArrow(_bags, "doc_id long, y int, buckets array<int>, weights array<float>").toArrow().combine_chunks()
    if not found.num_rows:
        return None
    y = found["y"].to_numpy().astype(np.int64)
    if len(set(y.tolist())) < 2:
        return None
    ids = found["doc_id"].to_numpy()
    found = found.take(pa.array(np.lexsort((y, ids))))
    y = found["y"].to_numpy().astype(np.int64)
    buckets, weights = (found[c].combine_chunks() for c in ("buckets", "weights"))
    rows = np.repeat(np.arange(len(y)), buckets.value_lengths().to_numpy())
    own = tuple(totals[c] / max(1, int((y == c).sum())) for c in (0, 1))
    return fit(rows, buckets.flatten().to_numpy().astype(np.int64), weights.flatten().to_numpy().astype(np.float64), y, own)


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in slices(offsets):
                n = last - first
                cut = offsets[first:last + 1]
                if model is None:
                    score = np.full(n, 0.5)
                else:
                    latent = model.latent(*term_bags(data[cut[0]:cut[-1]], cut - cut[0]), n)
                    score = model.scores(model.shares(latent))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(score)], names=["key", "score"])
    return run


def score(docs: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """key, score (0 to 1), predicted (1 from score 0.5) for every row of ``docs`` (key, text), repeated rows too.

    Null and empty texts and texts without any known term have no neighbours: their score is the prior of
    label 1. Without a model every score is 0.5.
    """
    kind = docs.schema[key].dataType.simpleString()
    scored = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score(model), f"key {kind}, score double")
    return scored.select(F.col("key").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
