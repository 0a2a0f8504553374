"""Whitening of embeddings, fitted on distinct vectors with their multiplicity as an optional weight.

Entries become integers, x = floor(64 c) + 1000000. A vector is stored as a code that holds its integers in
the narrowest width that fits, so equal codes are equal vectors: grouping by the code makes the fit list.
Sums are exact integers; the covariance is a weighted matrix product of rows from which the mean was taken
first, added up over tasks; each distinct vector is whitened once and joined back to its rows.

The driver sees, for each length of vectors, the sums, one matrix of (length x length) and its eigenvectors,
whatever the number of rows. Codes of more than ``HOT_SHARE`` of the rows, of which there are at most
``1 / HOT_SHARE``, are joined back by broadcast, all others by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.scratch import Scratch
from threadloom.session import broadcast_if_small

# The grid of the integers and the components returned.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Share of all rows from which the copies of a vector are joined back by broadcast.
HOT_SHARE = 0.001
#: Rows of a matrix handled at once; Arrow batches may be larger.
ROWS = 4096
#: Largest |floor(64 c)| whose integer is exact in a long.
LARGEST = float(2**62)

_WIDTHS = ("<i1", "<i2", "<i4", "<i8")


def encode(x: np.ndarray) -> list[bytes]:
    """A code for each row of integers: a byte for the width, then the entries less ``SHIFT``."""
    small = x - SHIFT
    low, high = small.min(axis=1), small.max(axis=1)
    width = np.full(len(x), len(_WIDTHS) - 1)
    for w in reversed(range(len(_WIDTHS) - 1)):
        limits = np.iinfo(_WIDTHS[w])
        width[(low >= limits.min) & (high <= limits.max)] = w
    codes: list = [b""] * len(x)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        for r, data in zip(rows.tolist(), small[rows].astype(_WIDTHS[w])):
            codes[r] = bytes([w]) + data.tobytes()
    return codes


def decode(codes: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, integers) for each length and width among the codes, at most ``ROWS`` rows at once."""
    kinds: dict = {}
    for i, code in enumerate(codes):
        kinds.setdefault((code[0], len(code)), []).append(i)
    for (w, size), places in sorted(kinds.items()):
        for first in range(0, len(places), ROWS):
            chosen = places[first:first + ROWS]
            joined = b"".join(codes[i][1:] for i in chosen)
            x = np.frombuffer(joined, _WIDTHS[w]).reshape(len(chosen), -1).astype(np.int64) + SHIFT
            yield np.array(chosen), x


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, code) of the usable rows of (vec_id, vector)."""
    for batch in batches:
        vectors = batch.column(1)
        if not isinstance(vectors, pa.ListArray):
            vectors = vectors.cast(pa.list_(pa.float64()))
        sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ids = batch.column(0)
        for d in np.unique(sizes[sizes > 0]).tolist():
            rows = np.flatnonzero(sizes == d)
            c = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(c * SCALE)
                fits = (np.abs(x) <= LARGEST).all(axis=1)
            if fits.any():
                codes = encode(x[fits].astype(np.int64) + SHIFT)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[fits])), pa.array(codes, pa.binary())], names=["vec_id", "code"])


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("weight").to_numpy()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dims, place, total) of a task: exact sums by dimension, and the weight at place -1."""
    found: dict[int, list] = {}
    for batch in batches:
        weight = _weights(batch)
        for places, x in decode(batch.column("code").to_pylist()):
            d, w = x.shape[1], weight[places]
            # Python integers: no sum can overflow
            total = found.setdefault(d, [0] * (d + 1))
            parts = (x * w[:, None]).sum(axis=0).tolist() if _fits(x, w) else [sum(int(a) * int(b) for a, b in zip(column, w)) for column in x.T]
            for j, value in enumerate([int(w.sum()), *parts]):
                total[j] += value
    for d, total in found.items():
        yield pa.RecordBatch.from_arrays([
            pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()),
            pa.array([str(v) for v in total]).cast(pa.decimal128(38, 0))], names=["dims", "place", "total"])


def _fits(x: np.ndarray, w: np.ndarray) -> bool:
    """Whether the weighted sums of these integers stay exact in a long."""
    return float(np.abs(x).max(initial=0)) * float(w.sum()) < 2.0**62


@dataclass(frozen=True)
class Centre:
    """The exact mean of the fit list: (base + rest / n) with 0 <= rest < n for each dimension."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> "Centre":
        return cls(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64))

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles: the integer part is taken off before anything is rounded."""
        return (x - self.base) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, exact; None beyond a long."""
        away = x - self.base
        largest = np.abs(away).max(axis=1).astype(np.float64) * self.n + self.n
        out: list = []
        exact = largest * largest * x.shape[1] < 2.0**62
        scaled = np.where(exact[:, None], away, 0) * self.n - self.rest
        quick = (scaled * scaled).sum(axis=1)
        for i, sure in enumerate(exact.tolist()):
            value = int(quick[i]) if sure else sum((int(a) * self.n - int(r)) ** 2 for a, r in zip(away[i], self.rest))
            out.append(value if value < 1 << 63 else None)
        return out


def _products(centres: dict[int, Centre]):
    """(dims, place, total) of a task: the weighted product of the centred rows, place = i * dims + j for i <= j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = _weights(batch)
            for places, x in decode(batch.column("code").to_pylist()):
                d = x.shape[1]
                y = centres[d].offsets(x)
                product = (y * weight[places, None]).T @ y
                found[d] = found[d] + product if d in found else product
        yield from _upper(found)
    return run


def _upper(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for d, product in found.items():
        i, j = np.triu_indices(len(product))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(i), d), pa.int32()), pa.array(i * len(product) + j, pa.int32()), pa.array(product[i, j])],
            names=["dims", "place", "total"])


def _matrix(rows, size: int) -> np.ndarray:
    """The symmetric matrix of (place, total) pairs."""
    out = np.zeros((size, size))
    for place, total in rows:
        out[place // size, place % size] = out[place % size, place // size] = total
    return out


def _collected(parts: DataFrame) -> dict[int, list]:
    """dims -> [(place, total)], added up over the tasks before they reach the driver."""
    found: dict[int, list] = {}
    for row in parts.groupBy("dims", "place").agg(F.sum("total").alias("total")).collect():
        found.setdefault(row["dims"], []).append((row["place"], row["total"]))
    return {d: sorted(rows) for d, rows in found.items()}


@dataclass(frozen=True)
class Whitening:
    """Mean, components by falling variance, variances and total variance of the vectors of one length."""

    centre: Centre
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @classmethod
    def of(cls, centre: Centre, covariance: np.ndarray, components: int) -> "Whitening":
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        floor = len(values) * np.finfo(float).eps * max(float(values.max()), 0.0)
        # a variance of zero to double precision cannot be divided by
        variances = np.where(values[order] > floor, values[order], 0.0)
        return cls(centre, vectors[:, order], variances, float(np.trace(covariance)))

    def apply(self, x: np.ndarray) -> np.ndarray:
        """The whitened rows; NaN where a component has no variance."""
        scale = np.where(self.variances > 0, 1 / np.sqrt(np.where(self.variances > 0, self.variances, 1)), np.nan)
        return (self.centre.offsets(x) @ self.components) * scale

    def explained(self) -> list[float]:
        return [float(e) / self.trace if self.trace > 0 else 0.0 for e in self.variances]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each length of vectors in (code, weight), whose rows are the fit list."""
    sums = _collected(distinct.mapInArrow(_sums, "dims int, place int, total decimal(38,0)"))
    # a list of no weight has no mean
    centres = {d: Centre.of(int(rows[0][1]), [int(t) for _, t in rows[1:]]) for d, rows in sums.items() if int(rows[0][1]) > 0}
    products = _collected(distinct.where("weight > 0").mapInArrow(_products(centres), "dims int, place int, total double"))
    return {d: Whitening.of(c, _matrix(products[d], d) / c.n, components) for d, c in centres.items()}


def _whiten(models: dict[int, Whitening]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code")
            for places, x in decode(codes.to_pylist()):
                model = models[x.shape[1]]
                z = model.apply(x)
                k = z.shape[1]
                values = pa.array(z.reshape(-1), from_pandas=True)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * k, pa.int32()), values)
                at = pa.array(places)
                yield pa.RecordBatch.from_arrays([
                    codes.take(at), batch.column("weight").take(at), batch.column("copies").take(at),
                    pa.array(np.full(len(z), x.shape[1]), pa.int32()), pa.array(model.centre.deviations(x), pa.int64()), lists],
                    names=["code", "weight", "copies", "dims", "deviation", "whitened"])
    return run


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for dims, z, weight in _stored(batches):
        total = (z * weight[:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(total), dims), pa.int32()), pa.array(range(len(total)), pa.int32()), pa.array(total)],
            names=["dims", "place", "total"])


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dims, whitened rows, weights); components without variance are left out."""
    for batch in batches:
        dims, weight = batch.column("dims").to_numpy(), _weights(batch)
        for d in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == d)
            z = batch.column("whitened").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            yield d, z[:, ~np.isnan(z[0])], weight[rows]


def _spread(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for d, z, weight in _stored(batches):
            if d in centres:
                y = z - centres[d]
                product = (y * weight[:, None]).T @ y
                found[d] = found[d] + product if d in found else product
        yield from _upper(found)
    return run


def identity_errors(whitened: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Largest absolute entry of the whitened covariance minus the identity, by length of vectors."""
    schema = "dims int, place int, total double"
    means = {d: np.array([t for _, t in rows]) / models[d].centre.n for d, rows in _collected(whitened.mapInArrow(_means, schema)).items()}
    errors = {d: 0.0 for d in models}
    for d, rows in _collected(whitened.where("weight > 0").mapInArrow(_spread(means), schema)).items():
        size = len(means[d])
        errors[d] = float(np.abs(_matrix(rows, size) / models[d].centre.n - np.eye(size)).max())
    return errors


def whitened_components(vectors: DataFrame, components: int = COMPONENTS, weights: str = "one",
                        hot_share: float = HOT_SHARE) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``vectors``: vec_id, embedding; other columns are ignored. ``weights``: ``one`` fits on every distinct
    vector once, ``count`` on every vector as often as it stands. Rows whose vector is null or empty, or
    holds null, infinite or not-a-number entries, are dropped, as are entries too large for a long. Every
    other row is returned, repeated ids and null ids too. Vectors of different lengths are fitted apart, each
    length with its own n. A component whose variance is zero to double precision has null in ``whitened`` and takes
    no part in ``identity_error``; a deviation beyond a long is null. An empty table gives an empty result.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    coded = scratch.store(plain.mapInArrow(_code, f"vec_id {kind}, code binary"), "coded")
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    distinct = scratch.store(coded.groupBy("code").agg(F.count("*").alias("copies")).withColumn("weight", weight), "distinct")
    models = fit(distinct, components)
    kinds = "code binary, weight long, copies long, dims int, deviation long, whitened array<double>"
    whitened = scratch.store(distinct.mapInArrow(_whiten(models), kinds), "whitened")
    errors = identity_errors(whitened, models)
    notes = spark.createDataFrame(
        [(d, m.centre.n, errors[d], m.explained()) for d, m in models.items()],
        "dims int, n long, identity_error double, explained array<double>")
    # one row per length of vectors, checked like any table
    known = whitened.drop("weight").join(broadcast_if_small(notes), "dims")
    rows = coded.count()
    hot = scratch.store(known.where(F.col("copies") > max(1.0, hot_share * rows)), "hot")
    # at most 1 / hot_share rows
    often = coded.join(F.broadcast(hot), "code")
    seldom = coded.join(F.broadcast(hot.select("code")), "code", "left_anti").join(
        known.where(F.col("copies") <= max(1.0, hot_share * rows)), "code")
    both = often.unionByName(seldom)
    each = both.select("vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("at")).alias("explained"), "identity_error")
