"""Nearest neighbours by cosine over a stored index, exactly, and what is computed from them."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from threadloom.operators.ordering import exact_median
from threadloom.operators.threads import one_row
from threadloom.session import shared_dir

#: A search task compares about this many corpus rows with this many query rows, whatever the size of a block.
BLOCK_ROWS, QUERY_ROWS = 16_384, 4096
#: Elements of a score matrix held at once, and hits that wait to be cut to the best of each query.
SCORES, HITS = 1_000_000, 200_000
MAX_CLASSES = 1000
# Corpus columns and the softmax temperature.
CORPUS_COLUMNS = ["interaction_id", "conversation_id", "customer_message", "brand_response"]
TEMPERATURE = 10.0

_HITS = "query_id bigint, corpus_id bigint, similarity double"
_STORED = "block int, corpus_id bigint, vector array<double>, code binary, scale double, error double"


@dataclass(frozen=True)
class VectorIndex:
    """Unit vectors of a corpus, stored in blocks: block, corpus_id, vector, and a code of one byte for each dimension.

    A code stands for ``scale`` times its bytes, in rotated dimensions; ``error`` is its exact distance from the
    rotated vector, so a cosine taken from the code is off by no more than that.
    """

    table: DataFrame
    blocks: int
    model_name: str


def unit_vector(vector: Column) -> Column:
    """The vector in double precision and of length 1; a zero vector stays zero."""
    doubles = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(doubles, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))


def rotation(dims: int) -> np.ndarray:
    """A fixed rotation; it spreads a vector evenly over its dimensions, which one-byte codes need."""
    return np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))[0]


def _codes(vectors: pd.Series) -> pd.DataFrame:
    code: list = [b""] * len(vectors)
    scale, error = np.zeros(len(vectors)), np.zeros(len(vectors))
    sizes = vectors.map(len).to_numpy()
    for dims in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dims)
        if dims:
            turned = _matrix(vectors.iloc[rows]) @ rotation(dims)
            step = np.abs(turned).max(axis=1) / 127
            whole = np.rint(turned / np.where(step > 0, step, 1)[:, None]).astype(np.int8)
            scale[rows], error[rows] = step, np.linalg.norm(turned - step[:, None] * whole, axis=1)
            for r, w in zip(rows.tolist(), whole):
                code[r] = w.tobytes()
    return pd.DataFrame({"code": code, "scale": scale, "error": error})


def build_index(corpus: DataFrame, path: str, model_name: str, block_rows: int = BLOCK_ROWS) -> VectorIndex:
    """Normalise (corpus_id, vector), deal the rows into blocks by id and store them with their codes and the model's name.

    The corpus is counted and written once; searches only read. Any block size gives the same results.
    """
    blocks = max(1, math.ceil(corpus.count() / block_rows))
    block = F.pmod(F.xxhash64("corpus_id"), F.lit(blocks)).cast("int")
    rows = corpus.select(block.alias("block"), "corpus_id", unit_vector(F.col("vector")).alias("vector")).repartition("block")
    coded = F.pandas_udf(_codes, "code binary, scale double, error double")
    rows.withColumn("c", coded("vector")).select("block", "corpus_id", "vector", "c.*").write.mode("overwrite").parquet(f"{path}/vectors")
    spark = corpus.sparkSession
    spark.createDataFrame([(model_name, blocks)], "model_name string, blocks int").write.mode("overwrite").json(f"{path}/meta")
    return load_index(spark, path, model_name)


def load_index(spark: SparkSession, path: str, model_name: str) -> VectorIndex:
    """A stored index; one of another model is refused, and Spark raises when the path does not exist."""
    meta = spark.read.schema("model_name string, blocks int").json(f"{path}/meta").first()
    if meta["model_name"] != model_name:
        raise ValueError(f"the index holds vectors of {meta['model_name']}, not of {model_name}")
    return VectorIndex(spark.read.schema(_STORED).parquet(f"{path}/vectors"), meta["blocks"], model_name)


def _candidates(q: pd.DataFrame, c: pd.DataFrame, k: int, exclude_same_id: bool):
    """(queries, row, column) of the pairs that the codes cannot rule out, for parts of the queries of a task.

    A pair goes if the most its cosine can be is below the k-th of what the block's cosines are at least.
    """
    ids, own = c["corpus_id"].to_numpy(), q["query_id"].to_numpy()
    dims = len(c["vector"].iloc[0])
    codes = np.frombuffer(b"".join(c["code"]), np.int8).reshape(len(c), dims).astype(np.float32)
    codes *= c["scale"].to_numpy(np.float32)[:, None]
    # the codes' own error, and what single precision adds to it
    slack = c["error"].to_numpy() + (dims + 8) * 2.0**-22
    turned = (_matrix(q["vector"]) @ rotation(dims)).astype(np.float32)
    step = max(1, SCORES // len(c))
    for start in range(0, len(q), step):
        near = (turned[start:start + step] @ codes.T).astype(np.float64)
        if exclude_same_id:
            near[own[start:start + step, None] == ids[None, :]] = -np.inf
        if k < len(c):
            floor = np.partition(near - slack, len(c) - k, axis=1)[:, len(c) - k]
            row, column = np.nonzero(near + slack >= floor[:, None])
        else:
            row, column = np.nonzero(np.ones(near.shape, bool))
        finite = np.isfinite(near[row, column])
        yield own[start:start + step], row[finite] + start, column[finite]


def _placed(queries: DataFrame, index: VectorIndex, query_rows: int):
    """Both sides of a search, grouped by (part, chunk): a part is as many blocks as one task takes.

    Every row is sent once for each part or chunk of the other side, so their numbers follow the rows, not the blocks.
    """
    chunks = max(1, math.ceil(queries.count() / max(query_rows, QUERY_ROWS)))
    parts = max(1, min(index.blocks, math.ceil(index.table.count() / BLOCK_ROWS)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select(
        "query_id", unit_vector(F.col("vector")).alias("vector"),
        F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int").alias("chunk")).withColumn("part", every(parts))
    right = index.table.withColumn("part", F.col("block") % parts).withColumn("chunk", every(chunks))
    return left.groupBy("part", "chunk").cogroup(right.groupBy("part", "chunk"))


def _blocks(c: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The blocks of a task, one after the other."""
    for _, block in c.groupby("block", sort=False):
        yield block


def _best(query: np.ndarray, corpus: np.ndarray, similarity: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best hits of each query; ties go to the smaller corpus id."""
    order = np.lexsort((corpus, -similarity, query))
    query, corpus, similarity = query[order], corpus[order], similarity[order]
    best = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[best], corpus[best], similarity[best]


def search(queries: DataFrame, index: VectorIndex, k: int, exclude_same_id: bool = False,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, corpus_id, similarity, rank): the k best corpus rows of every query by cosine, exactly.

    ``queries``: query_id, vector of any length. A stated set of queries meets the whole corpus block by
    block: a task takes some blocks, one after the other, and one chunk of queries, compares them on the codes, takes
    the exact cosine of the pairs that the codes leave open, and hands on k rows per query. Ties go to the smaller corpus id.
    """
    def top_k(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found, waiting = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), []
        if len(q) and len(c):
            # a query row is told by its place, as its id may repeat
            asked, names = _matrix(q["vector"]), q["query_id"].to_numpy()
            for block in _blocks(c):
                ids, vectors = block["corpus_id"].to_numpy(), _matrix(block["vector"])
                for _, row, column in _candidates(q, block, k, exclude_same_id):
                    exact = np.empty(len(row))
                    for start in range(0, len(row), SCORES // 64):
                        part = slice(start, start + SCORES // 64)
                        exact[part] = np.einsum("ij,ij->i", asked[row[part]], vectors[column[part]])
                    waiting.append(_best(row, ids[column], np.round(exact, 12), k))
                    if sum(len(w[0]) for w in waiting) > HITS:
                        found, waiting = _best(*map(np.concatenate, zip(found, *waiting)), k), []
            found = _best(*map(np.concatenate, zip(found, *waiting)), k)
            found = names[found[0]], found[1], found[2]
        return pd.DataFrame({"query_id": found[0], "corpus_id": found[1], "similarity": found[2]})

    return rank_hits(_placed(queries, index, query_rows).applyInPandas(top_k, _HITS), k)


def search_effort(queries: DataFrame, index: VectorIndex, k: int, query_rows: int = QUERY_ROWS) -> DataFrame:
    """One row: queries, pairs compared on codes, and pairs of which the exact cosine is taken."""
    def count(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        refined = sum(len(row) for block in _blocks(c) for _, row, _ in _candidates(q, block, k, False)) if len(q) and len(c) else 0
        return pd.DataFrame({"pairs": [len(q) * len(c)], "refined": [refined]})

    counts = _placed(queries, index, query_rows).applyInPandas(count, "pairs long, refined long").agg(
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("refined"), F.lit(0)).alias("refined"))
    return one_row(queries.agg(F.count("*").alias("queries")), counts)


def knn_join(queries: DataFrame, corpus: DataFrame, k: int, exclude_same_id: bool = False,
             block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``search`` over an index that is built for this one call."""
    path = f"{shared_dir(corpus.sparkSession)}/index-{uuid.uuid4().hex}"
    return search(queries, build_index(corpus, path, "unnamed", block_rows), k, exclude_same_id, query_rows)


def rank_hits(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits per query; the row_number filter is applied in part before the shuffle."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("similarity"), "corpus_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def retrieval_corpus(inter: DataFrame) -> DataFrame:
    """The four corpus columns; a missing column or an empty input is an error."""
    missing = [c for c in CORPUS_COLUMNS if c not in inter.columns]
    if missing:
        raise ValueError(f"corpus lacks columns {missing}")
    if inter.isEmpty():
        raise ValueError("the retrieval corpus is empty")
    return inter.select(*CORPUS_COLUMNS)


def save_corpus(corpus: DataFrame, path: str, model_name: str) -> None:
    corpus.withColumn("model_name", F.lit(model_name)).write.mode("overwrite").parquet(path)


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """A stored corpus; Spark raises when the path does not exist."""
    return spark.read.parquet(path)


def retrieval_diagnostics(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """One row: number of queries, top-1 mean/median/min/max and the mean over all hits."""
    top = hits.where("rank = 1")
    zero = F.lit(0.0)

    def rounded(value: Column, name: str) -> Column:
        return F.coalesce(F.round(value, 6), zero).alias(name)

    first = F.when(F.col("rank") == 1, F.col("similarity"))
    stats = hits.agg(
        rounded(F.avg(first), "mean_top1"), rounded(F.min(first), "min_top1"),
        rounded(F.max(first), "max_top1"), rounded(F.avg("similarity"), "mean_topk"))
    median = exact_median(top, "similarity").select(rounded(F.col("median"), "median_top1"))
    return one_row(queries.agg(F.count("*").alias("num_queries")), stats, median)


def class_matrix(classes: DataFrame) -> tuple[list[str], np.ndarray]:
    """Class names and unit vectors of a taxonomy-sized (class_id, vector) table."""
    rows = classes.orderBy("class_id").limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    vectors = np.array([np.asarray(r["vector"], dtype=float) for r in rows])
    return [r["class_id"] for r in rows], vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def class_means(df: DataFrame, label: str, vector: str = "vector") -> DataFrame:
    """Mean vector per label, summed dimension by dimension in the JVM."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    doubles = array_to_vector(F.col(vector).cast("array<double>"))
    means = df.groupBy(F.col(label).alias("class_id")).agg(Summarizer.mean(doubles).alias("m"))
    return means.select("class_id", vector_to_array("m").alias("vector"))


def zero_shot(df: DataFrame, classes: DataFrame, vector: str = "vector") -> DataFrame:
    """Adds ``predicted_class`` (best cosine, first on ties) and ``confidence`` (softmax of 10 cos)."""
    names, matrix = class_matrix(classes)

    @F.pandas_udf("no int, confidence double")
    def classify(v: pd.Series) -> pd.DataFrame:
        cosine = np.round(_matrix(v) @ matrix.T, 12)
        best = cosine.argmax(axis=1)
        weights = np.exp(cosine * TEMPERATURE)
        share = weights[np.arange(len(best)), best] / weights.sum(axis=1)
        return pd.DataFrame({"no": best.astype("int32"), "confidence": share})

    labels = F.array(*[F.lit(n) for n in names])
    return df.withColumn("c", classify(F.col(vector))).withColumn(
        "predicted_class", F.element_at(labels, F.col("c.no") + 1)).withColumn(
        "confidence", F.col("c.confidence")).drop("c")
