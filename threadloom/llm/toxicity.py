"""Convolutional text classifier on hashed word embeddings, trained in numpy.

A word's embedding is the sum of the rows that its hash and those of its leading and trailing bytes
select. Filters of several widths run over the words, their maxima over the whole text enter one logistic
unit. The threshold is calibrated for each language, which is guessed from the text's function words.

Only labelled rows enter training: at most ``MAX_PER_CLASS`` of each class, chosen by a hash of the id. The
model is a few megabytes whatever the corpus, and scoring is one pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.words import ALNUM, hash_words, span_hashes, text_bytes, words_of

#: Bound on the labelled rows of each class that are used for fitting.
MAX_PER_CLASS = 2000
BUCKETS = 1 << 15
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
EPOCHS = 6
BATCH = 64
RATE = 0.02
#: A row of the embedding is trained if this many sampled texts select it.
MIN_TEXTS = 4
#: Texts of a language needed, of each class, for a threshold of its own.
MIN_CALIBRATION = 12
#: Logits by which a threshold exceeds that of a text of unknown words.
FLOOR_MARGIN = 0.5
#: Byte lengths of the parts of a word that are hashed beside the word: leading, then trailing.
LEADING, TRAILING = (4, 6, 8), (4,)

# --- fixed values: frequent function words --------------------------------------------------
FUNCTION_WORDS = {
    "de": "der die und das den von mit ist nicht ein eine zu sich auf",
    "en": "the of and to in that is was for with this are from by",
    "es": "el los las y en una del por con para es no que como",
    "fr": "le les et des du un une est qui dans par pour sur pas",
}
# --------------------------------------------------------------------------------------------
LANGUAGES = tuple(FUNCTION_WORDS)


def _hash_list(words: str) -> np.ndarray:
    data, offsets = text_bytes(pa.array([words]))
    return np.sort(hash_words(data, offsets, ALNUM).hashes)


def buckets(words, index: np.ndarray) -> np.ndarray:
    """Rows of the embedding that the words at ``index`` select: (len(index), 1 + parts)."""
    starts, ends = words.starts[index], words.ends[index]
    columns = [words.hashes[index]]
    for n, salt in zip(LEADING, (3, 5, 7)):
        columns.append(span_hashes(words.folded, starts, np.minimum(starts + n, ends)) ^ np.uint64(salt))
    for n in TRAILING:
        columns.append(span_hashes(words.folded, np.maximum(ends - n, starts), ends) ^ np.uint64(11))
    return (np.stack(columns, axis=1) % np.uint64(BUCKETS)).astype(np.int64)


def languages(words, distinct: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Index into LANGUAGES of each text's most frequent function words; -1 without any."""
    n = len(words.bounds) - 1
    row = np.repeat(np.arange(n), np.diff(words.bounds))
    counts = np.stack([np.bincount(row, weights=np.isin(distinct, _hash_list(FUNCTION_WORDS[lang]))[inverse], minlength=n) for lang in LANGUAGES])
    return np.where(counts.max(axis=0) > 0, counts.argmax(axis=0), -1)


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    weights: np.ndarray
    bias: float = 0.0
    #: logit from which a text counts as positive, by language index; -1 is any other
    thresholds: dict[int, float] = field(default_factory=dict)

    def pooled(self, projected: list[list[np.ndarray]], index: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, None]:
        """Maxima over each text: projected[w][j] holds a filter's share for each distinct word."""
        n = len(bounds) - 1
        out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        lengths = np.diff(bounds)
        for w, width in enumerate(WIDTHS):
            fits = np.flatnonzero(lengths >= width)
            if not len(fits):
                continue
            runs = len(index) - width + 1
            value = projected[w][0][index[:runs]]
            for j in range(1, width):
                value += projected[w][j][index[j:j + runs]]
            # places where a run would leave its text are excluded
            for j in range(1, width):
                beyond = bounds[1:-1] - j
                value[beyond[(beyond >= 0) & (beyond < runs)]] = -np.inf
            best = np.maximum.reduceat(value, np.minimum(bounds[:-1][fits], runs - 1), axis=0)
            out[fits, w * FILTERS:(w + 1) * FILTERS] = np.maximum(best + self.offsets[w], 0)
        return out

    def logits(self, words) -> tuple[np.ndarray, np.ndarray]:
        """(logit, language) of each text."""
        distinct, example, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        vectors = self.embedding[buckets(words, example)].sum(axis=1) if len(distinct) else np.zeros((0, DIM), np.float32)
        projected = [[vectors @ f[j] for j in range(len(f))] for f in self.filters]
        features = self.pooled(projected, inverse, words.bounds)
        return features @ self.weights + self.bias, languages(words, distinct, inverse)

    def scores(self, logit: np.ndarray, language: np.ndarray) -> np.ndarray:
        """0.5 exactly at the threshold of the text's language."""
        cut = np.array([self.thresholds.get(int(x), self.thresholds.get(-1, 0.0)) for x in language])
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64) - cut, -30, 30)))


def fit(texts: pa.Array, labels: np.ndarray, class_weights: tuple[float, float] = (1.0, 1.0), seed: int = 7) -> Model | None:
    """A classifier for 0/1 ``labels``; None unless both occur. A fifth of the rows only calibrates."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    # slice by slice, so that only hashes of the whole sample are held
    parts = [words for _, _, words in words_of(texts, ALNUM)]
    distinct, inverse = np.unique(np.concatenate([p.hashes for p in parts]), return_inverse=True)
    rows = np.zeros((len(distinct), 1 + len(LEADING) + len(TRAILING)), np.int32)
    for part in parts:
        seen, example = np.unique(part.hashes, return_index=True)
        rows[np.searchsorted(distinct, seen)] = buckets(part, example)
    n, bounds = len(labels), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.bounds) for p in parts]))])
    calibrating = np.arange(n) % 5 == 0
    owner = np.repeat(np.arange(n), np.diff(bounds))
    texts_with = np.zeros(BUCKETS, np.int64)
    for c in range(rows.shape[1]):
        pair = np.unique(rows[inverse, c].astype(np.int64) * n + owner) if len(owner) else np.zeros(0, np.int64)
        texts_with += np.bincount(pair // n, minlength=BUCKETS)
    trained = (texts_with >= MIN_TEXTS)[:, None].astype(np.float32)
    model = Model(np.zeros((BUCKETS, DIM), np.float32),
                  [rng.normal(0, 0.5 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  [np.full(FILTERS, 0.1, np.float32) for _ in WIDTHS],
                  rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32))
    params = {"embedding": model.embedding, "weights": model.weights}
    params |= {f"filters{w}": f for w, f in enumerate(model.filters)} | {f"offsets{w}": o for w, o in enumerate(model.offsets)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    training, step, bias_m, bias_v = np.flatnonzero(~calibrating), 0, 0.0, 0.0
    for _ in range(EPOCHS):
        order = rng.permutation(training)
        for chosen in np.array_split(order, max(1, len(order) // BATCH)):
            step += 1
            chosen = chosen[np.argsort(chosen)]
            index = np.concatenate([inverse[bounds[i]:bounds[i + 1]] for i in chosen]) if len(chosen) else inverse[:0]
            lengths = np.diff(bounds)[chosen]
            cut = np.concatenate([[0], np.cumsum(lengths)])
            x = model.embedding[rows[index]].sum(axis=1)
            grads = {k: np.zeros_like(v) for k, v in params.items()}
            features = np.zeros((len(chosen), len(WIDTHS) * FILTERS), np.float32)
            places = []
            for w, width in enumerate(WIDTHS):
                at = np.zeros((len(chosen), FILTERS), np.int64)
                for d in range(len(chosen)):
                    runs = lengths[d] - width + 1
                    if runs < 1:
                        at[d] = -1
                        continue
                    value = x[cut[d]:cut[d] + runs] @ model.filters[w][0]
                    for j in range(1, width):
                        value += x[cut[d] + j:cut[d] + j + runs] @ model.filters[w][j]
                    best = value.argmax(axis=0)
                    at[d] = cut[d] + best
                    features[d, w * FILTERS:(w + 1) * FILTERS] = value[best, np.arange(FILTERS)] + model.offsets[w]
                places.append(at)
            np.maximum(features, 0, out=features)
            logit = features @ model.weights + model.bias
            y = labels[chosen].astype(np.float32)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y).astype(np.float32) / len(chosen)
            grads["weights"] = features.T @ error
            back = error[:, None] * model.weights[None, :] * (features > 0)
            gx_places, gx_values = [], []
            for w, width in enumerate(WIDTHS):
                g = back[:, w * FILTERS:(w + 1) * FILTERS]
                grads[f"offsets{w}"] = g.sum(axis=0)
                used = places[w] >= 0
                d, f = np.nonzero(used & (g != 0))
                at, gv = places[w][d, f], g[d, f]
                for j in range(width):
                    np.add.at(grads[f"filters{w}"][j].T, f, gv[:, None] * x[at + j])
                    gx_places.append(at + j)
                    gx_values.append(gv[:, None] * model.filters[w][j][:, f].T)
            if gx_places:
                at, value = np.concatenate(gx_places), np.concatenate(gx_values)
                spots, back_to = np.unique(at, return_inverse=True)
                merged = np.stack([np.bincount(back_to, weights=value[:, c], minlength=len(spots)) for c in range(DIM)], axis=1).astype(np.float32)
                for c in range(rows.shape[1]):
                    np.add.at(grads["embedding"], rows[index[spots], c], merged)
                grads["embedding"] *= trained
            correct1, correct2 = 1 - 0.9 ** step, 1 - 0.999 ** step
            for name, value in params.items():
                m, v = moments[name]
                m *= 0.9
                m += 0.1 * grads[name]
                v *= 0.999
                v += 0.001 * grads[name] ** 2
                value -= (RATE * (m / correct1) / (np.sqrt(v / correct2) + 1e-6)).astype(np.float32)
            model.embedding *= 1 - 1e-3
            slope = float(error.sum())
            bias_m, bias_v = 0.9 * bias_m + 0.1 * slope, 0.999 * bias_v + 0.001 * slope ** 2
            model.bias -= RATE * (bias_m / correct1) / (np.sqrt(bias_v / correct2) + 1e-6)
    # a text without a word of the training texts is no evidence, so no threshold is below its logit
    unknown = np.concatenate([np.maximum(o, 0) for o in model.offsets])
    floor = max(model.bias, float(unknown @ model.weights + model.bias)) + FLOOR_MARGIN
    logit, language = (np.concatenate(x) for x in zip(*(model.logits(p) for p in parts)))
    weight = np.where(labels == 1, class_weights[1], class_weights[0])
    everyone = best_threshold(logit[calibrating], labels[calibrating], weight[calibrating])
    model.thresholds = {-1: everyone}
    for code in range(len(LANGUAGES)):
        mine = calibrating & (language == code)
        if min(np.sum(labels[mine] == 1), np.sum(labels[mine] == 0)) >= MIN_CALIBRATION:
            model.thresholds[code] = best_threshold(logit[mine], labels[mine], weight[mine])
    model.thresholds = {code: max(cut, floor) for code, cut in model.thresholds.items()}
    return model


def best_threshold(logit: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the cut with the best weighted F1."""
    if not len(logit) or not (labels == 1).any():
        return 0.0
    order = np.argsort(-logit, kind="stable")
    value, hit, w = logit[order], labels[order] == 1, weight[order]
    caught = np.cumsum(np.where(hit, w, 0))
    flagged = np.cumsum(w)
    f1 = 2 * caught / (flagged + caught[-1])
    f1[:-1][value[:-1] == value[1:]] = -1
    best = int(f1.argmax())
    return float((value[best] + value[best + 1]) / 2) if best + 1 < len(value) else float(value[best] - 1)


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words in words_of(batch.column(1), ALNUM):
                if model is None:
                    score, language = np.zeros(last - first), np.full(last - first, -1)
                else:
                    logit, language = model.logits(words)
                    score = model.scores(logit, language)
                guessed = pa.array([LANGUAGES[i] if i >= 0 else None for i in language.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(score), guessed], names=["key", "score", "guessed_lang"])
    return run


def held_out(doc_id):
    """Whether a document's label is kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_per_class: int = MAX_PER_CLASS) -> Model | None:
    """Fits the classifier on labelled rows that are not held out.

    ``docs`` has doc_id and text, ``labels`` doc_id and ``label`` (0, 1; other values are ignored).
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    totals = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    chosen = [usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class) for y in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most 2 * max_per_class rows of two numbers
    rows = named.join(F.broadcast(sample), "doc_id").toArrow().combine_chunks()
    if not rows.num_rows:
        return None
    order = np.lexsort((rows["doc_id"].to_numpy(), rows["doc_id"].to_numpy() * 2654435761 % 1000003))
    rows = rows.take(pa.array(order))
    y = rows["y"].to_numpy().astype(np.int64)
    weights = tuple(totals[c] / max(1, int((y == c).sum())) for c in (0, 1))
    return fit(rows["text"].combine_chunks(), y, weights)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """key, score, predicted (1 from score 0.5), guessed_lang for every row of ``docs`` (key, text).

    Null and empty texts are scored as texts without words. Without a model every score is 0.
    """
    kind = docs.schema[key].dataType.simpleString()
    scored = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score(model), f"key {kind}, score double, guessed_lang string")
    return scored.select(F.col("key").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "guessed_lang")


def keep_clean(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that are not predicted positive, with all their columns, in one pass."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(names.index("text"))
            keep = np.ones(batch.num_rows, bool)
            if model is not None:
                for first, last, words in words_of(text, ALNUM):
                    logit, language = model.logits(words)
                    keep[first:last] = model.scores(logit, language) < 0.5
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
