"""N-gram join, vectors and components against brute force."""

import random
import re

import numpy as np
import pytest
from conftest import tuples

from threadloom.llm import ngram_join, vector_dedup
from threadloom.llm.components import components
from threadloom.llm.scratch import Scratch


def union_find(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = union_find(links, ids)
    return sorted((i, len(sets[i]), root[i]) for i in ids)


def test_next_to_no_set_needs_the_last_tile():
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        bands = ngram_join.Bands(percent)
        for size in (20, 60, 200, 600, 1000, 1040, 1250, 5000):
            count = 100
            value = np.sort(rng.integers(0, 1 << 62, size=(count, size)), axis=1).astype(np.uint64).ravel()
            owner, key = ngram_join.tile_keys(value, np.arange(count + 1) * size, bands)
            assert len(owner) < 0.9 * count * size and set(owner.tolist()) == set(range(count))
            # one tile for all sets would be a key that many of them have
            assert np.unique(key, return_counts=True)[1].max() <= 2


def test_bands_are_found_at_any_threshold():
    for percent in (1, 30, 50, 70, 99, 100):
        bands = ngram_join.Bands(percent)
        assert (bands.segments > bands.differences + bands.spare).all()


def near_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for base in range(12):
        words = rng.choices(vocabulary, k=rng.choice([2, 3, 9, 10, 12, 20, 21, 60, 200]))
        for _ in range(rng.choice([1, 3, 12])):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy += rng.choices(vocabulary, k=rng.randrange(3))
            rows.append((n, " ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy)))
            n += 1
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows += [(n + i, passage + " " + " ".join(rng.choices(vocabulary, k=40))) for i in range(15)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "word"), (1004, "WORD"), (1005, "x " * 30000)]
    return rows


@pytest.mark.parametrize("k,percent,block", [(3, 90, 1000), (5, 80, 1000), (3, 70, 4)])
def test_ngram_components_equal_brute_force(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(k * percent)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, rep int, label int").repartition(3)
    assert tuples(ngram_join.ngram_components(docs, k, percent)) == sorted(brute(rows, k, percent), key=repr)


def test_ngram_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(3, "a b c d"), (3, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "z z"), (7, "q")], "doc_id long, text string")
    assert tuples(ngram_join.ngram_components(docs, 3, 90)) == sorted(
        [(3, 2, 1), (3, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (7, 1, 7)], key=repr)
    assert ngram_join.ngram_components(docs.limit(0), 3, 90).count() == 0


def test_sets_without_filled_segments_fall_back_to_other_hashes(monkeypatch):
    bands = ngram_join.Bands(90)
    value, bounds = np.arange(1, 13, dtype=np.uint64), np.array([0, 12])
    plain = set(ngram_join.tile_keys(value, bounds, bands)[1].tolist())
    bands.spare = np.full_like(bands.spare, -1)
    assert plain < set(ngram_join.tile_keys(value, bounds, bands)[1].tolist())


def test_signature_bound_is_an_upper_bound():
    rng = np.random.default_rng(3)
    bands = ngram_join.Bands(90)
    for _ in range(50):
        a = np.unique(rng.integers(1, 400, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(rng.integers(1, 400, rng.integers(1, 300)).astype(np.uint64))
        maps = ngram_join.bitmaps(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands)
        narrow = min(map(len, maps)) // 8
        x, y = (ngram_join._fold(m, narrow)[None] for m in maps)
        _, ok = ngram_join.passing(np.array([len(a)]), x, np.array([len(b)]), y, 50)
        shared = len(np.intersect1d(a, b))
        assert ok[0, 0] or 100 * shared < 50 * (len(a) + len(b) - shared)


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 9), (9, 8), (8, 7), (5, 5)]
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    df = spark.createDataFrame(edges, "a long, b long")
    expected = sorted(union_find([e for e in edges if e[0] != e[1]], nodes).items(), key=repr)
    assert tuples(components(df, Scratch(spark, "t"))) == expected
    assert components(df.limit(0), Scratch(spark, "t")).count() == 0


def brute_vectors(rows, threshold):
    usable = {}
    for n, (i, label, v) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[n] = np.array(v, float)
    links, root_pairs = {n: 0 for n in range(len(rows))}, []
    for a in usable:
        for b in usable:
            if a < b and rows[a][1] == rows[b][1] and len(usable[a]) == len(usable[b]):
                x, y = usable[a], usable[b]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root_pairs.append((rows[a][0], rows[b][0]))
    root = union_find(root_pairs, {r[0] for r in rows if r[0] is not None})
    return sorted([(r[0], links[n], root.get(r[0]), r[0] is not None and root[r[0]] == r[0]) for n, r in enumerate(rows)], key=repr)


@pytest.mark.parametrize("dims,threshold,block", [(64, 0.93, 3000), (20, 0.8, 7), (3, 0.99, 5)])
def test_near_vectors_equal_brute_force(spark, monkeypatch, dims, threshold, block):
    monkeypatch.setattr(vector_dedup, "ROWS", block)
    rng = np.random.default_rng(dims)
    rows = []
    for base in range(25):
        center = rng.normal(size=dims)
        for _ in range(rng.integers(1, 7)):
            v = center + rng.normal(size=dims) * rng.choice([0.05, 0.2, 0.4])
            rows.append((len(rows), int(base % 3), (v * rng.uniform(0.5, 3)).astype(np.float32).tolist()))
    rows += [(len(rows), 0, rows[0][2]), (len(rows) + 1, 1, rows[0][2]), (len(rows) + 2, None, rows[0][2]), (900, 0, None), (901, 0, []),
             (902, 0, [0.0] * dims), (903, 0, [float("nan")] * dims), (904, 0, [None] + [1.0] * (dims - 1)), (905, 0, [float("inf")] * dims),
             (906, 0, rows[0][2][:-1]), (None, 0, rows[0][2]), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, rep string, block int").repartition(3)
    got = vector_dedup.near_vectors(df.select("vec_id", "label", "embedding", "rep", "block"), threshold)
    assert tuples(got) == brute_vectors(rows, threshold)
    assert vector_dedup.near_vectors(df.limit(0), threshold).count() == 0
