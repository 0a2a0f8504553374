"""Filter audit, quality votes and whitening against brute force and held-out labels."""

import random
import re
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import filter_audit, quality_votes, queries, whitening

# --- filter audit --------------------------------------------------------------------------


def own_fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tests = [len(words) < 200, 100 * len(set(words)) < 50 * len(words),
             100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text))]
    return "".join(f for f, bad in zip("ABCD", tests) if bad)


def audit_by_hand(docs, labels):
    """Applies the filters document by document in every order."""
    docs = [(i, t or "", s or "") for i, t, s in docs]
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t] = min(i, first.get(t, i))
    fails = [own_fails(t) + ("E" if i is not None and i > first[t] else "") for i, t, _ in docs]
    out = {}
    for part in {s for _, _, s in docs}:
        mine = [(i, f) for (i, _, s), f in zip(docs, fails) if s == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(range(len(mine)))
            for step, f in enumerate(order, 1):
                here = [d for d in left if f in mine[d][1]]
                left = [d for d in left if f not in mine[d][1]]
                removed_by[f] += len(here)
                good, toxic = (sum((mine[d][0], k) in labels for d in here) for k in ("good", "toxic"))
                failing = sum(f in m for _, m in mine)
                out[part, "".join(order), step] = [
                    len(left), len(here), failing - len(here), sum(m == f for _, m in mine), good, toxic]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


def odd_documents():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.sample(words, 260)), " ".join(rng.choices(words[:40], k=230)), " ".join(rng.sample(words, 250)).upper(),
             "short text", "a | b", "", None, " \t\n ", "É" * 300, " ".join(rng.sample(words, 220)) + " & more", "nul \x00 inside", "AbcdEf" * 10]
    docs = [(n, rng.choice(texts), rng.choice(["s1", "s2", "", None])) for n in range(120)]
    # repeated ids and rows, null ids, a very long text
    docs += [(3, docs[3][1], "s2"), (3, docs[3][1], docs[3][2]), (None, texts[0], "s1"), (None, texts[0], "s1"), (-5, texts[3], "s3"),
             (500, "z " * 300_000, "s3"), (501, "z " * 300_000, "s3")]
    labels = [(n, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for n in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (500, 1, 1)]
    return docs, labels


def test_filter_audit_equals_every_order_applied(spark):
    docs, labels = odd_documents()
    label_set = {(i, "good") for i, g, _ in labels if g == 1 and i is not None} | {(i, "toxic") for i, _, t in labels if t == 1 and i is not None}
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, source string, part string, mask int").repartition(5)
    ldf = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.filter_audit(df, ldf)
    assert got.columns == ["part", "filter_order", "step", *filter_audit.OUTCOMES, "shapley"]
    rows = {tuple(r)[:3]: list(r)[3:] for r in got.collect()}
    assert rows == audit_by_hand(docs, label_set)
    assert filter_audit.filter_audit(df.limit(0), ldf).count() == 0
    none = filter_audit.filter_audit(df, ldf.limit(0)).agg({"good_lost": "max", "toxic_lost": "max"}).first()
    assert tuple(none) == (0, 0)


def test_packed_fields_do_not_carry():
    largest = (1 << 63) - 1
    total = sum(filter_audit.packed(mask) * (largest // filter_audit.MASKS) for mask in range(filter_audit.MASKS))
    fields = filter_audit.unpack(total)
    expected = np.array([filter_audit.outcomes(mask) for mask in range(filter_audit.MASKS)]).sum(axis=0)
    assert (fields.reshape(-1) == expected * (largest // filter_audit.MASKS)).all()
    everyone = filter_audit.unpack(filter_audit.packed(31 | filter_audit.GOOD) * largest)
    assert set(everyone[1].tolist()) == {0, largest}


def test_filter_audit_parts_add_up(spark, sf):
    table = queries.QUERIES["op11_filter_audit"](spark, sf)
    rows = table.collect()
    per_part = {}
    for r in rows:
        per_part.setdefault((r.part, r.filter_order), []).append(r)
    sizes = {r["source"]: r["n"] for r in spark.read.parquet(f"{sf}/documents.parquet").groupBy("source").count().withColumnRenamed("count", "n").collect()}
    assert len(rows) == 600 * len(sizes) and len(per_part) == 120 * len(sizes)
    for (part, _), steps in per_part.items():
        last = max(steps, key=lambda r: r.step)
        assert last.kept + sum(r.removed for r in steps) == sizes[part]
        # the five shares add up to what all filters remove, over 120 orders
        assert sum(r.shapley for r in steps) == 120 * (sizes[part] - last.kept)


# --- quality votes -------------------------------------------------------------------------


def test_quality_of_held_out_labels(spark, sf):
    got = {r.doc_id: r for r in queries.QUERIES["op12_quality_votes"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels if got[r.doc_id].held_out]
    good, bad = [p for p, y in held if y == 1], [p for p, y in held if y == 0]
    assert len(bad) > 10 and sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.2


def test_votes_equal_a_loop_over_labelled_vectors():
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, 40)
    vectors = quality_votes._units(rng.normal(size=(40, 5)))
    vectors[7] = vectors[8] = vectors[9]
    own = np.where(labels == 1, 2.0, 1.0)
    model = quality_votes.Model(np.ones(1), np.zeros((1, 5)), vectors, np.stack([own * labels, own], axis=1), 0.7, 0.3)
    texts = quality_votes._units(np.vstack([rng.normal(size=(700, 5)), vectors[8:9], np.zeros((1, 5))]))
    got = model.shares(texts)
    for text, share in zip(texts, got):
        cosine = sorted(((float(text @ v), w, y) for v, w, y in zip(vectors, own, labels)), reverse=True)
        least = cosine[quality_votes.NEIGHBOURS - 1][0]
        votes = [(max(c, 0) ** quality_votes.SHARPNESS * w, y) for c, w, y in cosine if c >= least - quality_votes.TIE]
        total = sum(w for w, _ in votes)
        if total == 0:
            assert np.isnan(share)
        else:
            assert share == pytest.approx(sum(w * y for w, y in votes) / total, abs=1e-4)
    scores = model.scores(np.array([0.0, 0.3, 1.0, np.nan]))
    assert scores.tolist() == [0, 0.5, 1, 0.7]


def test_terms_equal_words_shapes_and_repeats_counted_by_hand():
    def shape(token):
        classes = ["A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" else "0" if "0" <= c <= "9" else c for c in token if ord(c) < 128]
        return "".join(c for i, c in enumerate(classes) if i == 0 or c != classes[i - 1])

    texts = ["Hello WORLD!! hello 12ab", "", "ÉÉ!! é A|b | |", "  x\tx\nx ", "é"]
    data, offsets = quality_votes.text_bytes(pa.array(texts))
    rows, buckets, weights = quality_votes.term_bags(data, offsets)
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shapes = [shape(t) for t in re.findall(r"[^\x20\x09-\x0D]+", text)]
        assert (rows == i).sum() == len(set(words)) + len(set(shapes)) + bool(words)
        counts = sorted([words.count(w) for w in set(words)] + [shapes.count(s) for s in set(shapes)] + [len(words)] * bool(words))
        assert np.allclose(sorted(weights[rows == i]), 1 + np.log(counts))


def test_quality_of_odd_texts(spark):
    rows = [(i, f"plain words number {i} and some more of them here", "x") for i in range(30)]
    rows += [(i, "BUY!! NOW!! CHEAP!! " * 3, "x") for i in range(30, 60)]
    rows += [(60, None, "x"), (61, "", "x"), (None, "plain words", "x"), (62, "qqq zzz", "x"), (5, rows[5][1], "x"), (63, "BUY!! " * 100_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < 30), 1) for i in range(60)] + [(None, 1, 1), (7, None, 1), (999, 1, 1)], "doc_id long, quality int, text int")
    model = quality_votes.train(df, labels)
    got = quality_votes.score(df, model)
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == len(rows)
    scores = {r.doc_id: r.score for r in got.collect()}
    assert all(scores[i] > 0.5 for i in range(30)) and all(scores[i] < 0.5 for i in [*range(30, 60), 63])
    assert scores[60] == scores[61] == model.prior
    assert quality_votes.train(df, labels.limit(0)) is None and {r.score for r in quality_votes.score(df, None).collect()} == {0.5}
    assert quality_votes.train(df, labels.where("doc_id < 30")) is None
    assert quality_votes.score(df.limit(0), model).count() == 0


# --- whitening -----------------------------------------------------------------------------


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


def whiten_by_hand(rows, k=16, weights="one"):
    """(n, deviation, whitened up to sign, explained) of each usable row."""
    kept = [(i, tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)) for i, v in rows if usable(v)]
    fitted = sorted({x for _, x in kept}) if weights == "one" else sorted(x for _, x in kept)
    n, sums = len(fitted), [sum(column) for column in zip(*fitted)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fitted])
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = []
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        z = np.array([(n * a - s) / n for a, s in zip(x, sums)]) @ u / np.sqrt(e)
        out.append((i, n, deviation, z, e / np.trace(cov)))
    return out


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=20) * np.linspace(1, 3, 20)).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)] + [(7, rows[7][1])]
    odd = [(2000, None), (2001, []), (2002, [None] + [1.0] * 19), (2003, [float("nan")] * 20), (2004, [float("inf")] * 20), (2005, [1e300] * 20)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], "vec_id long, embedding array<double>, n long, code string").repartition(4)
    for weights in ("one", "count"):
        got = {}
        for r in whitening.whitened_components(df, weights=weights).collect():
            got.setdefault((r.vec_id, r.n, r.deviation), {}).setdefault(r.component, []).append(r)
        expected = whiten_by_hand(rows, weights=weights)
        assert set(got) == {(i, n, d) for i, n, d, _, _ in expected}
        z = np.array([[got[i, n, d][c][0].whitened for c in range(1, 17)] for i, n, d, _, _ in expected])
        other = np.array([e[3] for e in expected])
        sign = np.sign((z * other).sum(axis=0))
        assert np.allclose(z * sign, other, atol=1e-8)
        one = next(iter(got.values()))
        assert np.allclose([one[c][0].explained for c in range(1, 17)], expected[0][4], rtol=1e-9)
        assert 0 <= one[1][0].identity_error < 1e-9
        assert len(got[7, expected[0][1], next(d for i, _, d, _, _ in expected if i == 7)][1]) == 2


def test_whitening_without_variance_and_of_several_lengths(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.5, 1.0]), (3, [0.5, 1.0]), (4, [1.0]), (None, [3.0]), (5, [2.0 ** 60, 1.0, 1.0]), (6, [-(2.0 ** 55), 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in whitening.whitened_components(df).collect()}
    assert set(got) == {(i, c) for i, v in rows if i != 5 for c in range(1, len(v) + 1)}
    assert [got[i, 1].n for i in (1, 4, None)] == [2, 2, 2] and got[1, 1].deviation == 32 ** 2 and got[1, 2].whitened is None
    assert abs(got[1, 1].whitened) == pytest.approx(1) and got[1, 1].explained == pytest.approx(1) and got[1, 2].explained == 0
    assert got[2, 1].whitened == got[3, 1].whitened == pytest.approx(-got[1, 1].whitened)
    assert got[6, 1].n == 1 and got[6, 1].deviation == 0 and got[6, 1].whitened is None and got[6, 1].identity_error == 0
    assert whitening.whitened_components(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        whitening.whitened_components(df, weights="other")


def test_codes_are_the_vectors():
    rng = np.random.default_rng(2)
    x = np.vstack([rng.integers(-10, 10, (5, 4)), rng.integers(-2**40, 2**40, (5, 4)), rng.integers(-30_000, 30_000, (3, 4)), [[2**62] * 4]]) + whitening.SHIFT
    codes = whitening.encode(x)
    back = np.zeros_like(x)
    for places, part in whitening.decode(codes):
        back[places] = part
    assert (back == x).all() and len(set(codes)) == len({tuple(r) for r in x.tolist()})
    centre = whitening.Centre.of(3, [int(x[:3, j].sum()) for j in range(4)])
    exact = [sum((3 * int(a) - int(s)) ** 2 for a, s in zip(row, x[:3].sum(axis=0))) for row in x]
    assert centre.deviations(x) == [v if v < 2**63 else None for v in exact]


def test_whitened_query_on_the_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    expected = {i: (n, d, z, e) for i, n, d, z, e in whiten_by_hand([tuple(r) for r in rows])}
    got = queries.QUERIES["op13_whitening"](spark, sf).collect()
    assert len(got) == 16 * len(expected) and max(r.identity_error for r in got) < 1e-4
    z = np.array([r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component))]).reshape(-1, 16)
    other = np.array([expected[i][2] for i in sorted(expected)])
    assert np.allclose(z * np.sign((z * other).sum(axis=0)), other, atol=1e-6)
    assert all((r.n, r.deviation) == expected[r.vec_id][:2] for r in got)
