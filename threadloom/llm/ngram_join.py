"""N-gram Jaccard join: size bands, tiles with bitmap signatures, exact intersection.

Two texts link when the Jaccard similarity of their sets of word k-grams reaches ``percent``/100.

* A set of n shingles is put into a band of similar sizes, and also into each larger band that may
  hold a partner. Linked sets of a band differ in at most d shingles, so if the shingle space is cut
  into d + 1 + e segments by hash, at least e + 1 segments of linked sets are equal. Each non-empty
  segment of each set is a *tile* key; a set with more than e empty segments repeats this with another
  hash. Texts that share a passage but are not similar do not meet, since a segment mixes shingles from
  all over the text.
* Within a tile, signatures (parity bitmaps of the set) are compared: every differing bit costs a
  differing shingle, so the count of differing bits bounds the overlap from above.
* Pairs that pass have their sorted shingle arrays intersected.

Equal sets are one class throughout, and of tiles with equal members one is kept. Large tiles are cut into blocks and the pairs of blocks are
spread over tasks. A first round verifies one partner per class and block, which joins large groups of
near copies by a linear number of pairs; a second round looks at all pairs that are in different
components after it. No pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.components import components
from threadloom.llm.scratch import Scratch
from threadloom.llm.streams import whole_groups
from threadloom.llm.words import SPACED, mix, rolling, words_of

#: Sizes of a band differ by this factor at most.
BAND_RATIO = 1.3
#: Attempts with another hash for sets with many empty segments. Fewer than a sixth need another one, so that
#: next to none of the sets is left for the one tile of those that no attempt cuts well.
LEVELS = 8
#: Classes of a tile that one block holds, and of a block that are compared at once.
BLOCK, LEFT_ROWS = 2000, 200
#: Bits of a signature per difference allowed in its band.
BITS_PER_DIFFERENCE = 8

SETS = "doc_id long, text_key long, n_shingles long, fp_hi long, fp_lo long, bitmap binary"


def _empty(sizes: np.ndarray, segments: np.ndarray) -> np.ndarray:
    """Empty segments to be expected of sets of these sizes, and a standard deviation more."""
    load = sizes / segments
    return segments * np.exp(-load) + np.sqrt(segments * np.maximum(np.exp(-load) - (1 + load) * np.exp(-2 * load), 0))


class Bands:
    """Size bands for a threshold given in percent."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent = percent
        low = [1]
        while low[-1] <= largest:
            low.append(max(low[-1] + 1, int(low[-1] * BAND_RATIO) + 1))
        self.low = np.array(low, np.int64)
        high = self.low[1:] - 1
        #: the most shingles in which two linked sets of the band (or from below it) can differ
        self.differences = (2 * high * (100 - percent)) // (100 + percent)
        # the smallest set that looks for partners here leaves the most segments empty
        smallest = np.maximum(-(-self.low[:-1] * percent // 100), 1)
        self.spare = 1 + self.differences // 64
        # at low thresholds no number is enough; those sets share the last tile
        most = np.where(self.differences > 0, 2 * (self.differences + 1), 0)
        while (short := (self.spare < most) & (self.spare < _empty(smallest, self.differences + 1 + self.spare))).any():
            self.spare = self.spare + short * np.maximum(self.spare // 64, 1)
        self.segments = self.differences + 1 + self.spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, side="right") - 1

    def bits(self, bands: np.ndarray) -> np.ndarray:
        wanted = np.maximum(BITS_PER_DIFFERENCE * (self.differences[bands] + 1), 64)
        return (1 << np.ceil(np.log2(wanted)).astype(np.int64)).astype(np.int64)


def shingle_sets(words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingles of each text; short texts are one shingle."""
    value, bounds = rolling(words.hashes, words.bounds, k)
    n_words = np.diff(words.bounds)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for i, row in enumerate(short):
            state = np.uint64(n_words[row])
            for h in words.of(row):
                state = mix(np.array([state ^ h], np.uint64))[0]
            whole[i] = state
        row_of = np.concatenate([np.repeat(np.arange(len(n_words)), np.diff(bounds)), short])
        value = np.concatenate([value, whole])
    else:
        row_of = np.repeat(np.arange(len(n_words)), np.diff(bounds))
    order = np.lexsort((value, row_of))
    value, row_of = value[order], row_of[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (row_of[1:] != row_of[:-1])
    value, row_of = value[keep], row_of[keep]
    return value, np.searchsorted(row_of, np.arange(len(n_words) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Wrapping sums of values[bounds[i]:bounds[i+1]]."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def tile_keys(value: np.ndarray, bounds: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key): the tile keys of each set."""
    sizes = np.diff(bounds)
    own = bands.of(np.maximum(sizes, 1))
    owners, keys = [], []
    set_ids = np.flatnonzero(sizes > 0)
    reach = sizes * 100 // bands.percent
    step = 0
    while len(set_ids):
        band = own[set_ids] + step
        near = bands.low[band] <= np.maximum(reach[set_ids], sizes[set_ids])
        set_ids, band = set_ids[near], band[near]
        wanted = bands.differences[band] > 0
        pending, pending_band = set_ids[wanted], band[wanted]
        for level in range(LEVELS):
            if not len(pending):
                break
            seg_count = bands.segments[pending_band]
            base = np.concatenate([[0], np.cumsum(seg_count)])
            lengths = sizes[pending]
            index = np.repeat(bounds[pending] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            hashed = mix(value[index] ^ np.uint64(0x51ED270B * (level + 1)))
            which = np.repeat(np.arange(len(pending)), lengths)
            cell = base[which] + (hashed % seg_count[which].astype(np.uint64)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            cell, hashed = cell[order], hashed[order]
            edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            filled = cell[edges]
            content = _sums(mix(hashed), np.concatenate([edges, [len(cell)]]))
            holder = np.searchsorted(base, filled, side="right") - 1
            segment = (filled - base[holder]).astype(np.uint64)
            tag = mix((pending_band[holder].astype(np.uint64) << np.uint64(40)) ^ (segment << np.uint64(4)) ^ np.uint64(level))
            owners.append(pending[holder])
            keys.append(mix(content ^ tag))
            empty = seg_count - np.bincount(holder, minlength=len(pending))
            again = empty > bands.spare[pending_band]
            pending, pending_band = pending[again], pending_band[again]
        if len(pending):
            owners.append(pending)
            keys.append(mix(pending_band.astype(np.uint64) ^ np.uint64(0xA5A5A5A5A5)))
        step += 1
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(keys)


def bitmaps(value: np.ndarray, bounds: np.ndarray, bands: Bands) -> list[bytes]:
    """The parity bitmap of each set; its width is a power of two that follows the band."""
    sizes = np.diff(bounds)
    width = bands.bits(bands.of(np.maximum(sizes, 1)))
    base = np.concatenate([[0], np.cumsum(width)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bit = (mix(value ^ np.uint64(0xB17)) % width[owner].astype(np.uint64)).astype(np.int64)
    parity = (np.bincount(base[owner] + bit, minlength=base[-1]) & 1).astype(np.uint8)
    packed = np.packbits(parity, bitorder="little")
    return [packed[a // 8:b // 8].tobytes() for a, b in zip(base[:-1], base[1:])]


def _sign(k: int, percent: int):
    """Size, fingerprint and bitmap of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            for first, last, words in words_of(batch.column("text"), SPACED):
                value, bounds = shingle_sets(words, k)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, last - first),
                    batch.column("text_key").slice(first, last - first),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(_sums(mix(value), bounds).view(np.int64)),
                    pa.array(_sums(mix(value ^ np.uint64(0xF1F1)), bounds).view(np.int64)),
                    pa.array(bitmaps(value, bounds, bands), pa.binary()),
                ], names=["doc_id", "text_key", "n_shingles", "fp_hi", "fp_lo", "bitmap"])
    return run


def _keys(k: int, percent: int):
    """The tile keys of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            for first, last, words in words_of(batch.column("text"), SPACED):
                value, bounds = shingle_sets(words, k)
                owner, key = tile_keys(value, bounds, bands)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(last - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, last - first),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(key[order].view(np.int64)))], names=["rep", "keys"])
    return run


def _arrays(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words in words_of(batch.column(1), SPACED):
                value, bounds = shingle_sets(words, k)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(value.view(np.int64)))],
                    names=["id", "shingles"])
    return run


def _fold(bitmap: bytes, words: int) -> np.ndarray:
    """A bitmap narrowed to ``words`` 64-bit words; parities of merged bits add up."""
    wide = np.frombuffer(bitmap, np.uint64)
    return np.bitwise_xor.reduce(wide.reshape(-1, words), axis=0)


def passing(sizes_a, bits_a, sizes_b, bits_b, percent) -> tuple[np.ndarray, np.ndarray]:
    """(differing bits, passes) for all pairs of two blocks of signatures."""
    differ = np.empty((len(bits_a), len(bits_b)), np.int64)
    for i, row in enumerate(bits_a):
        differ[i] = np.bitwise_count(bits_b ^ row).sum(axis=1, dtype=np.int64)
    total = sizes_a[:, None] + sizes_b[None, :]
    overlap = np.minimum((total - differ) // 2, np.minimum(sizes_a[:, None], sizes_b[None, :]))
    return differ, 100 * overlap >= percent * (total - overlap)


def _tile_pairs(percent: int, nearest_only: bool):
    """Candidate pairs of each unit (tile, block i, block j)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["key", "bi", "bj"]):
            if len(bounds) == table.num_rows + 1:
                continue
            rep = table.column("rep").to_numpy()
            size = table.column("n").to_numpy()
            label = table.column("label").to_numpy()
            block = table.column("block").to_numpy()
            low, high = table.column("bi").to_numpy(), table.column("bj").to_numpy()
            bits = table.column("bitmap").to_pylist()
            found_a, found_b = [], []
            for s, e in zip(bounds[:-1], bounds[1:]):
                if e - s < 2 or (not nearest_only and (label[s:e] == label[s]).all()):
                    continue
                rows = np.arange(s, e)
                left, right = rows[block[s:e] == low[s]], rows[block[s:e] == high[s]]
                if not len(left) or not len(right):
                    continue
                narrow = min(len(bits[r]) for r in rows) // 8
                folded = np.stack([_fold(bits[r], narrow) for r in rows])
                nearest = np.full(len(right), -1)
                distance = np.full(len(right), np.iinfo(np.int64).max)
                for c in range(0, len(left), LEFT_ROWS):
                    some = left[c:c + LEFT_ROWS]
                    differ, ok = passing(size[some], folded[some - s], size[right], folded[right - s], percent)
                    ok &= label[some][:, None] != label[right][None, :]
                    if low[s] == high[s]:
                        ok &= some[:, None] < right[None, :]
                    if nearest_only:
                        differ[~ok] = np.iinfo(np.int64).max
                        best = differ.argmin(axis=0)
                        closer = differ[best, np.arange(len(right))] < distance
                        nearest[closer] = some[best[closer]]
                        distance[closer] = differ[best[closer], np.flatnonzero(closer)]
                    else:
                        x, y = np.nonzero(ok)
                        found_a.append(rep[some[x]])
                        found_b.append(rep[right[y]])
                hit = np.flatnonzero(nearest >= 0)
                found_a.append(rep[nearest[hit]])
                found_b.append(rep[right[hit]])
            if found_a:
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            keep = []
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared) and shared > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _candidates(tiles: DataFrame, percent: int, nearest_only: bool) -> DataFrame:
    blocks = F.greatest(F.ceil(F.col("tile_rows") / BLOCK), F.lit(1)).cast("int")
    units = (
        tiles.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "rep", "n", "label", "bitmap")
    )
    return (
        units.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "rep")
        .mapInArrow(_tile_pairs(percent, nearest_only), "a long, b long").distinct()
    )


def _exact(pairs: DataFrame, docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs whose similarity reaches the threshold; texts are read again for their ids only."""
    ids = scratch.store(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    arrays = scratch.store(docs.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_arrays(k), "id long, shingles array<long>"), "arrays")
    joined = pairs.join(arrays.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a").join(
        arrays.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    links = scratch.store(joined.select("a", "b", "left", "right").mapInArrow(_verify(percent), "a long, b long").distinct(), "links")
    scratch.drop(ids, arrays)
    return links


def ngram_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text; more columns are ignored).

    ``component_id`` is the smallest doc_id reachable by links. Null, empty and blank texts have no
    shingles and are their own component, as are rows without doc_id (component null unless their set
    equals another's). Rows that repeat a doc_id count as one document for reachability.
    """
    scratch = Scratch(docs.sparkSession, "ngram")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    sets = scratch.store(docs.mapInArrow(_sign(k, percent), SETS), "sets")
    same = ["fp_hi", "fp_lo"]
    classes = scratch.store(
        sets.where("n_shingles > 0").groupBy(*same).agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("rows"), F.first("n_shingles").alias("n"),
            F.first("bitmap").alias("bitmap")).where("rep is not null"), "classes")
    # one text of each class gives the tile keys; they go from the task straight into the shuffle
    repeated = classes.where("rows > 1").select(*same, "rep")
    copies = scratch.store(
        sets.join(repeated, same).where("doc_id <> rep").select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).distinct(), "copies")
    firsts = docs.where("doc_id is not null").join(
        copies, (F.col("doc_id") == F.col("c_id")) & (F.col("text_key") == F.col("c_key")), "left_anti")
    keyed = firsts.mapInArrow(_keys(k, percent), "rep long, keys array<long>")
    # one exchange serves both the search for tiles with two classes or more and the join back
    rows = keyed.select("rep", F.explode("keys").alias("key")).where("key is not null").repartition("key")
    member_sum = lambda salt: F.sum(F.pmod(F.xxhash64("rep", F.lit(salt)), F.lit(1 << 31)))
    shared = rows.groupBy("key").agg(
        F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("tile_rows"),
        member_sum(1).alias("sum1"), member_sum(2).alias("sum2")).where("low <> high")
    # similar texts share many segments; of the tiles with the same members one is enough
    shared = shared.groupBy("low", "high", "tile_rows", "sum1", "sum2").agg(F.min("key").alias("key")).select("key", "tile_rows")
    members = scratch.store(rows.join(shared, "key"), "members")
    signed = members.join(classes.select("rep", "n", "bitmap").distinct(), "rep")
    tiles = scratch.store(signed.withColumn("label", F.col("rep")), "tiles")
    first = scratch.store(_candidates(tiles, percent, True), "pairs")
    links = _exact(first, docs, k, percent, scratch)
    label = components(links, scratch)
    named = lambda rows: rows.join(label.withColumnRenamed("id", "rep"), "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component")
    # a table of its own: next to the aggregate itself the join could not split the rows of a large tile
    mixed = scratch.store(named(members.select("key", "rep")).groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                          .where("low <> high").select("key"), "mixed")
    if not mixed.isEmpty():
        open_tiles = named(tiles.drop("label")).join(mixed, "key", "left_semi")
        second = scratch.store(_candidates(open_tiles, percent, False).join(first, ["a", "b"], "left_anti"), "pairs")
        if not second.isEmpty():
            links = links.unionByName(_exact(second, docs, k, percent, scratch))
            label = components(links, scratch)
        scratch.drop(second)
    scratch.drop(members, tiles, first, mixed)
    joined = classes.select("fp_hi", "fp_lo", "rep", "rows").join(label.withColumnRenamed("id", "rep"), "rep", "left")
    groups = joined.where("rows > 1 or component is not null").select("fp_hi", "fp_lo", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return sets.select("doc_id", "n_shingles", "fp_hi", "fp_lo").join(groups, ["fp_hi", "fp_lo"], "left").select(
        "doc_id", "n_shingles", own.alias("component_id"))
