"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint holds the majority of each of the 64 bits over the hashes of its
word shingles. Texts are linked where their fingerprints differ in at most ``radius``
bits, and linked texts form groups.

Only distinct fingerprints are compared. Their bits are cut into ``radius + extra``
parts; two fingerprints within the radius agree in at least ``extra`` of them, so for
each choice of ``extra`` parts the fingerprints are dealt by those bits. What agrees
is compared bit-sliced: 64 fingerprints of a bucket stand side by side as 64 planes,
one word for each bit. A fingerprint's distances to all 64 are counted at once, plane
by plane, by carry-save adders, and a block is abandoned once all its counts exceed
the radius. A crowded bucket is cut into slices that meet pair by pair in tasks of
their own. Each task returns, for its links, a spanning forest instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectide.llm.common import col, steps, written
from vectide.llm.components import components

SHINGLE = 3
RADIUS = 3
BITS = 64
SEED = 42

#: Fingerprints that share a bucket at most on average, if their bits are independent.
BUCKET_ROWS = 64
#: Fingerprints of one slice of a crowded bucket.
SLICE_ROWS = 4096
#: Blocks of 64 that are compared in one step, and shingles hashed in one.
STEP_BLOCKS = 1 << 16
STEP_SHINGLES = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits over the XXH64 hashes of the shingles; zero for a text without a word."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
        return _majority([np.array(hashes, np.uint64)])
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    ends = starts[shingle - 1 :] + lengths[shingle - 1 :] - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends.tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    return _majority(hashes[i : i + STEP_SHINGLES] for i in range(0, n, STEP_SHINGLES))


def _majority(parts) -> int:
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in parts:
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a long) of every row; ids may be null or repeat."""
    read = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            fps = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(signed)], names=["id", "fp"])

    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(run, f"id {kind}, fp long")


def part_masks(n_fps: int, radius: int) -> list[int]:
    """The masks of bits by which fingerprints are dealt.

    ``extra`` grows with the number of fingerprints, so that buckets stay small; any
    two fingerprints within the radius agree under at least one mask, whatever it is.
    """
    extra = 1
    while n_fps > BUCKET_ROWS << (BITS * extra // (radius + extra)) and extra < 4:
        extra += 1
    parts = radius + extra
    edges = [BITS * i // parts for i in range(parts + 1)]
    masks = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, extra)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _buckets(fps: DataFrame, masks: list[int], slice_rows: int) -> DataFrame:
    """Fingerprints by ``mask`` and ``bits``, crowded buckets in pairs of slices ``a <= b``; ``mine`` is a row's slice."""
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)])
    dealt = fps.select("fp", F.explode(keys).alias("k")).select("k.mask", "k.bits", "fp")
    crowded = (
        dealt.groupBy("mask", "bits")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > slice_rows)
        .select("mask", "bits", F.ceil(F.col("n") / slice_rows).cast("int").alias("slices"))
    )
    slices = F.coalesce("slices", F.lit(1))
    sliced = dealt.join(crowded, ["mask", "bits"], "left").select(
        "mask", "bits", "fp", slices.alias("slices"), F.pmod(F.xxhash64("fp"), slices).cast("int").alias("mine")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    return sliced.withColumn("other", other).select(
        "mask", "bits", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "fp"
    )


def near_pairs(fps: np.ndarray, group: np.ndarray, radius: int, side: np.ndarray | None = None):
    """Pairs of places ``(i, j)``, ``i < j``, of one group whose fingerprints are within the radius, in steps.

    ``group`` is ascending. With ``side`` only pairs of different sides are wanted.
    """
    n = len(fps)
    if n < 2:
        return
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    blocks = (size + 63) // 64
    block_of_group = np.cumsum(blocks) - blocks
    which = np.repeat(np.arange(len(first)), size)
    within = np.arange(n) - first[which]
    block, lane = block_of_group[which] + within // 64, (within % 64).astype(np.uint64)
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    one = np.uint64(1)
    planes = np.empty((BITS, len(starts)), np.uint64)
    for b in range(BITS):
        planes[b] = np.bitwise_or.reduceat(((fps >> np.uint64(b)) & one) << lane, starts)
    used = np.bitwise_or.reduceat(one << lane, starts)
    mine = None if side is None else np.bitwise_or.reduceat(side.astype(np.uint64) << lane, starts)
    place = starts  # of a block's first row

    # Each row meets its own block and those after it in its group.
    own = within // 64
    cells = blocks[which] - own
    upto = np.cumsum(cells)
    row = 0
    while row < n:
        base = upto[row] - cells[row]
        end = max(row + 1, int(np.searchsorted(upto, base + STEP_BLOCKS, side="right")))
        rows = np.arange(row, end)
        i = np.repeat(rows, cells[rows])
        w = np.arange(len(i)) - np.repeat(np.cumsum(cells[rows]) - cells[rows], cells[rows]) + block[i]
        row = end
        later = np.where(w == block[i], ~((one << lane[i]) | ((one << lane[i]) - one)), ~np.uint64(0))
        open_ = used[w] & later
        if mine is not None:
            open_ &= np.where(side[i], ~mine[w], mine[w])
        keep = open_ != 0
        i, w, open_ = i[keep], w[keep], open_[keep]
        # Counters of every lane in carry-save form: bit k of the count in counter k.
        width = (radius + 1).bit_length()
        counters = [np.zeros(len(i), np.uint64) for _ in range(width)]
        for b in range(BITS):
            carry = planes[b][w] ^ (np.uint64(0) - ((fps[i] >> np.uint64(b)) & one))
            for k in range(width):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            open_ &= ~(_over(counters, radius) | carry)
            if b % 8 == 7:
                keep = open_ != 0
                if not keep.all():
                    i, w, open_ = i[keep], w[keep], open_[keep]
                    counters = [c[keep] for c in counters]
            if not len(i):
                break
        if len(i):
            bits = np.unpackbits(open_.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cell, at = np.nonzero(bits)
            yield i[cell], place[w[cell]] + at


def _over(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count exceeds the radius."""
    above, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def forest(n: int, pairs) -> np.ndarray:
    """The lowest place of each place's component, from pairs that come in steps."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            i, j = root[i], root[j]
            apart = i != j
            i, j = i[apart], j[apart]
            if not len(i):
                break
            low, high = np.minimum(i, j), np.maximum(i, j)
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _linked(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the buckets of a partition that is sorted by bucket."""

    def solve(cols: list[np.ndarray]) -> pa.RecordBatch:
        mask, bits, a, b, mine, fp = cols
        new = np.zeros(len(fp), bool)
        for c in (mask, bits, a, b):
            new[1:] |= c[1:] != c[:-1]
        group = np.cumsum(new)
        fps = fp.view(np.uint64)
        root = np.arange(len(fp))
        # Buckets with both sides in one slice compare all rows, pairs of slices across only.
        across = a != b
        for part, side in ((~across, None), (across, mine == b)):
            at = np.flatnonzero(part)
            if len(at):
                found = near_pairs(fps[at], group[at], radius, None if side is None else side[at])
                root[at] = at[forest(len(at), found)]
        child = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], names=["u", "v"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            now = [np.concatenate([x, y]) for x, y in zip(held, now)]
        differs = np.zeros(len(now[0]), bool)
        for c in now[:4]:
            differs |= c != c[-1]
        # The last bucket may go on in the next batch.
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if cut:
            yield solve([c[:cut] for c in now])
        held = [c[cut:] for c in now]
    if held is not None and len(held[0]):
        yield solve(held)


def links(fps: DataFrame, n_fps: int, radius: int = RADIUS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints ``fp`` that connect all that are within the radius."""
    keys = ["mask", "bits", "a", "b"]
    dealt = _buckets(fps, part_masks(n_fps, radius), slice_rows).repartition(*keys).sortWithinPartitions(*keys, "mine", "fp")
    return dealt.mapInArrow(lambda batches: _linked(batches, radius), "u long, v long")


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``id, fp, component`` of every row; ``component`` is the lowest id that links reach.

    Null and empty texts have fingerprint zero and are linked with each other and with
    what is near zero. Null ids take part like others but name a component only where
    it holds nothing else. Rows that repeat are in one component. Empty in, empty out.
    """
    table = written(fingerprints(docs, id_col, text_col, shingle))
    distinct = written(table.groupBy("fp").agg(F.min("id").alias("low")))
    found = links(distinct.select("fp"), distinct.count(), radius, slice_rows)
    roots = components(found)
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    by_fp = named.join(lowest, "root").select("fp", "component")
    return table.join(by_fp, "fp").select("id", "fp", "component")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose id is the lowest of its group.

    The id is what tells documents apart: of rows that share the lowest id, all stay. A
    group of null ids alone stays as a whole.
    """
    kept = groups(docs, id_col, text_col, shingle, radius).where(F.col("id").eqNullSafe(F.col("component")))
    ids = kept.select(F.col("id").alias("_kept")).distinct()
    return docs.join(ids, docs[f"`{id_col}`"].eqNullSafe(ids["_kept"]), "left_semi")
