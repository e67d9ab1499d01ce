"""MinHash near-duplicates with min-max hashing.

A document's set holds the distinct word shingles of its text, as 64-bit hashes. Each
of ``PERMUTATIONS`` permutations is evaluated once for every member and gives two
values, its minimum and its maximum: both agree between two sets with a probability
equal to their Jaccard similarity, and as they pull against each other their mean
varies less than that of two minima. ``BANDS`` bands of ``ROWS`` values are bucket
keys. Two sets at the threshold of 0.85 miss each other in all 32 bands with
probability (1 - 0.85^5)^32 < 1e-8.

Equal sets form one class, and only classes are compared. Buckets are solved in rounds:

* In a round every class goes to one of its open buckets, the one that is lowest under
  an order all share, so that a family of near copies meets at one place and each set
  moves once. What met is solved in tasks; a crowded bucket is cut into slices.
* A bucket is open while its classes are in more than one component. When few are
  left crowded, the last round compares what is open in full: slices of a bucket meet
  pair by pair in tasks of their own, and a pair is left to the first bucket it shares.

Inside a task sets of similar size are compared if they are not connected yet: the
agreeing values are counted, and what may reach the threshold is confirmed on the full
sets. Each task returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectide.llm.common import col, steps, written
from vectide.llm.components import components
from vectide.sizing import fits

SHINGLE = 5
#: Per cent of the union that two sets must share.
THRESHOLD = 85
PERMUTATIONS = 80
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
SEED = 42

#: Classes and shingles of one slice of a crowded bucket.
SLICE_CLASSES = 512
SLICE_SHINGLES = 1 << 20
#: Rounds before the last one, at most.
ROUNDS = 6
#: Bytes of text whose words are hashed at once, and members permuted at once.
STEP_BYTES = 1 << 20
STEP_MEMBERS = 4096


def _constants(seed: int, n: int) -> np.ndarray:
    """Odd multipliers."""
    return np.random.default_rng(seed).integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits of the value."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str | None) -> np.ndarray:
    """The XXH64 of every word, A-Z lowered; long texts are cut between words."""
    import re

    import xxhash

    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    gap = re.compile(rb"[\x20\x09-\x0D]")
    digest, parts, start = xxhash.xxh64_intdigest, [], 0
    while start < len(data):
        cut = gap.search(data, start + STEP_BYTES)
        end = cut.start() if cut else len(data)
        parts.append(np.array([digest(w, SEED) for w in data[start:end].split()], np.uint64))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the word shingles; of fewer words the whole sequence; without words none."""
    hashes = word_hashes(text)
    width = min(shingle, len(hashes))
    if not width:
        return hashes
    # Shingles of different widths have hashes of different sums: the width is mixed in.
    factors = _constants(SEED, shingle)
    total = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        total += hashes[k : len(hashes) - width + 1 + k] * factors[k]
    return np.unique(_mixed(total))


def signature(members: np.ndarray) -> np.ndarray:
    """Minimum under each permutation, then maximum under each; one evaluation serves both."""
    factors, shifts = _constants(SEED + 1, PERMUTATIONS)[:, None], _constants(SEED + 2, PERMUTATIONS)[:, None]
    low = np.full(PERMUTATIONS, ~np.uint64(0))
    high = np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(members), STEP_MEMBERS):
        values = members[None, i : i + STEP_MEMBERS] * factors + shifts
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key for each band, from values of different permutations."""
    factors = _constants(SEED + 3, ROWS)
    grid = _mixed(values).reshape(ROWS, BANDS)  # band b: values b, b + BANDS, ...
    return _mixed((grid * factors[:, None]).sum(axis=0, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketch(values: np.ndarray) -> bytes:
    """One byte of each value: equal values have equal bytes."""
    return (_mixed(values) >> np.uint64(56)).astype(np.uint8).tobytes()


def _key(members: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(members.tobytes())


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``id, n, key, bands, sketch`` of every row; ``key`` is null for an empty set."""
    read = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            n, keys, bands, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                members = shingle_set(text, shingle)
                n.append(len(members))
                values = signature(members) if len(members) else None
                keys.append(None if values is None else _key(members))
                bands.append(None if values is None else band_keys(values))
                sketches.append(None if values is None else sketch(values))
            columns = [batch.column("id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "key", "bands", "sketch"])

    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(run, f"id {kind}, n long, key binary, bands array<long>, sketch binary")


def _sets(docs: DataFrame, candidates: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``no, n, bands, sketch, members`` of the candidate classes, from one text of each."""
    wanted = candidates.select(F.col("low").alias("_low")).distinct()
    wanted = F.broadcast(wanted) if fits(wanted) else wanted
    read = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    read = read.join(wanted, F.col("id").eqNullSafe(F.col("_low")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            sets = [shingle_set(t, shingle) for t in batch.column("text").to_pylist()]
            sets = [s for s in sets if len(s)]
            columns = [pa.array([_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "members"])

    # An id that repeats may bring other texts, or one twice.
    found = read.mapInArrow(run, "key binary, members binary").dropDuplicates(["key"])
    return candidates.join(found, "key").select("no", "n", "bands", "sketch", "members")


def _least_agreeing(threshold: int) -> int:
    """Agreeing values below which a pair at the threshold is seven standard deviations away."""
    n, p = 2 * PERMUTATIONS, threshold / 100
    return int(np.floor(n * p - 7 * np.sqrt(n * p * (1 - p))))


def links_of(
    members: list[np.ndarray],
    sketches: np.ndarray,
    root: np.ndarray,
    threshold: int = THRESHOLD,
    side: np.ndarray | None = None,
    bands: np.ndarray | None = None,
    band: int | None = None,
) -> list[tuple[int, int]]:
    """Links between sets that connect all that are similar and have different roots.

    With ``side`` only pairs across are compared; with ``bands`` only pairs whose first
    common band key is ``band``.
    """
    size = np.array([len(s) for s in members], np.int64)
    order = np.argsort(-size, kind="stable")
    size, sketches, root = size[order], sketches[order], root[order].copy()
    side = None if side is None else side[order]
    bands = None if bands is None else bands[order]
    least, out = _least_agreeing(threshold), []
    # Rows after i in descending size up to the last whose size allows the similarity.
    ends = np.searchsorted(-100 * size, -threshold * size, side="right")
    for i in range(len(order) - 1):
        js = np.arange(i + 1, ends[i])
        js = js[root[js] != root[i]]
        if side is not None and len(js):
            js = js[side[js] != side[i]]
        if not len(js):
            continue
        js = js[(sketches[js] == sketches[i]).sum(axis=1) >= least]
        if bands is not None and len(js):
            first = bands[i, (bands[js] == bands[i]).argmax(axis=1)]
            js = js[first == band]
        a = members[order[i]]
        for j in js.tolist():
            if root[j] == root[i]:
                continue
            b = members[order[j]]
            at = np.searchsorted(a, b)
            common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
            if 100 * common >= threshold * (len(a) + len(b) - common):
                out.append((int(order[i]), int(order[j])))
                root[root == root[j]] = root[i]
    return out


def _linked(batches: Iterator[pa.RecordBatch], threshold: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Links inside the groups ``bucket, a, b`` of a partition that is sorted by them."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        no, mine, b = (rows[c].to_numpy() for c in ("no", "mine", "b"))
        members = [np.frombuffer(x, np.uint64) for x in rows["members"].to_pylist()]
        sketches = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(len(no), -1)
        side = bands = band = None
        if last:
            side = mine == b if rows["a"][0].as_py() != b[0] else None
            bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(no), -1)
            band = rows["bucket"][0].as_py()
        found = links_of(members, sketches, rows["root"].to_numpy(), threshold, side, bands, band)
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(no[ends[:, 0]]), pa.array(no[ends[:, 1]])], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "a", "b")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if held and now != tuple(keys[:, start]):
                yield solve(pa.Table.from_batches(held))
                held = []
            now = tuple(keys[:, start])
            held.append(batch.slice(start, end - start))
    if held:
        yield solve(pa.Table.from_batches(held))


def _rooted(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members with the root of their component, in buckets that are still open."""
    if roots is None:
        rooted = members.withColumn("root", F.col("no"))
    else:
        rooted = members.join(roots.withColumnRenamed("node", "no"), "no", "left")
        rooted = rooted.withColumn("root", F.coalesce("root", "no"))
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    return rooted.join(open_.select("bucket"), "bucket", "left_semi").select("bucket", "no", "n", "root")


def _slices(rows: DataFrame, slice_classes: int, slice_shingles: int) -> DataFrame:
    """Buckets that exceed a slice: ``bucket, slices``."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    slices = F.greatest(F.ceil(F.col("c") / slice_classes), F.ceil(F.col("s") / slice_shingles))
    return sizes.select("bucket", slices.cast("int").alias("slices")).where("slices > 1")


def _met(rows: DataFrame, sets: DataFrame, threshold: int, salt: int, last: bool, slice_classes: int, slice_shingles: int) -> DataFrame:
    """Links ``u, v`` that the rows ``bucket, no, n, root`` give; of slices all pairs meet in the last round only."""
    slices = F.coalesce("slices", F.lit(1))
    mine = F.pmod(F.xxhash64("no", F.lit(salt)), slices).cast("int")
    rows = rows.join(_slices(rows, slice_classes, slice_shingles), "bucket", "left")
    rows = rows.select("bucket", "no", "root", slices.alias("slices"), mine.alias("mine"))
    if last:
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    else:
        rows = rows.withColumn("other", F.col("mine"))
    rows = rows.select("bucket", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "no", "root")
    held = sets.drop("n") if last else sets.drop("n", "bands")
    keys = ["bucket", "a", "b"]
    dealt = rows.join(held, "no").repartition(*keys).sortWithinPartitions(*keys, "no")
    return dealt.mapInArrow(lambda batches: _linked(batches, threshold, last), "u long, v long")


def class_roots(
    classes: DataFrame,
    docs: DataFrame,
    id_col: str,
    text_col: str,
    shingle: int,
    threshold: int,
    slice_classes: int = SLICE_CLASSES,
    slice_shingles: int = SLICE_SHINGLES,
) -> DataFrame | None:
    """``node, root`` of the classes that are linked and are not roots; None where nothing meets."""
    dealt = classes.select("no", "n", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    members = written(dealt.join(shared, "bucket", "left_semi").select("bucket", "no", "n"))
    candidates = classes.join(members.select("no").distinct(), "no", "left_semi")
    sets = written(_sets(docs, candidates, id_col, text_col, shingle))
    edges = roots = None
    before = None
    for k in range(ROUNDS + 1):
        open_ = written(_rooted(members, roots))
        left = open_.count()
        if not left:
            return roots
        crowded = not _slices(open_, slice_classes, slice_shingles).isEmpty()
        last = k == ROUNDS or k > 0 and (not crowded or left > before // 2)
        before = left
        if not last:
            # One bucket for each class, by an order that changes from round to round.
            place = F.struct(F.xxhash64("bucket", F.lit(k)).alias("h"), "bucket", "n", "root")
            chosen = open_.groupBy("no").agg(F.min(place).alias("p"))
            open_ = chosen.select("p.bucket", "no", "p.n", "p.root")
        found = _met(open_, sets, threshold, k, last, slice_classes, slice_shingles)
        edges = written(found if edges is None else edges.unionByName(found))
        roots = components(edges)
        if last:
            return roots
    return roots


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: int = THRESHOLD,
    slice_classes: int = SLICE_CLASSES,
    slice_shingles: int = SLICE_SHINGLES,
) -> DataFrame:
    """``id, n, component, kept`` of every row; ``component`` is the lowest id that links reach.

    Texts with fewer words than a shingle are one shingle. Null texts and texts without
    words have an empty set, are linked with nothing and are their own component. Rows
    that repeat are in one component and all kept if they are its lowest. A null id
    takes part like others and names a component only where it holds nothing else. Empty
    in, empty out.
    """
    table = written(signatures(docs, id_col, text_col, shingle))
    first = F.first(F.struct("n", "bands", "sketch")).alias("f")
    classes = table.where("key is not null").groupBy("key").agg(F.min("id").alias("low"), first)
    classes = written(classes.select("key", "low", "f.*", F.monotonically_increasing_id().alias("no")))
    roots = class_roots(classes, docs, id_col, text_col, shingle, threshold, slice_classes, slice_shingles)
    named = classes.select("key", "no", "low")
    if roots is not None:
        named = named.join(roots.withColumnRenamed("node", "no"), "no", "left")
    else:
        named = named.withColumn("root", F.col("no"))
    named = named.select("key", "low", F.coalesce("root", "no").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    by_key = named.join(lowest, "root").select("key", "component")
    component: Column = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component"))
    found = table.select("id", "n", "key").join(by_key, "key", "left").select("id", "n", component.alias("component"))
    return found.withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
