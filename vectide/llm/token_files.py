"""Token ids in files: canonical length-limited Huffman codes from global counts.

``write`` encodes texts in ascending order of their ids. How often each token id occurs
among all documents decides the length of its code (the package-merge method, at most
``MAX_BITS`` bits), and the lengths alone decide the codes. A file is a folder of two
Parquet tables:

* ``codes``: ``token`` and ``length`` of its code, one row for each id that occurs;
* ``blocks``: one row for each block of whole documents, numbered by ``part`` and ``seq``
  (its first document's number in the part) in ascending order: the documents' ``ids``
  and ``lengths``, the ``bits``, and as ``checkpoints`` the bit offset of every
  ``SPACING``-th token.

Codes do not depend on what precedes them, so blocks are decoded independently, and
within blocks all stretches between checkpoints at the same time: a table of
``2 ** MAX_BITS`` entries tells which token the next bits hold and how many they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vectide.llm.common import col, steps, tokenizer, written
from vectide.llm.encoding import STEP_BYTES, encoder
from vectide.session import work_dir

MAX_BITS = 18
#: Bits that hold the length of a code, and a mask of them; tokens have 27 bits at most.
LENGTH_BITS = np.uint32(5)
LENGTH_MASK = np.uint32(31)
#: Tokens between checkpoints, and tokens of a block unless one document has more.
SPACING = 128
BLOCK = 1 << 16
#: Bytes of bits that one decoding step takes, or one block.
DECODE_BYTES = 1 << 20


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``max_bits`` bits for positive counts, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols need more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        even = len(level) // 2 * 2
        packages = level[0:even:2] + level[1:even:2]
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        is_leaf.append(rank < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        chosen = int(leaf[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical codes: shorter ones first, equal lengths by token."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, max_bits: int = MAX_BITS):
        self.max_bits = max_bits
        order = np.lexsort((tokens, lengths))
        tokens, lengths = tokens[order].astype(np.int64), lengths[order].astype(np.int64)
        ends = np.cumsum(np.int64(1) << (max_bits - lengths))
        firsts = ends - (np.int64(1) << (max_bits - lengths))
        top = int(tokens.max()) + 1 if len(tokens) else 0
        # Codes and tokens share a word with the length of the code, which takes the lowest bits.
        self.code = np.zeros(top, np.uint32)
        self.code[tokens] = (firsts >> (max_bits - lengths)) << LENGTH_BITS | lengths
        self.token_at = np.ones(1 << max_bits, np.uint32)
        if len(tokens):
            self.token_at[: ends[-1]] = np.repeat(tokens << LENGTH_BITS | lengths, ends - firsts)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of some tokens, most significant first, and the offset of every ``SPACING``-th."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        codes = self.code[ids]
        lengths = (codes & LENGTH_MASK).astype(np.int64)
        ends = np.cumsum(lengths)
        offsets = ends - lengths
        word = offsets >> 5
        shift = (64 - (offsets & 31) - lengths).astype(np.uint64)
        spread = (codes >> LENGTH_BITS).astype(np.uint64) << shift  # over this word of 32 bits and the next
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        # Codes share no bits, so those of a word add up to it.
        both = np.add.reduceat(spread, starts)
        sums = np.zeros(int(ends[-1] >> 5) + 3, np.uint64)
        at = word[starts]
        sums[at] = both >> np.uint64(32)
        sums[at + 1] |= both & np.uint64(0xFFFFFFFF)
        bits = sums.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8]
        return bits, offsets[::SPACING]

    def decode(self, bits: list[bytes], checkpoints: list[np.ndarray], n: list[int]) -> list[np.ndarray]:
        """The tokens of some blocks; all stretches of all of them advance together, the longest in front."""
        padded = b"".join(b + b"\0" * 4 for b in bits)
        raw = np.frombuffer(padded + b"\0" * 4, np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        base = np.cumsum([0] + [8 * (len(b) + 4) for b in bits])
        at = np.concatenate([c + o for c, o in zip(checkpoints, base)] or [np.zeros(0, np.int64)]).astype(np.int64)
        left = np.concatenate([np.minimum(SPACING, k - SPACING * np.arange(len(c))) for c, k in zip(checkpoints, n)] or [np.zeros(0, np.int64)])
        order = np.argsort(-left, kind="stable")
        at = at[order]
        live = len(left) - np.searchsorted(left[order][::-1], np.arange(SPACING), side="right")
        # A row for each step, so that tokens are written where they are contiguous.
        out = np.zeros((SPACING, len(at)), np.uint32)
        top = np.uint32(32 - self.max_bits)
        low = np.uint32((1 << self.max_bits) - 1)
        for k, m in enumerate(live.tolist()):
            if not m:
                break
            here = at[:m]
            peek = (window[here >> 3] >> (top - (here & 7).astype(np.uint32))) & low
            found = self.token_at[peek]
            out[k, :m] = found >> LENGTH_BITS
            here += found & LENGTH_MASK
        stretches = np.empty((len(at), SPACING), np.uint32)
        stretches[order] = out.T
        flat = stretches[np.arange(SPACING)[None, :] < left[:, None]]
        edges = np.cumsum([0, *n])
        return [flat[a:b] for a, b in zip(edges, edges[1:])]


def _encoded(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, end_id: int | None, narrow: bool) -> DataFrame:
    """Tokens of every document in ascending order of ``id``: ``at`` numbers part and place.

    Tokens are little-endian, of 16 bits where all ids fit (``narrow``), else of 32.
    """
    kind = docs.select(col(id_col)).schema[0].dataType.simpleString()
    read = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    # Equal ids in the order of their texts: a task that runs again numbers them alike.
    ordered = read.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    numbered = ordered.withColumn("at", F.monotonically_increasing_id())
    end = b"" if end_id is None else np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in steps(batches, "text", STEP_BYTES):
            found = [b + end for b in encode(batch.column("text").to_pylist())]
            if narrow:
                found = [np.frombuffer(b, "<u4").astype("<u2").tobytes() for b in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("id"), pa.array(found, pa.binary())], names=["at", "id", "tokens"]
            )

    return numbered.mapInArrow(run, f"at long, id {kind}, tokens binary")


def _token_counts(encoded: DataFrame, width: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column("tokens").to_pylist()), width))
            if len(found) > len(total):
                total, found = found, total
            total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["token", "n"])

    return encoded.select("tokens").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def write(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 0,
) -> None:
    """Write the tokens of every text, ``end_id`` after each document, to the folder ``path``.

    Null ids come first; rows of one id follow each other by the hash of their text. A
    null text is empty. An empty table gives a file without blocks.
    """
    spark = docs.sparkSession
    narrow = max(*tokenizer(tokenizer_path).get_vocab().values(), end_id or 0) < 1 << 16
    width = "<u2" if narrow else "<u4"
    encoded = written(_encoded(docs, tokenizer_path, id_col, text_col, end_id, narrow))
    # One row for each id of the vocabulary at most.
    counted = _token_counts(encoded, width).orderBy("token").toPandas()
    tokens, n = counted["token"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
    lengths = code_lengths(n)
    table = spark.createDataFrame(list(zip(tokens.tolist(), lengths.tolist())), "token long, length long")
    table.coalesce(1).write.parquet(f"{path}/codes")
    kind = encoded.schema["id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(tokens, lengths)

        def block(at, ids, parts):
            bits, checkpoints = code.encode(np.concatenate(parts))
            row = {"part": int(at[0]) >> 33, "seq": int(at[0]) & ((1 << 33) - 1), "ids": pa.concat_arrays(ids), "lengths": list(map(len, parts)),
                   "bits": bits, "checkpoints": checkpoints.tolist()}
            columns = [pa.array([row["part"]]), pa.array([row["seq"]]), pa.ListArray.from_arrays([0, len(row["ids"])], row["ids"]),
                       pa.array([row["lengths"]], pa.list_(pa.int64())), pa.array([bits]), pa.array([row["checkpoints"]], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, names=list(row))

        at, ids, parts, size = [], [], [], 0
        for batch in batches:
            places = batch.column("at").to_numpy()
            tokens_of = batch.column("tokens")
            for i in range(batch.num_rows):
                found = np.frombuffer(tokens_of[i].as_py(), width)
                # A block ends where it is full, and where the next document is of another part.
                if at and (size + len(found) > BLOCK or places[i] != at[-1] + 1):
                    yield block(at, ids, parts)
                    at, ids, parts, size = [], [], [], 0
                at.append(places[i])
                ids.append(batch.column("id").slice(i, 1))
                parts.append(found)
                size += len(found)
        if at:
            yield block(at, ids, parts)

    shape = f"part long, seq long, ids array<{kind}>, lengths array<long>, bits binary, checkpoints array<long>"
    encoded.mapInArrow(blocks, shape).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``part, seq, id, tokens`` of every document in a file; tokens as little-endian 32-bit bytes."""
    codes = spark.read.parquet(f"{path}/codes").toPandas()
    tokens, lengths = codes["token"].to_numpy(np.int64), codes["length"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(tokens, lengths)
        for batch in steps(batches, "bits", DECODE_BYTES):
            sizes = [np.asarray(x.values) for x in batch.column("lengths")]
            points = [np.asarray(x.values) for x in batch.column("checkpoints")]
            found = code.decode(batch.column("bits").to_pylist(), points, [int(s.sum()) for s in sizes])
            for i in range(batch.num_rows):
                edges = np.concatenate([[0], np.cumsum(sizes[i])])
                raw = found[i].astype("<u4").tobytes()
                n = len(sizes[i])
                columns = [pa.array(np.full(n, batch.column("part")[i].as_py(), np.int64)),
                           pa.array(batch.column("seq")[i].as_py() + np.arange(n)),
                           batch.column("ids")[i].values,
                           pa.array([raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:])], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "seq", "id", "tokens"])

    return blocks.mapInArrow(run, f"part long, seq long, id {kind}, tokens binary")


def with_starts(digests: DataFrame, n_col: str = "n_tokens") -> DataFrame:
    """Adds ``start``: the tokens of all documents before, from narrow rows ``part, seq, n_tokens``.

    Sums run within the parts, which the writer made of about equal size; one row for
    each part carries the sum of the parts before it.
    """
    digests = written(digests)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = digests.groupBy("part").agg(F.sum(n_col).alias("n"))
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    summed = digests.withColumn("inside", F.coalesce(F.sum(n_col).over(within), F.lit(0)))
    return summed.join(offsets, "part").withColumn("start", F.col("offset") + F.col("inside")).drop("offset", "inside")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
