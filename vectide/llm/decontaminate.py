"""Benchmark decontamination by greedy string tiling.

A tile is a run of equal tokens of a document and a benchmark item. Greedy string
tiling marks the longest tile first, then the next among the tokens that no tile
covers yet, until none of at least ``seed`` tokens is left; the share of the item's
tokens that are covered is compared with the threshold. As tiles may stand in any
order, an item whose parts were moved about is found like one that was copied.

Documents are read once. An index of the items' seeds (every run of ``seed`` tokens, by
its rolling Karp-Rabin hash) goes to all tasks, in blocks of bounded size. A document's
own rolling hashes are looked up in it, and shared seeds bound from above what tiles
can cover, since each tile consists of shared seeds. Only where that bound reaches the
threshold are tiles searched, again by Karp-Rabin: at a given length the hashes of the
uncovered runs of the item are compared with those of the document, equal hashes are
compared token by token, and the length goes down from the longest match.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectide.llm.common import col, latest, steps, written

SEED = 5
THRESHOLD = 0.8
#: Characters of benchmark text in one block of the index.
BLOCK_CHARS = 8 << 20

#: A character of a script that is written without spaces, in UTF-8: Thai and Lao, Myanmar, Khmer, kana and ideographs.
_ALONE = rb"(?:\xe0[\xb8-\xbb]|\xe1[\x80-\x82\x9e\x9f]|\xe3[\x81-\x83\x90-\xbf]|[\xe4-\xe9][\x80-\xbf]|\xef[\xa4-\xab]|\xf0[\xa0-\xaf][\x80-\xbf])[\x80-\xbf]"
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
_MIXED = re.compile(rb"(?:[0-9a-z]+|(?!" + _ALONE + rb")[\xc0-\xff][\x80-\xbf]*)+|" + _ALONE)
#: What no other letter holds: where it is missing the simple pattern gives the same tokens.
_SPACELESS = re.compile("[\u0e00-\u0eff\u1000-\u10bf\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    """Runs of digits, letters and other characters beyond ASCII, lower-cased; single characters of scripts without spaces."""
    text = (text or "").lower()
    spaceless = not text.isascii() and _SPACELESS.search(text)
    return (_MIXED if spaceless else _TOKEN).findall(text.encode("utf-8", "surrogatepass"))


def token_numbers(words: list[bytes]) -> np.ndarray:
    """64-bit numbers of tokens, the same in every process."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def rolling(numbers: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` numbers, modulo 2**64."""
    n = len(numbers) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # hash(i) = sum of numbers[i + k] * base**(length - 1 - k), by doubling the run.
    out, done = np.zeros(len(numbers), np.uint64), 0
    run, size, base = numbers.copy(), 1, _BASE
    rest = length
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                # Append a run of ``size`` numbers behind the ``done`` there are.
                out = out[: len(run) - done] * base + run[done:] if done else run.copy()
                done += size
            rest >>= 1
            if rest:
                run = run[: len(run) - size] * base + run[size:]
                size *= 2
                base = base * base
    return out


class Index:
    """Seeds of a block of items: sorted hashes with the item and place of each."""

    def __init__(self, items: list[tuple[object, str]], seed: int):
        self.seed = seed
        self.ids, self.words, self.numbers = [], [], []
        # Items shorter than a seed, by their length and the hash of all their tokens.
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        hashes, item, place = [], [], []
        for id_, text in items:
            words = tokens(text)
            if not words:
                continue
            numbers = token_numbers(words)
            found = rolling(numbers, seed)
            if len(words) < seed:
                self.short[len(words)][int(rolling(numbers, len(words))[0])].append(len(self.ids))
            hashes.append(found)
            item.append(np.full(len(found), len(self.ids), np.int64))
            place.append(np.arange(len(found)))
            self.ids.append(id_)
            self.words.append(words)
            self.numbers.append(numbers)
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.hashes = joined[order]
        self.item = np.concatenate(item)[order] if item else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, np.int64)

    def candidates(self, numbers: np.ndarray, threshold: float) -> list[int]:
        """Items of which shared seeds cover the threshold; tiles cannot cover more."""
        out = []
        for length, by_hash in self.short.items():
            # An item of one token is found only where it is all there is.
            if length > 1 or len(numbers) == 1:
                for h in set(rolling(numbers, length).tolist()) & by_hash.keys():
                    out += by_hash[h]
        return sorted(out + self._long(numbers, threshold))

    def _long(self, numbers: np.ndarray, threshold: float) -> list[int]:
        found = np.unique(rolling(numbers, self.seed))
        low = np.searchsorted(self.hashes, found, side="left")
        count = np.searchsorted(self.hashes, found, side="right") - low
        low, count = low[count > 0], count[count > 0]
        if not len(low):
            return []
        at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        by_item = defaultdict(list)
        for i, p in zip(self.item[at].tolist(), self.place[at].tolist()):
            by_item[i].append(p)
        out = []
        for i, places in by_item.items():
            covered = np.zeros(len(self.words[i]) + 1, np.int64)
            np.add.at(covered, places, 1)
            np.add.at(covered, np.array(places) + self.seed, -1)
            if np.count_nonzero(np.cumsum(covered)) >= threshold * len(self.words[i]):
                out.append(i)
        return out


def tiles(a: list[bytes], b: list[bytes], a_numbers: np.ndarray, b_numbers: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of ``a`` (the shorter) against ``b``: ``(place in a, place in b, length)`` in order of marking.

    Of matches of one length the one that comes first in ``a``, then in ``b``, is marked first.
    """
    a_free, b_free = np.ones(len(a), bool), np.ones(len(b), bool)
    found: list[tuple[int, int, int]] = []

    def starts(free: np.ndarray, length: int) -> np.ndarray:
        upto = np.r_[0, np.cumsum(free)]
        return np.flatnonzero(upto[length:] - upto[:-length] == length)

    def match(length: int, mark: bool) -> bool:
        """Whether uncovered runs of this length are equal; with ``mark`` all that can be are covered."""
        x, y = starts(a_free, length), starts(b_free, length)
        if not len(x) or not len(y):
            return False
        hx, hy = rolling(a_numbers, length)[x], rolling(b_numbers, length)[y]
        shared = np.isin(hy, hx)
        by_hash = defaultdict(deque)
        for place, h in zip(y[shared].tolist(), hy[shared].tolist()):
            by_hash[h].append(place)
        any_ = False
        for i, h in zip(x.tolist(), hx.tolist()):
            places = by_hash.get(h)
            if not places or not a_free[i : i + length].all():
                continue
            # What has been covered meanwhile stays covered: such places are dropped for good.
            while places and not b_free[places[0] : places[0] + length].all():
                places.popleft()
            for j in places:
                if b_free[j : j + length].all() and a[i : i + length] == b[j : j + length]:
                    any_ = True
                    if not mark:
                        return True
                    a_free[i : i + length] = False
                    b_free[j : j + length] = False
                    found.append((i, j, length))
                    break
        return any_

    def longest(high: int) -> int:
        """The largest length up to ``high`` with a match: if a length has one, so have all below."""
        if high < seed or not match(seed, False):
            return 0
        low = seed
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if match(mid, False) else (low, mid - 1)
        return low

    length = longest(min(len(a), len(b)))
    while length:
        match(length, True)
        length = longest(length - 1)
    return found


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of about the given size, one after the other."""
    total = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    if total <= block_chars:
        yield [(r["id"], r["text"]) for r in items.collect()]
        return
    n_blocks = total // block_chars + 1
    row = F.xxhash64(F.monotonically_increasing_id())
    numbered = written(items.withColumn("block", F.pmod(row, F.lit(n_blocks))))
    for n in range(n_blocks):
        yield [(r["id"], r["text"]) for r in numbered.where(F.col("block") == n).select("id", "text").collect()]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    seed: int = SEED,
    threshold: float = THRESHOLD,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Pairs ``id, item_id`` where tiles cover at least ``threshold`` of the item's tokens.

    With ``item_tokens``, ``covered``, ``coverage`` and the ``tiles``: struct(item_place,
    doc_place, length) in tokens. Documents without such an item have no row. A null or
    empty text has no tokens and neither finds nor is found. An item of fewer than ``seed``
    tokens is found where all of them stand in a row; one of a single token only in a
    document that consists of it, for words alone prove nothing. Null ids are reported as
    null. Each of several equal rows, of documents or of items,
    gives its own rows. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    read = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    items = benchmark.select(col(item_col).alias("id"), F.coalesce(col(item_text_col).cast("string"), F.lit("")).alias("text"))
    kind, item_kind = read.schema["id"].dataType.simpleString(), items.schema["id"].dataType.simpleString()
    shape = (
        f"id {kind}, item_id {item_kind}, item_tokens long, covered long, coverage double,"
        " tiles array<struct<item_place: long, doc_place: long, length: long>>"
    )
    id_type = pa.array([], _arrow(items)).type
    tile_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_place", "doc_place", "length")]))

    def scan(part: list[tuple[object, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(part)
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = latest("seeds", name, lambda: Index(shared.value, seed))
            for batch in steps(batches, "text"):
                rows, out = [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    words = tokens(text)
                    if not words or not index.ids:
                        continue
                    numbers = token_numbers(words)
                    for i in index.candidates(numbers, threshold):
                        n = len(index.words[i])
                        found = tiles(index.words[i], words, index.numbers[i], numbers, min(seed, n))
                        covered = sum(t[2] for t in found)
                        if covered >= threshold * n:
                            rows.append(row)
                            out.append((index.ids[i], n, covered, covered / n, [dict(zip(("item_place", "doc_place", "length"), t)) for t in found]))
                if rows:
                    types = [id_type, pa.int64(), pa.int64(), pa.float64(), tile_type]
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*out), types)]
                    names = ["id", "item_id", "item_tokens", "covered", "coverage", "tiles"]
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), *columns], names=names)

        return read.mapInArrow(run, shape)

    found = None
    for part in _blocks(items, block_chars):
        one = scan(part)
        found = one if found is None else found.unionByName(one)
    return found


def _arrow(items: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(items.schema["id"].dataType)


def filter_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id has no contaminated row.

    A null id is an id of its own.
    """
    hits = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col("id").alias("_hit")).distinct()
    hits = written(hits)
    return docs.join(hits, docs[f"`{id_col}`"].eqNullSafe(hits["_hit"]), "left_anti")
