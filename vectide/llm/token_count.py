"""Token counts of a byte-fallback BPE model by rank-synchronous merging of arrays.

A text falls into pre-tokens that no piece of the vocabulary crosses. Distinct
pre-tokens of a step that the worker does not know yet lie one behind the other in
one array of symbols. In each round every pre-token applies its best pair, the one of
lowest rank and then the leftmost, all of them in the same array operations; only the
ranks next to a merge are looked up again. What has no pair left is done: the
symbols that survive are its tokens, and a character without a piece counts one
token for each byte.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectide.llm.common import col, per_worker, steps

#: Pre-tokens whose counts a worker remembers.
CACHE_ENTRIES = 300_000
#: A longer pre-token is merged on its own with a heap, as rounds would take quadratic time.
LONG = 256
LIMIT = 4096

SPACE = "▁"
_NONE = np.int64(1) << 62


class Merges:
    """Pairs of symbols with the rank and the symbol of their merge, from a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if any(model.is_unused(i) for i in ids) or not any(model.is_byte(i) for i in ids):
            raise ValueError("a BPE model with byte fallback and without unused pieces is needed")
        normal = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
        self.symbols = {p: k for k, p in enumerate(pieces)}
        for p in pieces:
            for c in p:
                self.symbols.setdefault(c, len(self.symbols))
        self.size = len(self.symbols)
        self.costs = np.array([1 if s in pieces else len(s.encode()) for s in self.symbols], np.int64)
        rank_of = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        rows = []
        for p, score in pieces.items():
            for cut in range(1, len(p)):
                left, right = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if left is not None and right is not None:
                    rows.append((left * self.size + right, rank_of[score], self.symbols[p]))
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.merged = (np.ascontiguousarray(table[:, k]) for k in range(3))
        # Pre-tokens start at white space; pieces with it further inside would cross that.
        inner = any(SPACE in p.lstrip(SPACE) for p in pieces)
        line = any("\n" in p for p in pieces)
        if inner:
            raise ValueError("pieces that hold a space after other characters are not supported")
        self.pattern = re.compile(f"{SPACE}+[^{SPACE}]*" if line else rf"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*")

    def pretokens(self, text: str) -> list[str]:
        return self.pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; a rank of ``_NONE`` where there is no merge."""
        key = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def start(self, word: str) -> list[int]:
        """Symbols of single characters; a character in no piece is minus its number of bytes."""
        known = self.symbols
        return [known[c] if c in known else -len(c.encode("utf-8", "surrogatepass")) for c in word]

    def cost(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < 0, -symbols, self.costs[np.maximum(symbols, 0)])

    def count(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        counts = np.zeros(len(words), np.int64)
        short = [k for k, w in enumerate(words) if len(w) <= LONG]
        if short:
            counts[short] = self._rounds([words[k] for k in short])
        for k, w in enumerate(words):
            if len(w) > LONG:
                counts[k] = self._heap(w)
        return counts.tolist()

    def _rounds(self, words: list[str]) -> np.ndarray:
        counts = np.zeros(len(words), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = np.fromiter((s for w in words for s in self.start(w)), np.int64, int(lengths.sum()))
        names = np.flatnonzero(lengths)
        lengths = lengths[names]
        ranks = np.full(len(symbols), _NONE)
        merged = np.zeros(len(symbols), np.int64)
        ranks[:-1], merged[:-1] = self.lookup(symbols[:-1], symbols[1:])
        while len(names):
            starts = np.cumsum(lengths) - lengths
            ranks[starts + lengths - 1] = _NONE  # the last symbol of a pre-token has no partner
            best = np.minimum.reduceat(ranks, starts)
            done = best == _NONE
            if done.any():
                # Finished pre-tokens leave the arrays.
                total = np.add.reduceat(self.cost(symbols), starts)
                counts[names[done]] = total[done]
                stay = np.repeat(~done, lengths)
                symbols, ranks, merged = symbols[stay], ranks[stay], merged[stay]
                names, lengths, best = names[~done], lengths[~done], best[~done]
                if not len(names):
                    break
                starts = np.cumsum(lengths) - lengths
            hits = np.flatnonzero(ranks == np.repeat(best, lengths))
            owner = np.searchsorted(starts, hits, side="right") - 1
            at = hits[np.r_[True, owner[1:] != owner[:-1]]]  # the leftmost of each pre-token
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks, merged = symbols[keep], ranks[keep], merged[keep]
            lengths = lengths - 1
            # Look up again what stands next to a merge.
            at = at - np.arange(len(at))
            near = np.unique(np.r_[at, np.maximum(at - 1, 0)])
            near = near[near < len(symbols) - 1]
            ranks[near], merged[near] = self.lookup(symbols[near], symbols[near + 1])
            ranks[-1] = _NONE
        return counts

    def _heap(self, word: str) -> int:
        """One long pre-token: the best pair from a heap, symbols in a linked list."""
        symbols = np.array(self.start(word), np.int64)
        n = len(symbols)
        ranks, merged = self.lookup(symbols[:-1], symbols[1:])
        live = np.flatnonzero(ranks != _NONE)
        heap = [(int(ranks[i]), int(i), int(symbols[i]), int(symbols[i + 1]), int(merged[i])) for i in live]
        heapq.heapify(heap)
        now = symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        gone = bytearray(n)
        table = per_worker(f"pairs:{id(self)}", lambda: dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist()))))
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or now[i] != left or now[j] != right:
                continue
            now[i], gone[j], after[i] = made, 1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and now[a] >= 0 and now[b] >= 0:
                    hit = table.get(now[a] * self.size + now[b])
                    if hit:
                        heapq.heappush(heap, (hit[0], a, now[a], now[b], hit[1]))
        return int(self.cost(np.array([s for s, g in zip(now, gone) if not g], np.int64)).sum())


class Counter:
    """Counts of whole texts, with the counts of recent pre-tokens at hand."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str | None]) -> list[int]:
        cut = [self.merges.pretokens(t) if t else [] for t in texts]
        words: set[str] = set()
        words.update(*cut)
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known, new = {}, list(words)
        self.known.update(zip(new, self.merges.count(new)))
        get = self.known.__getitem__
        return [sum(map(get, c)) for c in cut]


def counts(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row, as the model's own library counts them.

    ``model`` is the path of a sentencepiece BPE file, the same on every executor. No
    begin, end or special tokens are added; their strings within a text are ordinary
    text. A null text counts as empty, with no token. Ids may be null or repeat.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    read = docs.select(col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(f"counter:{model}", lambda: Counter(model))
        for batch in steps(batches, "text"):
            n = counter.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"]
            )

    kind = read.schema["id"].dataType.simpleString()
    counted = read.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
