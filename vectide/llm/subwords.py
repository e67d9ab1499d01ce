"""Texts as averages of hashed subword embeddings with a linear softmax on top.

A text is the bag of the character n-grams of its words, word ends included; a word
that stands there n times counts 1 + ln(n) times. Every n-gram is hashed to a row of an
embedding table; the rows are averaged, and a linear softmax turns the average into
class probabilities. Table and softmax are trained together by stochastic gradient
descent.

For a trained model the two linear steps fold into one table with a row of logits for
each bucket, so a text's logits are the mean over its n-grams. Words repeat, so a
worker keeps the sums of the words it met last.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectide.llm.common import col, latest, steps

#: Words whose sums a worker keeps, and their characters altogether.
CACHE_ENTRIES = 200_000
CACHE_CHARS = 8 << 20
#: Characters of new words that are cut into n-grams in one step.
STEP_CHARS = 1 << 18

_PRIME = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Shape:
    """Orders of the n-grams and the number of buckets, ``2 ** bits``."""

    orders: tuple[int, ...] = (2, 3, 4)
    bits: int = 16
    #: N-grams without any weight that are added to each average, so that a few words decide little.
    smooth: float = 0.0

    @property
    def buckets(self) -> int:
        return 1 << self.bits

    def cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the n-grams of all words, and for each the number of its word."""
        ends = "".join(f"<{w}>" for w in words)
        points = np.frombuffer(ends.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))  # characters to the word's end
        found, of = [], []
        with np.errstate(over="ignore"):
            rolled = np.zeros(len(points), np.uint64)
            for n in range(1, max(self.orders) + 1):
                if n > len(points):
                    break
                rolled = rolled[: len(points) - n + 1] * _PRIME + points[n - 1 :] + np.uint64(1)
                if n in self.orders:
                    at = np.flatnonzero(left[: len(rolled)] >= n)
                    mixed = (rolled[at] ^ (rolled[at] >> np.uint64(29))) * _MIX
                    found.append((mixed >> np.uint64(64 - self.bits)).astype(np.int64))
                    of.append(word[at])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(of)


def words_of(text: str | None) -> tuple[list[str], np.ndarray]:
    """The distinct words of a text and their weights."""
    counts = Counter((text or "").lower().split())
    return list(counts), 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))


def bag_of(text: str | None, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur in a text and their weights."""
    total = np.zeros(shape.buckets)
    words, weights = words_of(text)
    at = 0
    for part in _parts(words):
        buckets, of = shape.cut(part)
        total += np.bincount(buckets, weights[at + of], shape.buckets)
        at += len(part)
    seen = np.flatnonzero(total)
    return seen, total[seen]


def bags(rows: DataFrame, shape: Shape) -> DataFrame:
    """``label`` and the bag of each text: ``buckets`` that occur and their ``weights``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            buckets, counts = [], []
            for text in batch.column("text").to_pylist():
                seen, weights = bag_of(text, shape)
                buckets.append(seen.astype(np.int32))
                counts.append(weights.astype(np.float32))
            lists = [pa.array(buckets, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *lists], names=["label", "buckets", "weights"])

    return rows.select("label", "text").mapInArrow(run, "label string, buckets array<int>, weights array<float>")


def _parts(words: list[str]) -> Iterator[list[str]]:
    """Words in steps of bounded length; a longer word is a step of its own."""
    start, size = 0, 0
    for i, w in enumerate(words):
        if i > start and size + len(w) > STEP_CHARS:
            yield words[start:i]
            start, size = i, 0
        size += len(w) + 2
    if start < len(words):
        yield words[start:]


def sample(rows: DataFrame, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, all of a rarer one, chosen by the hash of ``id``.

    The share that is taken of a label follows from its count; no group of rows meets in
    one task. Rows without a label are left out.
    """
    known = rows.where("label is not null")
    # One row for each label: sent to the rows, so that these stay where they are.
    sizes = F.broadcast(known.groupBy("label").agg(F.count(F.lit(1)).alias("n")))
    share = F.least(F.lit(1.0), F.lit(float(per_label)) / F.col("n"))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return known.join(sizes, "label").where(draw < share).select(*rows.columns)


@dataclass
class Model:
    """Class names, logits by bucket and the bias; logits are divided by the temperature."""

    shape: Shape
    classes: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def word_sums(self, words: list[str]) -> np.ndarray:
        """Sums of the logits of each word's n-grams, and as last column their number."""
        out = np.zeros((len(words), len(self.classes) + 1))
        at = 0
        for part in _parts(words):
            buckets, of = self.shape.cut(part)
            rows = slice(at, at + len(part))
            for c in range(len(self.classes)):
                out[rows, c] = np.bincount(of, self.logits[buckets, c], len(part))
            out[rows, -1] = np.bincount(of, minlength=len(part))
            at += len(part)
        return out

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """Class probabilities from summed logits and weights; those of the bias where there is nothing."""
        mean = sums[:, :-1] / np.maximum(sums[:, -1:] + self.shape.smooth, 1) + self.bias
        return softmax(mean / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Scorer:
    """Class probabilities of whole texts, with the sums of recent words at hand."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.sums = np.zeros((1024, len(self.model.classes) + 1))
        self.chars = 0

    def score(self, texts: list[str | None]) -> np.ndarray:
        cut = [words_of(t) for t in texts]
        words: set[str] = set()
        words.update(*(c for c, _ in cut))
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE_ENTRIES or self.chars > CACHE_CHARS:
            self._clear()
            new = list(words)
        at = len(self.known)
        if at + len(new) > len(self.sums):
            grown = np.zeros((2 * (at + len(new)), self.sums.shape[1]))
            grown[:at] = self.sums[:at]
            self.sums = grown
        self.sums[at : at + len(new)] = self.model.word_sums(new)
        self.known.update(zip(new, range(at, at + len(new))))
        self.chars += sum(map(len, new))
        out = np.zeros((len(texts), self.sums.shape[1]))
        get = self.known.__getitem__
        for k, (c, weights) in enumerate(cut):
            if c:
                out[k] = weights @ self.sums[np.fromiter(map(get, c), np.int64, len(c))]
        return self.model.probabilities(out)


def split(found: list, every: int = 10, seed: int = 1) -> tuple[list, list]:
    """The bags in random order, as those to learn from and every ``every``-th set aside; few are not split."""
    order = np.random.default_rng(seed).permutation(len(found))
    mixed = [found[i] for i in order]
    aside, learn = mixed[::every], [f for k, f in enumerate(mixed) if k % every]
    return (learn, aside) if {f[0] for f in learn} == {f[0] for f in found} else (mixed, mixed)


def train(
    learn: list[tuple[str, np.ndarray, np.ndarray]],
    aside: list[tuple[str, np.ndarray, np.ndarray]],
    shape: Shape,
    dim: int = 8,
    epochs: int = 8,
    rate: float = 0.5,
    batch: int = 32,
    min_bags: int = 3,
    shares: dict[str, float] | None = None,
    seed: int = 1,
) -> Model:
    """A model from bags ``(label, buckets, weights)``, by stochastic gradient descent with adaptive rates.

    Buckets that fewer than ``min_bags`` bags hold tell one text from others rather than
    classes, and stay zero. ``shares`` are the classes' true shares where the sample has
    others: each bag weighs as much as the texts it stands for. The temperature that makes
    the bags set ``aside`` most likely is kept, so that probabilities are calibrated.
    """
    rng = np.random.default_rng(seed)
    classes = sorted({label for label, _, _ in learn})
    number = {c: k for k, c in enumerate(classes)}
    in_bags = np.zeros(shape.buckets, np.int64)
    for _, buckets, _ in learn:
        in_bags[buckets] += 1
    common = in_bags >= min_bags
    table = np.where(common[:, None], rng.uniform(-1.0 / dim, 1.0 / dim, (shape.buckets, dim)), 0.0)
    top, bias = rng.uniform(-0.1, 0.1, (dim, len(classes))), np.zeros(len(classes))
    table_seen, top_seen, bias_seen = (np.full(x.shape, 1e-8) for x in (table, top, bias))
    y_of = np.array([number[f[0]] for f in learn], np.int64)
    sampled = np.bincount([number[f[0]] for f in learn], minlength=len(classes)) / len(learn)
    heavy = np.array([(shares or {}).get(c, k) / k for c, k in zip(classes, sampled)])
    bags_ = [(b[common[b]], c[common[b]] / max(1, c.sum() + shape.smooth)) for _, b, c in learn]
    for _ in range(epochs):
        order = rng.permutation(len(learn))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            bag = [bags_[i] for i in chosen]
            weight = np.concatenate([w for _, w in bag])
            owner = np.repeat(np.arange(len(bag)), [len(b) for b, _ in bag])
            rows, at = np.unique(np.concatenate([b for b, _ in bag]), return_inverse=True)
            near = table[rows]
            hidden = np.stack([np.bincount(owner, weight * near[at, d], len(bag)) for d in range(dim)], axis=1)
            error = softmax(hidden @ top + bias)
            error[np.arange(len(bag)), y_of[chosen]] -= 1
            error *= heavy[y_of[chosen], None]
            back = error @ top.T
            g_near = np.stack([np.bincount(at, weight * back[owner, d], len(rows)) for d in range(dim)], axis=1)
            g_top, g_bias = hidden.T @ error, error.sum(axis=0)
            table_seen[rows] += g_near**2
            table[rows] = near - rate * g_near / np.sqrt(table_seen[rows])
            top_seen += g_top**2
            top -= rate * g_top / np.sqrt(top_seen)
            bias_seen += g_bias**2
            bias -= 0.1 * rate * g_bias / np.sqrt(bias_seen)
    model = Model(shape, classes, table @ top, bias)
    model.temperature = _temperature(model, aside, number, heavy)
    return model


def bag_probabilities(model: Model, found: list[tuple[str, np.ndarray, np.ndarray]]) -> np.ndarray:
    sums = np.array([[*(model.logits[b] * c[:, None]).sum(axis=0), c.sum()] for _, b, c in found])
    return model.probabilities(sums.reshape(len(found), len(model.classes) + 1))


def _temperature(model: Model, aside: list, number: dict[str, int], heavy: np.ndarray) -> float:
    """The temperature under which the bags set aside are most likely."""
    if not aside:
        return 1.0
    y = np.array([number[f[0]] for f in aside])
    best, result = np.inf, 1.0
    for t in np.exp(np.linspace(-2, 2, 41)):
        model.temperature = float(t)
        p = bag_probabilities(model, aside)[np.arange(len(y)), y]
        loss = -(heavy[y] * np.log(np.maximum(p, 1e-12))).mean()
        if loss < best:
            best, result = loss, float(t)
    return result


def collect_bags(sampled: DataFrame, shape: Shape) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """The bags of sampled rows ``label, text`` on the driver.

    Their number is bounded by the sample, their size by the number of buckets; texts
    stay with the tasks.
    """
    table = bags(sampled.where("text is not null"), shape).toArrow()
    labels = table["label"].to_pylist()
    buckets, weights = table["buckets"], table["weights"]
    found = [
        (labels[i], np.asarray(buckets[i].values), np.asarray(weights[i].values)) for i in range(len(labels))
    ]
    # The order in which tasks return must not change the model.
    return sorted(found, key=lambda f: (f[0], len(f[1]), f[1].tobytes(), f[2].tobytes()))


def scored(read: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """All columns and ``p``, the class probabilities of every text in the order of the classes."""
    shared = read.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = latest("scorer", name, lambda: Scorer(shared.value))
        for batch in steps(batches, text_col):
            p = pa.array(list(scorer.score(batch.column(text_col).to_pylist())), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, p], names=[*batch.schema.names, "p"])

    shape = T.StructType([*read.schema.fields, T.StructField("p", T.ArrayType(T.DoubleType()))])
    return read.mapInArrow(run, shape)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def reading(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
