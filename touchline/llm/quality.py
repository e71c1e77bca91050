"""Quality classifier: a linear-chain conditional random field labels every line of a document good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from touchline.llm.common import stored
from touchline.llm.memory import lean
from touchline.llm.words import NOT_SPACE, find_words, slices, word_hashes

# Labelled rows the field is fitted on: those with the smallest hash of their id, and of these the texts up to so many bytes.
TRAINING_ROWS = 3000
TRAINING_BYTES = 1 << 18
TRAINING_LINES = 200_000  # of all of them, some 60 MB of features
# Lines of a training chain; a longer text is fitted in several.
CHAIN = 64

NOT_BREAK = np.ones(256, bool)
NOT_BREAK[0x0A] = False

# Classes of bytes whose share in a line is a feature.
CLASSES = (
    range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b"#$%&*@^~+=<>_\\`", b"|[]{}", b"!", b" \t\r\x0b\x0c",
    b".,;:'\"?-()/", range(0x80, 0x100),
)
CLASS_OF = np.zeros(256, np.int64)
for _k, _bytes in enumerate(CLASSES):
    CLASS_OF[list(_bytes)] = _k + 1
WIDTH = len(CLASSES) + 3
FEATURES = 3 * WIDTH + 3


@dataclass
class Lines:
    """Features of the lines of a batch: lines of text r are ``first[r]`` to ``first[r + 1]``."""

    own: np.ndarray
    length: np.ndarray
    first: np.ndarray

    def all(self) -> np.ndarray:
        """Own features, those of the line before and after, and whether a neighbour is missing."""
        n = len(self.own)
        top, end = np.zeros(n, bool), np.zeros(n, bool)
        filled = np.flatnonzero(np.diff(self.first))
        top[self.first[filled]] = True
        end[self.first[filled + 1] - 1] = True
        before = np.where(top[:, None], 0, np.roll(self.own, 1, axis=0))
        after = np.where(end[:, None], 0, np.roll(self.own, -1, axis=0))
        return np.hstack([self.own, before, after, top[:, None], end[:, None], np.ones((n, 1))])


def lines_of(column: pa.Array) -> Lines:
    """Features of every line that is not empty: shares of byte classes, length, word length, words said twice in a row."""
    line = find_words(column, NOT_BREAK)
    n, size = len(line.start), line.end - line.start
    inside = NOT_BREAK[line.buf]
    of_byte = np.repeat(np.arange(n) * (len(CLASSES) + 1), size) + CLASS_OF[line.buf[inside]]
    shares = np.bincount(of_byte, minlength=n * (len(CLASSES) + 1)).reshape(n, len(CLASSES) + 1)[:, 1:] / np.maximum(size, 1)[:, None]
    w = find_words(column, NOT_SPACE)
    h = word_hashes(w)
    of_word = np.searchsorted(line.start, w.start, "right") - 1
    words = np.bincount(of_word, minlength=n)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    again = np.bincount(of_word[same], minlength=n) / np.maximum(words, 1)
    per_word = np.bincount(of_word, weights=w.end - w.start, minlength=n) / np.maximum(words, 1)
    own = np.column_stack([shares, np.log1p(size) / 10, np.minimum(per_word, 100) / 10, again])
    return Lines(own, size, line.first)


@dataclass
class Field:
    """Weights of the field: ``unary`` of state good against bad on scaled features, log weights of steps and of the first line."""

    mean: np.ndarray
    scale: np.ndarray
    unary: np.ndarray
    step: np.ndarray
    start: np.ndarray
    prior: float  # share of good documents, the score of a text without lines

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each line to be good, by the forward-backward recursion over each text."""
        good, _, _ = forward_backward((x - self.mean) / self.scale @ self.unary, first, self.step, self.start)
        return good


def forward_backward(u: np.ndarray, first: np.ndarray, step: np.ndarray, start: np.ndarray):
    """Marginals of state 1, expected steps between states and expected first states of all chains.

    Chains advance together, longest first, so a step works on all chains that are still running.
    """
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    order = order[count[order] > 0]
    running = [int(k) for k in np.searchsorted(-count[order], -np.arange(count.max(initial=0)), "left")]
    begin = first[order]
    low = np.minimum(u, 0)
    e = np.column_stack([np.exp(low - u), np.exp(low)])  # state 0 has score 0, state 1 has u
    a = np.exp(step)
    alpha: list[np.ndarray] = []
    for t, k in enumerate(running):
        v = e[begin[:k] + t] * (np.exp(start) if t == 0 else alpha[-1][:k] @ a)
        alpha.append(v / v.sum(axis=1, keepdims=True))
    good, steps, firsts = np.zeros(len(u)), np.zeros((2, 2)), np.zeros(2)
    beta = np.ones((0, 2))
    for t in reversed(range(len(running))):
        k = running[t]
        full = np.ones((k, 2))
        if len(beta):
            m = len(beta)
            ahead = e[begin[:m] + t + 1] * beta
            pair = alpha[t][:m, :, None] * a[None] * ahead[:, None, :]
            steps += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            full[:m] = ahead @ a.T
            full[:m] /= full[:m].sum(axis=1, keepdims=True)
        p = alpha[t] * full
        p /= p.sum(axis=1, keepdims=True)
        good[begin[:k] + t] = p[:, 1]
        if t == 0:
            firsts = p.sum(axis=0)
        beta = full
    return good, steps, firsts


def fit(chains: list[tuple[np.ndarray, int]], rounds: int = 150, rate: float = 0.1, ridge: float = 1.0) -> Field:
    """Maximises the conditional likelihood of the line labels by Adam; every line has the label of its document."""
    if not chains:
        return Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2), 0.5)
    prior = float(np.mean([y for _, y in chains]))
    pieces = [(x[i:i + CHAIN], y) for x, y in chains for i in range(0, len(x), CHAIN)]
    if not pieces:
        return Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2), prior)
    x = np.concatenate([p for p, _ in pieces])
    count = np.array([len(p) for p, _ in pieces])
    label = np.array([y for _, y in pieces])
    first, y = np.concatenate([[0], np.cumsum(count)]), np.repeat(label, count)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[scale < 1e-6], scale[scale < 1e-6] = 0, 1  # the constant stays
    x = (x - mean) / scale
    steps_seen, first_seen = np.zeros((2, 2)), np.bincount(label, minlength=2)[:2]
    for s in (0, 1):
        steps_seen[s, s] = (count[label == s] - 1).sum()
    theta = np.zeros(FEATURES + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        unary, step, start = theta[:FEATURES], theta[FEATURES:FEATURES + 4].reshape(2, 2), theta[FEATURES + 4:]
        good, steps, firsts = forward_backward(x @ unary, first, step, start)
        gradient = np.concatenate([(y - good) @ x, (steps_seen - steps).ravel(), first_seen - firsts]) - ridge * theta
        gradient /= len(x)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        theta = theta + rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8)
    return Field(mean, scale, theta[:FEATURES], theta[FEATURES:FEATURES + 4].reshape(2, 2), theta[FEATURES + 4:], prior)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
          rows: int = TRAINING_ROWS, lines: int = TRAINING_LINES) -> Field:
    """A field fitted on at most ``rows`` labelled documents of ``docs`` with ``lines`` lines together, those whose ids have the smallest hash.

    ``labels`` has ``doc_id`` and ``label`` (1 good, 0 bad); of several labels of
    one id the smallest counts, null labels and ids are skipped. The choice is
    made on ids alone, so only the texts chosen are read on; the tasks turn them
    into line features. Of several texts of one id one counts, the same at every
    run. Documents are taken in the order of their hash until the next one would
    exceed ``lines``; only then their features reach the driver.
    """
    known = labels.select(F.col(doc_id).alias("l_id"), F.col(label).cast("int").alias("label")).filter("l_id is not null and label in (0, 1)")
    known = known.groupBy("l_id").agg(F.min("label").alias("label"))
    ids = docs.select(F.col(doc_id).alias("l_id")).distinct()
    chosen = known.join(ids, "l_id", "left_semi").orderBy(F.xxhash64("l_id"), "l_id").limit(rows)
    sample = docs.select(F.col(doc_id).alias("l_id"), F.col(text).alias("text")).filter(F.octet_length("text") <= TRAINING_BYTES)
    sample = sample.join(F.broadcast(chosen), "l_id").select("text", F.col("label").cast("bigint").alias("label"), F.xxhash64("l_id", "l_id").alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = lines_of(batch.column(0))
            x = found.all().astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[a:b].tobytes() for a, b in zip(found.first[:-1], found.first[1:])], pa.binary()), batch.column(1), batch.column(2)],
                names=["x", "label", "key"])

    schema = StructType([StructField("x", BinaryType()), StructField("label", LongType()), StructField("key", LongType())])
    one = stored(sample.mapInArrow(lean(run), schema).groupBy("key").agg(F.min("x").alias("x"), F.min("label").alias("label")), "training")
    room, last = lines, None
    for r in one.select("key", (F.length("x") / (4 * FEATURES)).cast("bigint").alias("n")).orderBy("key").collect():  # two numbers for each of ``rows``
        room -= r["n"]
        if room < 0:
            break
        last = r["key"]
    found = one.filter(F.col("key") <= last).collect() if last is not None else []
    found = sorted((bytes(r["x"]), r["label"]) for r in found)  # the sum of gradients must not depend on task order
    return fit([(np.frombuffer(x, np.float32).reshape(-1, FEATURES).astype(float), y) for x, y in found])


def score(docs: DataFrame, field: Field, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the quality ``name`` (0 to 1) of each whole text.

    Every line that is not empty gets the probability that it is good, given
    all lines of its text; the quality is their mean weighted by bytes. Texts
    without such a line, null ones too, get the share of good documents in
    training. Rows are independent; a column named like the new one is replaced.
    """
    kept = [c for c in docs.columns if c != name]
    docs, at = docs.select(*kept), kept.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(field)  # some hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Field = shared.value
        for batch in batches:
            for piece in slices(batch, at, 4 << 20):
                lines = lines_of(piece.column(at))
                good = f.marginals(lines.all(), lines.first) * lines.length
                row = np.repeat(np.arange(piece.num_rows), np.diff(lines.first))
                weight = np.bincount(row, weights=lines.length, minlength=piece.num_rows)
                total = np.bincount(row, weights=good, minlength=piece.num_rows)
                quality = np.where(weight > 0, np.clip(total / np.maximum(weight, 1), 0, 1), f.prior)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(quality, pa.float64())], names=[*kept, name])

    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField(name, DoubleType())]))
