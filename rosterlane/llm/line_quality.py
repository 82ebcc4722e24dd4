"""Document quality by a linear-chain conditional random field over the lines of a text.

Every line has features of its own and those of the lines before and after it. The field labels each
line good or bad; forward and backward recursions give the probability of good per line, and their
mean, weighted by the lines' lengths, is the quality of the document.

The field is trained here, on a bounded sample of labelled documents whose lines all take the label
of their document, by gradient steps on the likelihood; it is a few hundred bytes and goes to every
task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlane.llm.words import SPACE_BYTES, text_bytes, word_hashes

# Documents to train on at most, and lines that a document to train on may have at most.
TRAIN_DOCS = 4000
TRAIN_LINES = 300
# Different texts of one id to train on at most.
TRAIN_TEXTS = 4
STEPS = 200
RATE = 0.1
RIDGE = 1e-4
# Bytes of text whose lines are worked on together.
GROUP_BYTES = 1 << 20

OWN = (
    "capitals", "symbols", "pipes", "exclamations", "digits", "word_length", "line_length",
    "same_as_last_word", "seen_line", "ends_sentence", "short_words", "empty",
)
# The neighbours' features and whether there is a neighbour, then a constant.
N_FEATURES = 3 * len(OWN) + 2 + 1


def byte_table(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


UPPER = byte_table(bytes(range(65, 91)))
LETTER = byte_table(bytes([*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]))
SYMBOL = byte_table(b"#*$%&<>{}[]\\^~_=+@")
DIGIT = byte_table(b"0123456789")


def own_features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per line of one text its own features, and its length in bytes, the line end included."""
    ends = np.append(np.flatnonzero(data == 10), len(data))
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = (ends - starts + 1).astype(float)
    n = len(starts)

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[ends] - total[starts]).astype(float)

    first, last, codes = word_hashes(data)
    # Word spans do not cross line ends, as these are white space.
    line_of = np.searchsorted(ends, first, side="right")
    words = np.bincount(line_of, minlength=n).astype(float)
    sizes = (last - first).astype(float)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (line_of[1:] == line_of[:-1])
    # A line is known by its words in order.
    place = np.arange(len(codes)) - np.concatenate([[0], np.cumsum(words)])[:-1].astype(int)[line_of]
    order = codes * (2 * place.astype(np.uint64) + np.uint64(1))
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, line_of, order)
    _, earliest = np.unique(sums, return_index=True)
    seen = np.ones(n, bool)
    seen[earliest] = False

    some = np.maximum(words, 1)
    letters = np.maximum(per_line(LETTER[data]), 1)
    visible = np.maximum(per_line(~SPACE_BYTES[data]), 1)
    final = np.zeros(n, bool)
    if len(last):
        final_word = np.flatnonzero(np.diff(line_of, append=n) > 0)
        final[line_of[final_word]] = byte_table(b".!?")[data[last[final_word] - 1]]
    features = np.column_stack([
        per_line(UPPER[data]) / letters,
        per_line(SYMBOL[data]) / visible,
        per_line(data == ord("|")) / some,
        per_line(data == ord("!")) / some,
        per_line(DIGIT[data]) / visible,
        np.bincount(line_of, sizes, n) / some / 10,
        np.log1p(lengths) / 5,
        np.bincount(line_of, again, n) / some,
        seen & (words > 0),
        final,
        np.bincount(line_of, sizes <= 3, n) / some,
        words == 0,
    ])
    return features.astype(float), lengths


@dataclass
class Lines:
    """Lines of many texts: features, lengths, and where each text's lines start (with the end)."""

    features: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray


def gathered(own: Sequence[np.ndarray], lengths: Sequence[np.ndarray]) -> Lines:
    """Own features of whole texts, with those of the neighbouring lines of the same text."""
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lengths])])
    flat = np.concatenate(own)
    n = len(flat)
    has_before, has_after = np.ones(n, bool), np.ones(n, bool)
    has_before[bounds[:-1]] = False
    has_after[bounds[1:] - 1] = False
    before, after = np.zeros_like(flat), np.zeros_like(flat)
    before[1:], after[:-1] = flat[:-1], flat[1:]
    before[~has_before] = 0
    after[~has_after] = 0
    parts = [flat, before, after, has_before[:, None], has_after[:, None], np.ones((n, 1))]
    return Lines(np.hstack(parts), np.concatenate(lengths), bounds)


@dataclass
class Field:
    """Weights of the features for the label good, and scores of label pairs [before][after]."""

    weights: np.ndarray
    pairs: np.ndarray

    def emissions(self, lines: Lines) -> np.ndarray:
        return lines.features @ self.weights


def recursions(e: np.ndarray, pairs: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per line the log odds of good by all lines up to it, and by all lines after it.

    All texts take a step together, the longest first, so that a step's texts are a prefix.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    forward, backward = np.zeros(len(e)), np.zeros(len(e))
    still = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    forward[starts] = e[starts]
    for t in range(1, sizes[0]):
        at = starts[: still[t]] + t
        f = forward[at - 1]
        forward[at] = (
            e[at]
            + np.logaddexp(pairs[0, 1], f + pairs[1, 1])
            - np.logaddexp(pairs[0, 0], f + pairs[1, 0])
        )
    for t in range(sizes[0] - 2, -1, -1):
        at = starts[: still[t + 1]] + t
        b = e[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(pairs[1, 0], pairs[1, 1] + b) - np.logaddexp(
            pairs[0, 0], pairs[0, 1] + b
        )
    return forward, backward


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def document_quality(field: Field, lines: Lines) -> np.ndarray:
    """Per text the mean probability of good, weighted by the lines' lengths."""
    forward, backward = recursions(field.emissions(lines), field.pairs, lines.bounds)
    good = sigmoid(forward + backward)
    starts = lines.bounds[:-1]
    weighted = np.add.reduceat(good * lines.lengths, starts)
    return np.clip(weighted / np.add.reduceat(lines.lengths, starts), 0.0, 1.0)


def trained(lines: Lines, labels: np.ndarray, steps: int = STEPS) -> Field:
    """Maximise the likelihood of the labels (1 good), every text counting the same."""
    sizes = np.diff(lines.bounds)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    y = labels[text_of].astype(float)
    weight = 1.0 / sizes[text_of] / len(sizes)
    mean = np.average(lines.features, axis=0)
    scale = np.maximum(lines.features.std(axis=0), 1e-3)
    mean[-1], scale[-1] = 0.0, 1.0
    x = (lines.features - mean) / scale
    linked = np.flatnonzero(text_of[1:] == text_of[:-1])
    params = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, pairs = params[:-4], params[-4:].reshape(2, 2)
        e = x @ w
        forward, backward = recursions(e, pairs, lines.bounds)
        slope = x.T @ (weight * (y - sigmoid(forward + backward)))
        # Expected pairs of labels under the field, against those of the labels.
        ahead = e[linked + 1] + backward[linked + 1]
        scores = np.stack([
            np.full(len(linked), pairs[0, 0]),
            pairs[0, 1] + ahead,
            pairs[1, 0] + forward[linked],
            pairs[1, 1] + forward[linked] + ahead,
        ])
        scores = np.exp(scores - scores.max(axis=0))
        scores /= scores.sum(axis=0)
        seen = np.stack([(y[linked] == a) & (y[linked + 1] == b) for a in (0, 1) for b in (0, 1)])
        pair_slope = ((seen - scores) * weight[linked]).sum(axis=1)
        gradient = np.concatenate([slope, pair_slope]) - RIDGE * params
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        params = params + RATE * move
    w = params[:-4] / scale
    w[-1] -= mean @ w
    return Field(w, params[-4:].reshape(2, 2))


def training_rows(docs: DataFrame, labels: DataFrame, docs_at_most: int, lines_at_most: int) -> DataFrame:
    """(quality, own, lengths): features of a sample of labelled documents, chosen by a hash.

    Only labels whose crc32(doc_id as text) mod 3 is not 1 are used; of repeated labels of a document
    the mean counts. Documents of more lines than ``lines_at_most`` are not trained on; of rows of one
    id, each text counts once, and at most TRAIN_TEXTS texts, chosen by a hash.
    """
    usable = labels.where("quality is not null and doc_id is not null").where(~held_out("doc_id"))
    chosen = (
        usable.groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(docs_at_most)
        .withColumnRenamed("doc_id", "labelled")
    )
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = body.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    short = sample.where(F.size(F.split("text", "\n", -1)) <= lines_at_most)
    of_id = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    few = (
        short.select("quality", "text", "doc_id")
        .distinct()
        .withColumn("place", F.row_number().over(of_id))
        .where(F.col("place") <= TRAIN_TEXTS)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [own_features(data) for data in text_bytes(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["quality"],
                    pa.array([f.astype(np.float32).tobytes() for f, _ in found], pa.binary()),
                    pa.array([n.astype(np.float32).tobytes() for _, n in found], pa.binary()),
                    batch["doc_id"],
                ],
                ["quality", "own", "lengths", "doc_id"],
            )

    return few.select("quality", "text", "doc_id").mapInArrow(
        run, "quality int, own binary, lengths binary, doc_id long"
    )


def held_out(key: str) -> Column:
    """Rows that are kept from training: crc32(id as text) mod 3 is 1; no id: false."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    docs_at_most: int = TRAIN_DOCS,
    lines_at_most: int = TRAIN_LINES,
) -> Field:
    """The field, trained on at most so many documents; without any label every score is 0.5."""
    rows = training_rows(docs, labels, docs_at_most, lines_at_most).collect()
    # Sums of floating-point numbers need a fixed order; repeated documents count once.
    kept = {(r["doc_id"], bytes(r["own"])): r for r in rows}
    rows = [kept[key] for key in sorted(kept)]
    if len({r["quality"] for r in rows}) < 2:
        return Field(np.zeros(N_FEATURES), np.zeros((2, 2)))
    own = [np.frombuffer(r["own"], np.float32).reshape(-1, len(OWN)).astype(float) for r in rows]
    lengths = [np.frombuffer(r["lengths"], np.float32).astype(float) for r in rows]
    return trained(gathered(own, lengths), np.array([r["quality"] for r in rows]))


def quality_of(field: Field):
    """A column function: the quality of a text, between 0 and 1; null counts as empty."""

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        scores: list[np.ndarray] = []
        own, lengths, size = [], [], 0

        def flush() -> None:
            if own:
                scores.append(document_quality(field, gathered(own, lengths)))
                own.clear()
                lengths.clear()

        for data in text_bytes(texts):
            found, length = own_features(data)
            own.append(found)
            lengths.append(length)
            size += len(data)
            if size >= GROUP_BYTES:
                flush()
                size = 0
        flush()
        return pa.array(np.concatenate(scores) if scores else np.empty(0), pa.float64())

    return quality


def scored(docs: DataFrame, labels: DataFrame, name: str = "score", **bounds) -> DataFrame:
    """The documents with their quality; all rows and columns stay."""
    return docs.withColumn(name, quality_of(fitted(docs, labels, **bounds))(F.col("text")))
