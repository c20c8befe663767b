"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.texts import hashes, joined, slices, words_of
from farelane.session import save_table

#: Bits of a feature's number, labelled rows that a fit reads at most, and passes over them.
BITS, SAMPLE_ROWS, PASSES = 20, 10_000, 5
#: Per-coordinate rate, its offset, and the L1 and L2 strengths.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0
#: Gaps of the skip-grams; 1 is a bigram.
GAPS = (1, 2)

#: Bytes of text whose features a task holds at once.
HELD_BYTES = 1 << 20
#: Letters of a word's stem.
STEM = 5

_EDGES = " .,;:!?\"'()[]{}<>*_~-"


def features(text: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of each feature: words and their stems, pairs of neighbours, and pairs with a
    word between."""
    rows, index, words = words_of(pc.ascii_lower(text))
    words = pc.ascii_trim(words, characters=_EDGES)
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    keep = filled[index]
    rows, index = rows[keep], index[keep]
    word = hashes(words)[index] if len(index) else np.zeros(0, np.uint64)
    stem = hashes(pc.utf8_slice_codeunits(words, 0, STEM))[index] if len(index) else word
    shift = np.uint64(64 - bits)
    out_rows, out = [rows, rows], [joined(word) >> shift, joined(stem, stem) >> shift]
    for gap in GAPS:
        same = rows[gap:] == rows[:-gap]
        out_rows.append(rows[gap:][same])
        pair = joined(word[:-gap], word[gap:], np.full(max(len(word) - gap, 0), gap, np.uint64))
        out.append((pair >> shift)[same])
    return np.concatenate(out_rows), np.concatenate(out).astype(np.int64)


def distinct(rows: np.ndarray, numbers: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Each feature of a row once, by row."""
    both = np.unique((rows.astype(np.int64) << bits) | numbers)
    return both >> bits, both & ((1 << bits) - 1)


class Ftrl:
    """Weights that follow from the sums ``z`` and ``n`` of each coordinate; small ``z`` is weight 0."""

    def __init__(self, bits: int = BITS) -> None:
        # One more coordinate for the bias, which L1 leaves alone.
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.l1 = np.full((1 << bits) + 1, L1)
        self.l1[-1] = 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n, l1 = self.z[at], self.n[at], self.l1[at]
        dense = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, dense)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        sigma = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient * gradient


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, bits: int = BITS) -> dict[int, float]:
    """Weights by feature, only those that are not 0; the bias has the number ``1 << bits``.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``. At most ``rows``
    labelled ids are learnt from, the first by a hash of the id: a bound on the fit, which is made in
    one task. Null labels are left out; an id labelled twice counts as toxic if one label says so,
    and of several texts of an id the first by text is taken. Without labels there are no weights
    and every score is 0.5.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    known = known.agg(F.max("toxic").alias("toxic")).withColumn("order", F.xxhash64("doc_id"))
    sample = known.orderBy("order", "doc_id").limit(rows)
    texts = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic", "order").agg(F.min("text").alias("text"))

    def hashed(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=HELD_BYTES):
            at, numbers = distinct(*features(batch.column("text"), bits), bits)
            cuts = np.searchsorted(at, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("order"),
                    batch.column("toxic").cast(pa.int32()),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(numbers.astype(np.int32))),
                ],
                ["order", "toxic", "features"],
            )

    def learned(batches) -> Iterator[pa.RecordBatch]:
        rows, bias = [], np.array([1 << bits], dtype=np.int32)
        for batch in batches:
            for x, y in zip(batch.column("features"), batch.column("toxic").to_pylist()):
                rows.append((np.concatenate([x.values.to_numpy(), bias]), y))
        model = Ftrl(bits)
        for _ in range(PASSES):
            for at, label in rows:
                model.learn(at, label)
        weights = model.weights(np.arange((1 << bits) + 1))
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], ["feature", "weight"])

    lists = texts.mapInArrow(hashed, "order long, toxic int, features array<int>")
    one = save_table(lists, "features").coalesce(1).sortWithinPartitions("order")
    return {r.feature: r.weight for r in one.mapInArrow(learned, "feature long, weight double").collect()}


def _scored(docs: DataFrame, weights: dict[int, float], text_col: str, bits: int = BITS) -> DataFrame:
    """``doc``, all columns of ``docs`` as they are, and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(
        (np.array(list(weights), dtype=np.int64), np.array(list(weights.values())))
    )

    def scored(batches) -> Iterator[pa.RecordBatch]:
        at, weight = sent.value
        dense = np.zeros((1 << bits) + 1)
        dense[at] = weight

        def of(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, numbers = features(batch.column("text"), bits)
            used = dense[numbers] != 0
            rows, numbers = distinct(rows[used], numbers[used], bits)
            total = np.bincount(rows, weights=dense[numbers], minlength=batch.num_rows) + dense[-1]
            out = pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))
            return pa.RecordBatch.from_arrays([batch.column("doc"), out], ["doc", "score"])

        # Nothing of a slice is left when the next one is taken.
        yield from map(of, slices(batches, "text", HELD_BYTES))

    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs[text_col].alias("text"))
    return given.mapInArrow(scored, f"doc {given.schema['doc'].dataType.simpleString()}, score double")


def score(docs: DataFrame, weights: dict[int, float], text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1; all other columns stay, whatever their names.
    One that is named ``score`` is an error.

    A feature counts once for each document. Null and empty texts have the bias alone.
    """
    if "score" in docs.columns:
        raise ValueError("the column score must be free")
    return _scored(docs, weights, text_col, bits).select("doc.*", "score")


def held_out(doc_id: Column) -> Column:
    """Whether an id is kept from learning: the checksum of its text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each of ``docs``.

    Learns from labels of ids that are not held out, and only from the words of their texts. Null ids
    are held out. Repeated rows are scored each for itself; an empty table gives no row.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    labels = labels.select("doc_id", "toxic").filter(~held_out(F.col("doc_id")))
    weights = fit(docs, labels)
    # The text ends here: it is scored under another name and not returned.
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").alias("given"))
    scored = score(rows, weights, "given")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that score 0.5 or more; all columns stay, whatever their names.

    If nothing was learnt, as without usable labels, every score is 0.5 and all documents stay.
    """
    labels = labels.select("doc_id", "toxic").filter(~held_out(F.col("doc_id")))
    weights = fit(docs.select("doc_id", "text"), labels)
    if not weights:
        return docs
    return _scored(docs, weights, "text").filter("score < 0.5").select("doc.*")
