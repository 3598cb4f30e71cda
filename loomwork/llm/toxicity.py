"""Toxicity by multiple-instance learning: a document is toxic if some sentence is."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.hashing import LETTER, ODD, Texts, mix, words
from loomwork.llm.ship import bucket_of, map_batches, piece

# Sentences end at these characters.
_ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?\n"])


@dataclass(frozen=True)
class Fit:
    """Parameters of learning.

    At most ``sample_rows`` labelled documents are learned from, taken in order
    of a hash of their id, until they have ``total_chars`` characters; of a
    document of more than ``sample_chars`` a piece that long is taken.  This
    bounds what the driver holds.  Words are marked by a hash of the whole word
    and of its first bytes; ``bits`` is the logarithm of the number of weights.
    Only features whose presence in a document tells its label apart by a
    log-likelihood ratio of ``evidence`` (twice that of the constant rate) get
    a weight.
    """

    sample_rows: int = 8000
    sample_chars: int = 64_000
    total_chars: int = 24_000_000
    bits: int = 20
    prefixes: tuple[int, ...] = (4, 5, 6)
    evidence: float = 20.0
    epochs: int = 150
    rate: float = 0.5
    decay: float = 1e-4
    start: float = -8.0


@dataclass
class Bags:
    """Sentences of a batch of documents as lists of feature numbers."""

    features: np.ndarray
    sentence: np.ndarray
    document: np.ndarray
    spans: np.ndarray


def bags(texts: Texts, fit: Fit) -> Bags:
    """Split texts into sentences and words; sentences without a word are left out.

    ``sentence`` numbers the sentence of each feature, ``document`` the text of
    each sentence, ``spans`` its first and last byte in the text.
    """
    found = words(texts, LETTER)
    ends = np.flatnonzero(_ENDS[texts.data]) if len(texts.data) else np.zeros(0, np.int64)
    cuts = np.union1d(ends, texts.offsets[:-1] - 1)
    number = np.searchsorted(cuts, found.starts)
    kept, sentence = np.unique(number, return_inverse=True)
    mask = np.uint64((1 << fit.bits) - 1)
    columns = [found.hashes] + [mix(found.prefixes(k) * ODD[k]) for k in fit.prefixes]
    features = np.stack(columns, axis=1) if len(found.hashes) else np.zeros((0, len(columns)), np.uint64)
    features = (features & mask).astype(np.int64)
    firsts = np.searchsorted(sentence, np.arange(len(kept)))
    lasts = np.append(firsts[1:], len(sentence)) - 1
    document = np.searchsorted(texts.offsets, found.starts[firsts], side="right") - 1 if len(kept) else firsts
    # Empty texts share an offset with the text after them.
    begin = found.starts[firsts] - texts.offsets[document] if len(kept) else firsts
    end = found.starts[lasts] + found.lengths[lasts] - texts.offsets[document] if len(kept) else firsts
    return Bags(features, sentence, document, np.stack([begin, end], axis=1))


def _chance(sums: np.ndarray, bias: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(sums + bias, -30, 30)))


def _sentence_scores(found: Bags, weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of each sentence from the weights of its words."""
    return _chance(
        np.bincount(found.sentence, weights[found.features].sum(axis=1), minlength=len(found.document)), bias
    )


def learn(texts: list[str], labels: np.ndarray, fit: Fit = Fit()) -> tuple[np.ndarray, float]:
    """Weights and bias that make noisy-or of sentences fit document labels.

    The chance of a document is 1 - prod(1 - q) over the chances q of its
    sentences; its log-likelihood is climbed with a step size per weight
    (Adagrad).  Without documents of both labels all weights stay 0.
    """
    weights, bias = np.zeros(1 << fit.bits), fit.start
    labels = np.asarray(labels, dtype=np.float64)
    if not len(labels) or labels.min() == labels.max():
        return weights, bias
    chosen = _telling(texts, labels, fit)
    if not len(chosen):
        return weights, bias
    number = np.full(len(weights), -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    # Entries of chosen features, and all sentences: few numbers a document.
    entries, sentences, documents = [], [], []
    for first, found in _chunks(texts, fit):
        at = number[found.features]
        rows, columns = np.nonzero(at >= 0)
        entries.append(at[rows, columns])
        sentences.append(found.sentence[rows] + sum(map(len, documents)))
        documents.append(found.document + first)
    entry, sentence, document = map(np.concatenate, (entries, sentences, documents))
    w, squares, bias_square = np.zeros(len(chosen)), np.full(len(chosen), 1e-8), 1e-8
    for _ in range(fit.epochs):
        q = _chance(np.bincount(sentence, w[entry], minlength=len(document)), bias)
        clean = np.bincount(document, np.log1p(-np.minimum(q, 1 - 1e-9)), minlength=len(labels))
        whole = np.clip(1 - np.exp(clean), 1e-9, 1 - 1e-9)
        # d loss / d logit of a sentence: q for clean documents, q (1 - 1 / P) for toxic ones.
        slope = q * np.where(labels > 0, 1 - 1 / whole, 1.0)[document]
        gradient = np.bincount(entry, slope[sentence], minlength=len(w)) + fit.decay * len(labels) * w
        squares += gradient**2
        w -= fit.rate * gradient / np.sqrt(squares)
        bias_gradient = slope.sum()
        bias_square += bias_gradient**2
        bias -= fit.rate * bias_gradient / np.sqrt(bias_square)
    weights[chosen] = w
    return weights, float(bias)


def _chunks(texts: list[str], fit: Fit, size: int = 256):
    """Bags of a few texts at a time, with the number of the first."""
    for first in range(0, len(texts), size):
        yield first, bags(Texts.of(pa.array(texts[first : first + size], pa.large_string())), fit)


def _telling(texts: list[str], labels: np.ndarray, fit: Fit) -> np.ndarray:
    """Features whose documents differ from the rest in their share of toxic ones."""
    seen, toxic = np.zeros(1 << fit.bits), np.zeros(1 << fit.bits)
    for first, found in _chunks(texts, fit):
        document = found.document[found.sentence]
        pairs = np.unique((document[:, None].astype(np.int64) << fit.bits | found.features).ravel())
        feature = pairs & ((1 << fit.bits) - 1)
        seen += np.bincount(feature, minlength=len(seen))
        toxic += np.bincount(feature, labels[(pairs >> fit.bits) + first], minlength=len(seen))
    rate = labels.mean()

    def part(k, share):
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / np.maximum(seen * share, 1e-9)), 0.0)

    ratio = 2 * (part(toxic, rate) + part(seen - toxic, 1 - rate))
    return np.flatnonzero(ratio >= fit.evidence)


def labelled_sample(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``fit.sample_rows`` labelled documents."""
    marks = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(bucket_of(F.col("doc_id"), 4) != 2)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # Ids are drawn before texts are fetched.
    drawn = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.sample_rows)
    texts = docs.where("text IS NOT NULL").select("doc_id", piece(F.col("text"), fit.sample_chars).alias("text"))
    few = texts.join(F.broadcast(drawn), "doc_id").withColumn("_order", F.xxhash64("doc_id", "text"))
    few = few.orderBy("_order", "doc_id", "text").limit(fit.sample_rows)
    # Over no more than the rows of the sample.
    so_far = F.sum(F.char_length("text")).over(Window.orderBy("_order", "doc_id", "text"))
    return few.withColumn("_chars", so_far).where(F.col("_chars") <= fit.total_chars).drop("_order", "_chars")


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> tuple[np.ndarray, float]:
    """Learn from a bounded sample of labelled documents on the driver."""
    rows = labelled_sample(docs, labels, fit).select("text", "toxic").collect()
    return learn([r["text"] for r in rows], np.array([r["toxic"] > 0 for r in rows]), fit)


def score_batch(texts: pa.Array, weights: np.ndarray, bias: float, fit: Fit, threshold: float):
    """Noisy-or score of each text, and the spans of its offending sentences."""
    found = bags(Texts.of(texts), fit)
    q = _sentence_scores(found, weights, bias)
    clean = np.bincount(found.document, np.log1p(-np.minimum(q, 1 - 1e-12)), minlength=len(texts))
    guilty = np.flatnonzero(q >= threshold)
    return 1 - np.exp(clean), found.document[guilty], found.spans[guilty], q[guilty]


def toxicity(
    docs: DataFrame,
    weights: np.ndarray,
    bias: float,
    fit: Fit = Fit(),
    threshold: float = 0.3,
    locate: bool = True,
) -> DataFrame:
    """Score every whole text and locate the sentences at fault.

    A text without a word, null included, has no sentence and scores 0.
    Repeated rows score alike, null ids are kept, other columns are ignored, and
    an empty table gives no rows.

    Returns ``doc_id, score, predicted`` and, if asked to ``locate``,
    ``sentences``: first and last byte in the text and score of each sentence
    whose own score reaches ``threshold``.
    """
    model = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))

    def run(batch: pa.RecordBatch):
        learned, offset = model.value
        scores, document, spans, q = score_batch(batch.column(1), learned, offset, fit, threshold)
        columns, names = [batch.column(0), pa.array(scores)], ["doc_id", "score"]
        if locate:
            bounds = np.searchsorted(document, np.arange(batch.num_rows + 1))
            inner = pa.StructArray.from_arrays(
                [pa.array(spans[:, 0]), pa.array(spans[:, 1]), pa.array(q)], names=["first", "last", "score"]
            )
            columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), inner).cast(span))
            names.append("sentences")
        yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, score double"
    if locate:
        schema += ", sentences array<struct<first:bigint,last:bigint,score:double>>"
    scored = map_batches(docs.select("doc_id", "text"), run, schema, max_bytes=2 << 20)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
