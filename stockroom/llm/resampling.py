"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (unigrams and bigrams, in
``BUCKETS`` buckets) are counted: one over the target, the documents
labelled good, and one over all raw documents. The log ratio of the two is a
document's importance weight. Documents are sampled without replacement in
proportion to their weights by the Gumbel top-k rule: add Gumbel noise,
seeded by the document's key, to the log weight and keep the k largest. k is
the labelled share of good documents times the number of documents, or the
number of documents that are likelier under the target, if that is more.

The k-th largest value is found exactly by a radix histogram over the bits
of the noisy weight: at most 4096 counts reach the driver for each 12 bits.

The labels may be a bounded sample: at most about ``MAX_LABELLED`` rows,
chosen by a hash of the id, are broadcast. Raw counts cover all documents.

Defined results
    null and empty texts have weight 0 (only noise); a null id shares the
    noise of all null ids; repeated rows get equal values and are kept or
    rejected together, as are all ties at the k-th value; without labels, or
    with no good label, every document is kept; an empty table gives an
    empty result; extra columns are kept by ``resampled_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.bytehash import BASE, SPACE, ByteHasher, mixed
from stockroom.llm.vectors import SCHEMA, as_rows, summed
from stockroom.session import cut_lineage

BUCKETS = 1 << 14
MAX_LABELLED = 200_000
SEED = 11
RADIX = 12
# classes of bytes: 0 space, 1 letters, digits and non-ASCII, 2 the rest
KIND = np.full(256, 2, dtype=np.int8)
KIND[SPACE] = 0
KIND[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = 1


def features(text: str | None, hasher: ByteHasher) -> np.ndarray:
    """Bucket of every unigram and bigram of the lower-cased tokens (runs of
    letters and digits, runs of punctuation). All bigrams of one token with
    itself are one feature."""
    codes = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    if len(codes) == 0:
        return np.empty(0, dtype=np.int64)
    kind = KIND[codes]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(kind)) + 1, [len(codes)]])
    starts, ends = edges[:-1], edges[1:]
    used = kind[starts] != 0
    one = hasher.spans(codes, starts[used], ends[used])
    two = mixed(one[:-1] * np.uint64(BASE) + one[1:])
    two[one[:-1] == one[1:]] = 0
    return (np.concatenate([one, two]) >> np.uint64(64 - 14)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Log ratio of target to raw for each bucket; None: nothing to learn from."""

    log_ratio: np.ndarray | None
    share: float
    n_docs: int


def labelled_sample(labels: DataFrame, good: Column, key: str, most: int) -> DataFrame:
    """(key, good) of at most about ``most`` labelled ids, by hash."""
    rows = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(good.cast("int")).alias("good"))
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod(F.xxhash64("id", F.lit("labels")), F.lit(1_000_000)) < int(1e6 * most / n))
    return rows


def fit(docs: DataFrame, labels: DataFrame, good: Column, key: str = "doc_id", text: str = "text",
        most: int = MAX_LABELLED) -> Model:
    """Count the two models in one pass over the documents."""
    marks = F.broadcast(labelled_sample(labels, good, key, most))  # bounded by ``most``
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(marks, "id", "left").select("text", "good")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, counts = ByteHasher(), np.zeros((3, BUCKETS), dtype=np.int64)
        for batch in batches:
            for body, mark in zip(batch["text"], batch["good"].fillna(-1), strict=True):
                found = np.bincount(features(body, hasher), minlength=BUCKETS)
                counts[0] += found
                if mark == 1:
                    counts[1] += found
                counts[2, :3] += (1, mark >= 0, mark == 1)
        yield as_rows(counts.ravel(), BUCKETS)

    raw, target, seen = summed(rows.mapInPandas(run, SCHEMA), 3, BUCKETS).reshape(3, BUCKETS)
    n_docs, n_marked, n_good = (int(x) for x in seen[:3])
    if n_good == 0:
        return Model(None, 1.0, n_docs)
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    return Model(ratio, n_good / n_marked, n_docs)


def sortable(x: np.ndarray) -> np.ndarray:
    """Signed 64-bit integers in the order of the doubles."""
    bits = x.view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def scorer(model: Model, seed: int = SEED):
    """Pandas UDF (text, key hash) -> struct(log_weight, noisy, bits)."""
    shared = model.log_ratio

    @F.pandas_udf("log_weight double, noisy double, bits long")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        hasher = ByteHasher()
        for texts, keys in parts:
            weights = np.array([0.0 if shared is None else shared[features(t, hasher)].sum() for t in texts], dtype=np.float64)
            hashed = mixed(keys.to_numpy(dtype=np.int64).view(np.uint64) + np.uint64(seed))
            uniform = ((hashed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            noisy = weights - np.log(-np.log(uniform))
            yield pd.DataFrame({"log_weight": weights, "noisy": noisy, "bits": sortable(noisy)})

    return score


def kth_largest(bits: DataFrame, k: int) -> int:
    """The k-th largest value of the column ``bits`` (signed), exactly."""
    shifted = bits.select((F.col("bits").bitwiseXOR(F.lit(-(2**63)))).alias("bits"))
    prefix, left = 0, 64
    while left > 0:
        width = min(RADIX, left)
        left -= width
        digit = F.shiftrightunsigned("bits", left).bitwiseAND(F.lit(2**width - 1))
        inside = shifted if left + width == 64 else shifted.filter(F.shiftrightunsigned("bits", left + width) == F.lit(prefix))
        for row in sorted(inside.groupBy(digit.alias("digit")).count().collect(), key=lambda r: -r["digit"]):
            if k <= row["count"]:
                prefix = prefix << width | row["digit"]
                break
            k -= row["count"]
    return prefix - 2**63


def threshold(scored: DataFrame, model: Model) -> int:
    """Smallest ``bits`` that is kept."""
    if model.log_ratio is None:
        return -(2**63)
    k = max(round(model.share * model.n_docs), scored.filter("log_weight > 0").count())
    if k >= model.n_docs:
        return -(2**63)
    return kth_largest(scored.select("bits"), k) if k else 2**63 - 1


def judge(docs: DataFrame, labels: DataFrame, good: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, log_weight, noisy, kept."""
    model = fit(docs, labels, good, key, text)
    scored = docs.select(key, scorer(model)(F.col(text), F.xxhash64(F.col(key))).alias("s")).select(key, "s.*")
    scored = cut_lineage(scored, "importance")
    return scored.select(key, "log_weight", "noisy", (F.col("bits") >= threshold(scored, model)).alias("kept"))


def resampled_documents(docs: DataFrame, labels: DataFrame, good: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, with their columns."""
    model = fit(docs, labels, good, key, text)
    score = scorer(model)(F.col(text), F.xxhash64(F.col(key)))
    least = threshold(cut_lineage(docs.select(score.alias("s")).select("s.*"), "importance"), model)
    return docs.filter(score["bits"] >= least)
