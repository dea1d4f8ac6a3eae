"""Language identification with a blended-spectrum string kernel.

Two texts are compared by the presence of character n-grams of lengths
2 to 4 (letters lowered, hashed into ``FEATURES`` bits): the number of common
n-grams over the geometric mean of the two counts. A fixed number of
landmark documents per language gives the Nyström feature map of that
kernel; kernel ridge regression, one language versus the rest, is solved in
the landmark space from sums that the tasks gather over the training rows.
Prediction multiplies a batch of presence rows with the landmark matrix and
the result with the weights.

The training rows may be a bounded sample of the labelled rows: at most
about ``MAX_TRAIN``, by a hash of the id, and ``LEAST_TRAIN`` of each language
besides. Whole texts are used throughout.

Defined results
    null text, empty text or text without a letter: ``und`` with score 0; a
    null id is not held out; ties go to the first language in code point
    order; repeated rows get equal results; with no training row all results
    are ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.bytehash import BASE, mixed
from stockroom.llm.vectors import SCHEMA, as_rows, summed

SIZES = (2, 3, 4)
FEATURE_BITS = 15
FEATURES = 1 << FEATURE_BITS
LANDMARKS = 24  # for each language
MAX_TRAIN = 20_000
LEAST_TRAIN = 200  # rows of each language, or all that it has
RIDGE = 1e-3
SHARPNESS = 4.0
BATCH = 128
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def present(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    seen = np.zeros(FEATURES, dtype=bool)
    for n in SIZES:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                h = h * np.uint64(BASE) + codes[k : len(codes) - n + 1 + k]
            seen[(mixed(h) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def presence_rows(texts: list[str]) -> np.ndarray:
    """One row per text: presence of each feature over the root of their number."""
    rows = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for k, text in enumerate(texts):
        found = present(text)
        if len(found):
            rows[k, found] = 1 / np.sqrt(len(found))
    return rows


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # features x landmarks, as presence rows
    weights: np.ndarray  # landmarks + 1 (bias) x languages, in kernel space

    def scores(self, texts: list[str]) -> np.ndarray:
        kernel = presence_rows(texts) @ self.landmarks
        return kernel.astype(np.float64) @ self.weights[:-1] + self.weights[-1]


def has_letter(text: str | None) -> bool:
    return text is not None and LETTER.search(text) is not None


def held_out(doc_id: str, modulus: int = 4, remainder: int = 2) -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == remainder


def training_sample(docs: DataFrame, most: int = MAX_TRAIN, doc_id: str = "doc_id", lang: str = "lang", text: str = "text",
                    least: int = LEAST_TRAIN) -> DataFrame:
    """(id, lang, text) of the training rows: about ``most``, the same share of
    every language, but at least about ``least`` rows (or all) of each. The
    languages are counted over all rows, so that none is lost to the bound."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(doc_id))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    total = sum(counts.values())
    if total > most:
        million = 1_000_000
        shares = {name: min(million, max(million * most // total, -(-million * least // n))) for name, n in counts.items()}
        share = F.element_at(F.create_map(*(F.lit(x) for pair in shares.items() for x in pair)), F.col(lang))
        rows = rows.filter(F.pmod(F.xxhash64(F.col(doc_id), F.lit("train")), F.lit(million)) < share)
    return rows.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))


def _landmarks(sample: DataFrame, per_language: int) -> np.ndarray:
    """Presence columns of the first rows of each language by hash of the id."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id", F.lit("landmark")), "id")
    chosen = sample.select("id", "lang").dropDuplicates(["id"]).withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_language)
    chosen = F.broadcast(chosen.select("id"))  # languages x per_language rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "found": [present(t).astype(np.int32).tobytes() for t in batch["text"]]})

    rows = sample.join(chosen, "id", "left_semi").select("id", "text").mapInPandas(run, "id long, found binary").dropDuplicates(["id"])
    found = [np.frombuffer(r["found"], dtype=np.int32) for r in rows.orderBy("id").collect()]
    matrix = np.zeros((FEATURES, len(found)), dtype=np.float32)
    for k, features in enumerate(found):
        if len(features):
            matrix[features, k] = 1 / np.sqrt(len(features))
    return matrix


def fit(docs: DataFrame, per_language: int = LANDMARKS, most: int = MAX_TRAIN, ridge: float = RIDGE,
        doc_id: str = "doc_id", lang: str = "lang", text: str = "text") -> Model | None:
    sample = training_sample(docs, most, doc_id, lang, text)
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    if not languages:
        return None
    landmarks = _landmarks(sample, per_language)
    size = landmarks.shape[1]
    # Nyström: the root of the inverse kernel matrix of the landmarks
    values, vectors = np.linalg.eigh((landmarks.T @ landmarks).astype(np.float64))
    used = values > 1e-6 * values.max()
    root = vectors[:, used] / np.sqrt(values[used])
    width = root.shape[1] + 1
    shared = sample.sparkSession.sparkContext.broadcast((landmarks, root))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns, to_features = shared.value
        number = {name: k for k, name in enumerate(languages)}
        sums = np.zeros((width, width + len(languages)))
        for batch in batches:
            batch = batch[[has_letter(t) for t in batch["text"]]]
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                phi = np.ones((len(part), width))
                phi[:, :-1] = (presence_rows(part["text"].tolist()) @ columns).astype(np.float64) @ to_features
                y = -np.ones((len(part), len(languages)))
                y[np.arange(len(part)), part["lang"].map(number)] = 1
                sums += phi.T @ np.hstack([phi, y])
        yield as_rows(sums.ravel(), sums.size)

    total = summed(sample.select("lang", "text").mapInPandas(gather, SCHEMA), 1, width * (width + len(languages)), np.float64)
    total = total.reshape(width, -1)
    n = max(total[-1, width - 1], 1.0)
    solved = np.linalg.solve(total[:, :width] + ridge * n * np.diag([1.0] * (width - 1) + [1e-6]), total[:, width:])
    weights = np.vstack([root @ solved[:-1], solved[-1:]])
    assert weights.shape == (size + 1, len(languages))
    return Model(languages, landmarks, weights)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` less the text, plus lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        for texts in parts:
            out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0})
            known = np.flatnonzero([fitted is not None and has_letter(t) for t in texts])
            for at in range(0, len(known), BATCH):
                rows = known[at : at + BATCH]
                raw = SHARPNESS * fitted.scores([texts.iloc[k] for k in rows])
                chance = np.exp(raw - raw.max(axis=1, keepdims=True))
                best = chance.argmax(axis=1)
                out.loc[rows, "lang_pred"] = [fitted.languages[k] for k in best]
                out.loc[rows, "score"] = 1 / chance.sum(axis=1)
            yield out

    others = [c for c in docs.columns if c != text]
    return docs.select(*others, language(F.col(text)).alias("__p")).select(*others, "__p.*")
