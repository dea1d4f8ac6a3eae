"""Ranked lexical search, term at a time with a limit on accumulators.

Query items are scored against all documents. A document's score for an
item is the sum of integer contributions of the item's terms.

1. One pass over the texts keeps, for each document, its length and the
   counts of those terms that some item asks for (``postings``).
2. Document frequencies and lengths are summed over all documents.
3. Each task scores its own documents, a shard at a time. Within a shard the
   terms of an item are taken rarest first. Every posting of a term adds to
   its document's accumulator. No accumulator is created any more once the
   largest contributions that the remaining terms can make in the shard sum
   up to less than the k-th best partial score: a document without an
   accumulator can no longer come in. Accumulators that exist go on to be
   updated, so their scores are exact.
4. The best k of all shards are ranked, in two steps.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, whatever their
number: what is broadcast is one block's terms. No document is shuffled.

Defined results
    null texts and texts without a term are no documents of the statistics
    and are found by nothing; rows with equal ids are documents of their
    own; a null document id ranks behind equal scores; items with equal ids
    (null is one) are one item with the terms of all its rows; an item
    without terms or without a hit has no rows; empty tables give an empty
    result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockroom.llm.bytehash import ByteHasher
from stockroom.llm.tokens import blocks, byte_class, slices
from stockroom.session import cut_lineage

TOP = 20
BLOCK_TERMS = 1 << 18
SHARD_POSTINGS = 1 << 21  # postings that a task scores at once
SLOT_BITS = 20
SALTS = 64

# Letters and digits of ASCII, and everything beyond ASCII.
TERM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


class Vocabulary:
    """Sorted term hashes with a table of slots for fast lookups."""

    def __init__(self, terms: np.ndarray) -> None:
        self.terms = terms
        slots = (terms >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.first = np.searchsorted(slots, np.arange((1 << SLOT_BITS) + 1)).astype(np.int32)
        self.chain = int(np.diff(self.first).max(initial=0))

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` of known terms, and their ids."""
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at = np.flatnonzero(self.first[slot + 1] > self.first[slot])
        slot, wanted = slot[at], hashes[at]
        found = np.full(len(at), -1, dtype=np.int64)
        for step in range(self.chain):
            place = np.minimum(self.first[slot] + step, len(self.terms) - 1)
            found = np.where(self.terms[place] == wanted, place, found)
        known = found >= 0
        return at[known], found[known]


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term, times) of every item; terms are 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHasher()
        for batch in batches:
            for part in slices(batch):
                for block in blocks(part.column("text"), ~TERM):
                    starts, ends, rows = block.words(TERM)
                    found = block.hashes(hasher, starts, ends).view(np.int64)
                    yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(rows)), pa.array(found)], names=["item", "term"])

    rows = items.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "item long, term long").groupBy("item", "term").agg(F.count("*").alias("times"))


def postings(docs: DataFrame, vocabulary: np.ndarray, key: str, text: str) -> DataFrame:
    """(id, n, terms, counts): every document's length in terms and its counts of the vocabulary's."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, words = ByteHasher(), Vocabulary(known.value)
        width = np.int64(max(1, len(words.terms)))
        for batch in batches:
            for part in slices(batch):
                n = np.zeros(part.num_rows, dtype=np.int64)
                keys = []
                for block in blocks(part.column("text"), ~TERM):
                    starts, ends, rows = block.words(TERM)
                    n += np.bincount(rows, minlength=len(n))
                    at, ids = words.ids(block.hashes(hasher, starts, ends))
                    keys.append(rows[at] * width + ids)
                pairs, counts = np.unique(np.concatenate(keys), return_counts=True)
                bounds = np.searchsorted(pairs, np.arange(part.num_rows + 1) * width).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(n),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array((pairs % width).astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(counts)),
                    ],
                    names=["id", "n", "terms", "counts"],
                )

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, n long, terms array<int>, counts array<long>")


@dataclass
class Plan:
    """What a task needs to score: of each item its id and its terms, rarest
    first, with their repeats; the weight of each term; N and L."""

    items: list[tuple[int | None, np.ndarray, np.ndarray]]
    weights: np.ndarray
    documents: int
    length: int


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Shard:
    """Some documents' postings, by term, with each posting's contribution."""

    def __init__(self, ids: pa.Array, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, plan: Plan) -> None:
        self.ids, self.size = ids, len(n)
        lengths, of = np.unique(n, return_inverse=True)
        m = np.array([75 + 25 * int(x) * plan.documents // plan.length for x in lengths], dtype=np.int64)[of]
        docs = np.repeat(np.arange(self.size), sizes)
        gain = plan.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 12 * m[docs]))
        order = np.argsort(terms, kind="stable")
        self.docs, self.gain = docs[order], gain[order]
        self.first = np.searchsorted(terms[order], np.arange(len(plan.weights) + 1))
        self.bound = np.zeros(len(plan.weights), dtype=np.int64)
        full = np.flatnonzero(np.diff(self.first))
        if len(full):
            self.bound[full] = np.maximum.reduceat(self.gain, self.first[full])
        self.scores = np.zeros(self.size, dtype=np.int64)
        self.has = np.zeros(self.size, dtype=bool)

    def best(self, terms: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that hold the best k of the shard."""
        most = times * self.bound[terms]
        rest = np.cumsum(most[::-1])[::-1]  # the most that this term and all behind it can add
        created: list[np.ndarray] = []
        held, creating = 0, True
        for j, term in enumerate(terms):
            span = slice(self.first[term], self.first[term + 1])
            docs, gain = self.docs[span], self.gain[span] * times[j]
            if creating and held >= k and rest[j] < rest[0] - rest[j]:  # else no partial score can be that high
                partial = self.scores[np.concatenate(created)]
                creating = rest[j] >= np.partition(partial, held - k)[held - k]
            if creating:
                new = docs[~self.has[docs]]
                self.has[new] = True
                created.append(new)
                held += len(new)
            else:
                old = self.has[docs]
                docs, gain = docs[old], gain[old]
            self.scores[docs] += gain  # a document stands once in a posting list
        found = np.concatenate(created) if created else np.zeros(0, dtype=np.int64)
        scores = self.scores[found]
        self.scores[found], self.has[found] = 0, False
        if len(found) > k:  # ties with the k-th stay: ids decide
            near = scores >= np.partition(scores, len(found) - k)[len(found) - k]
            found, scores = found[near], scores[near]
        return found[scores > 0], scores[scores > 0]


def shard_hits(found: DataFrame, plan: Plan, k: int) -> DataFrame:
    """(item, id, score): at least the best k documents of each shard for each item."""
    shared = found.sparkSession.sparkContext.broadcast((plan.items, plan.weights, plan.documents, plan.length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Plan(*shared.value)
        held: list[pa.RecordBatch] = []
        postings_held = 0
        for batch in batches:
            held.append(batch)
            postings_held += len(batch.column("terms").flatten())
            if postings_held >= SHARD_POSTINGS:
                yield hits(held, own)
                held, postings_held = [], 0
        if held:
            yield hits(held, own)

    def hits(held: list[pa.RecordBatch], own: Plan) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, terms, counts = (table.column(c).combine_chunks() for c in ("id", "terms", "counts"))
        sizes = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        shard = Shard(ids, table.column("n").to_numpy(), sizes, terms.flatten().to_numpy(), counts.flatten().to_numpy(), own)
        docs, items, scores = [], [], []
        for item, its_terms, times in own.items:
            at, score = shard.best(its_terms, times, k)
            docs.append(at)
            scores.append(score)
            items.extend([item] * len(at))
        return pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), ids.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))],
            names=["item", "id", "score"],
        )

    return found.mapInArrow(run, "item long, id long, score long")


def top_ranks(hits: DataFrame, k: int) -> DataFrame:
    """(item, id, score) -> the k best of each item with their rank. An item's
    hits are cut by parts first, so no task gets all of them."""
    best = (F.col("score").desc(), F.col("id").asc_nulls_last())
    part = F.pmod(F.xxhash64("id", "score"), F.lit(SALTS))
    for keys in (("item", "part"), ("item",)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        hits = hits.withColumn("part", part).withColumn("rank", rank).filter(F.col("rank") <= k)
    return hits.select("item", "rank", "id", "score")


def _blocks_of_items(terms: DataFrame, most: int) -> Iterator[list]:
    """The items' term rows in blocks; an item's rows stay together."""
    total = terms.count()
    count = -(-total // most)
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, count)))
    for k in range(count):
        yield terms.filter(block == k).collect()


def _plan(rows: list, vocabulary: np.ndarray, found: DataFrame) -> Plan:
    documents, length = found.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for term, count in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = count
    weights = np.array([weight(documents, int(x)) for x in df], dtype=np.int64)
    of: dict[int | None, list[tuple[int, int, int]]] = {}
    for item, term, times in rows:
        place = int(np.searchsorted(vocabulary, np.uint64(term % 2**64)))
        of.setdefault(item, []).append((int(df[place]), place, times))
    items = [(item, *(np.array(x, dtype=np.int64) for x in list(zip(*sorted(its)))[1:])) for item, its in of.items()]
    return Plan(items, weights, documents, length or 1)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0."""
    spark: SparkSession = docs.sparkSession
    terms = cut_lineage(item_terms(items, item_id, item_text), "item-terms")
    out = spark.createDataFrame([], "item long, rank int, id long, score long")
    for rows in _blocks_of_items(terms, block_terms):
        if not rows:
            continue
        vocabulary = np.unique(np.array([row["term"] for row in rows], dtype=np.int64).view(np.uint64))
        found = cut_lineage(postings(docs, vocabulary, doc_id, text), "postings")
        hits = cut_lineage(shard_hits(found, _plan(rows, vocabulary, found), k), "shard-hits")
        out = out.union(top_ranks(hits, k))
    return out.select(F.col("item").alias(item_id), "rank", F.col("id").alias(doc_id), "score")
