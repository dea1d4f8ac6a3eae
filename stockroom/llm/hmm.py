"""Hidden Markov language model over word classes.

The most frequent words of the training documents are classes of their own;
all other words fall into groups by their last two bytes. The model is

    P(text) = sum over state paths of prod P(state | last) P(class | state)
              times prod P(word | class)

with P(word | class) = (c + 1) / (words + distinct words + 1 of the group)
from the counts of all training documents, and one share for unknown words.

Training is Baum-Welch: each round every task runs scaled forward-backward
over its documents and adds up expected counts; the sums of all tasks give
the next parameters. Scoring is the scaled forward recursion, which is the
exact likelihood. Documents are packed whole into lanes that step together.

Word counts are a distributed table keyed by 64-bit word hashes. Words above
a count threshold, at most ``HEAD`` of them, are broadcast; the counts of
all other words are joined to the documents that hold them.

Defined results
    null and blank texts are the end token alone; a null id counts as empty
    text in the split; repeated rows get equal scores; without training
    documents all words are unknown and the model is uniform over classes;
    an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.bytehash import ByteHasher, mixed, word_spans
from stockroom.llm.vectors import SCHEMA, as_rows, summed
from stockroom.session import cut_lineage

STATES = 8
ROUNDS = 4
OWN_CLASS = 4095  # words that are classes of their own; class 0 is the end
GROUPS = 1024
CLASSES = 1 + OWN_CLASS + GROUPS
HEAD = 1 << 17
END = np.uint64(1)  # hash of the end token
LANES = 256
CHUNK = 1 << 19  # tokens that step together
FLUSH = 1 << 20
PRIOR = 10.0
SLICE = 4096
LENGTH = -(-(1 + STATES + STATES * STATES + STATES * CLASSES) // SLICE) * SLICE


def held_out(doc_id: str, modulus: int = 7, remainder: int = 2) -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == remainder


def tokens(text: str | None, hasher: ByteHasher) -> tuple[np.ndarray, np.ndarray]:
    """(hash, group) of every word, A-Z lowered, and of the end token."""
    codes = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    starts, ends = word_spans(codes)
    words = hasher.spans(codes, starts, ends)
    before = np.where(ends - starts > 1, codes[ends - 2], 0) if len(ends) else codes[:0]
    last = codes[ends - 1] if len(ends) else codes[:0]
    suffix = before.astype(np.uint64) << np.uint64(8) | last.astype(np.uint64)
    groups = (mixed(suffix) % np.uint64(GROUPS)).astype(np.int32)
    return np.append(words, END), np.append(groups, np.int32(-1))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, grp, c) over all texts; word is the 64-bit hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, held, size = ByteHasher(), [], 0

        def flush() -> pd.DataFrame:
            words = np.concatenate([w for w, _ in held])
            groups = np.concatenate([g for _, g in held])
            found, first, n = np.unique(words, return_index=True, return_counts=True)
            return pd.DataFrame({"word": found.view(np.int64), "grp": groups[first], "c": n})

        for batch in batches:
            for text in batch["text"]:
                held.append(tokens(text, hasher))
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = texts.select("text").mapInPandas(run, "word long, grp int, c long")
    return rows.groupBy("word", "grp").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Counts of the frequent words and sizes of the groups."""

    words: np.ndarray  # sorted hashes of the head
    counts: np.ndarray
    classes: np.ndarray  # class of each head word; -1: its group
    group_total: np.ndarray  # words + distinct words + 1 of each group
    n_tokens: int
    n_distinct: int

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, in the head)."""
        at = np.searchsorted(self.words, words).clip(max=max(len(self.words) - 1, 0))
        return at, (self.words[at] == words if len(self.words) else np.zeros(len(words), dtype=bool))


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """Read the bounded parts of the count table."""
    step = F.floor(F.log2("c") * 16).alias("step")
    steps = counts.groupBy(step).agg(F.count("*").alias("n"), F.sum("c").alias("total")).orderBy(F.desc("step")).collect()
    kept, lowest = 0, 0
    for row in steps:  # whole steps of the histogram, at most ``head`` words
        kept += row["n"]
        if kept > head:
            lowest = row["step"] + 1
            break
    frequent = counts.filter(F.floor(F.log2("c") * 16) >= lowest)
    table = frequent.toPandas().sort_values(["c", "word"], ascending=[False, True])
    is_end = table["word"] == int(END)
    table["cls"] = -1
    ranked = table.index[~is_end][:OWN_CLASS]
    table.loc[ranked, "cls"] = np.arange(1, len(ranked) + 1)
    table.loc[is_end, "cls"] = 0
    own = table[table["cls"] >= 0]
    by_group = counts.groupBy("grp").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    total = np.ones(GROUPS, dtype=np.int64)
    for r in by_group:
        if r["grp"] >= 0:
            total[r["grp"]] += r["n"] + r["v"]
    for grp, c in zip(own["grp"], own["c"], strict=True):
        if grp >= 0:
            total[grp] -= c + 1
    words = table["word"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    return Vocabulary(words[order], table["c"].to_numpy(dtype=np.int64)[order], table["cls"].to_numpy(dtype=np.int64)[order], total,
                      sum(r["total"] for r in steps), sum(r["n"] for r in steps))


ENCODED = ("id long, held_out boolean, rid long, n_tokens long, head_known long, head_log double, head_group_log double, "
           "group_norm double, classes binary, tail array<bigint>, tail_n array<int>")


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), type=kind))


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Class sequence of every document, the sums over its frequent words and
    the list of its other words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, v = ByteHasher(), shared.value
        norms, logs = np.log10(v.group_total), np.log10(v.counts + 1.0)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sums, classes, tails, times = [], [], [], []
                for text in batch.column("text"):
                    words, groups = tokens(text.as_py(), hasher)
                    where, known = v.find(words)
                    own = np.full(len(words), -1)
                    own[known] = v.classes[where[known]]
                    own[-1] = 0
                    grouped = own < 0
                    tail, n = np.unique(words[~known], return_counts=True)
                    sums.append((len(words), known.sum(), logs[where[known]].sum(), logs[where[known & grouped]].sum(), norms[groups[grouped]].sum()))
                    classes.append(np.where(grouped, 1 + OWN_CLASS + groups, own).astype(np.uint16).tobytes())
                    tails.append(tail.view(np.int64))
                    times.append(n.astype(np.int32))
                size, head_known, *others = zip(*sums, strict=True)
                columns = [*(batch.column(c) for c in ("id", "held_out", "rid")), pa.array(size, pa.int64()), pa.array(head_known, pa.int64()),
                           *(pa.array(x, pa.float64()) for x in others), pa.array(classes, pa.binary()), _lists(tails, pa.int64()), _lists(times, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "held_out", "rid", "n_tokens", "head_known", "head_log", "head_group_log",
                                                                 "group_norm", "classes", "tail", "tail_n"])

    return docs.mapInArrow(run, ENCODED)


@dataclass
class Hmm:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states

    @staticmethod
    def initial(seed: int = 5) -> Hmm:
        rng = np.random.default_rng(seed)
        start = rng.dirichlet(np.full(STATES, 5.0))
        move = 0.5 * np.eye(STATES) + 0.5 * rng.dirichlet(np.full(STATES, 5.0), size=STATES)
        emit = np.exp(rng.normal(size=(CLASSES, STATES)))
        return Hmm(start, move, emit / emit.sum(axis=0))


class Lanes:
    """Whole documents packed into lanes, longest first into the shortest
    lane. Lanes are ordered by length, so the lanes that still run at a step
    are the first ones; all tables are flat, a step after the other."""

    def __init__(self, docs: list[np.ndarray], lanes: int = LANES) -> None:
        sizes = np.array([len(d) for d in docs])
        lanes = min(lanes, len(docs))
        heap, place = [(0, lane) for lane in range(lanes)], [[] for _ in range(lanes)]
        for k in np.argsort(-sizes, kind="stable"):
            load, lane = heap[0]
            place[lane].append(k)
            heapq.heapreplace(heap, (load + int(sizes[k]), lane))
        loads = np.zeros(lanes, dtype=np.int64)
        loads[[lane for _, lane in heap]] = [load for load, _ in heap]
        order = np.argsort(-loads, kind="stable")
        self.active = np.searchsorted(-loads[order], -np.arange(loads.max()), side="left")
        self.begin = np.concatenate([[0], np.cumsum(self.active)])
        self.classes = np.empty(self.begin[-1], dtype=np.int64)
        self.doc = np.empty(self.begin[-1], dtype=np.int64)
        self.first, self.last = [], []
        for lane, source in enumerate(order):
            at = 0
            for k in place[source]:
                rows = self.begin[at : at + sizes[k]] + lane
                self.classes[rows], self.doc[rows] = docs[k], k
                self.first.append((at, lane))
                at += sizes[k]
                self.last.append((at - 1, lane))
        self.starting, self.ending = self._by_step(self.first), self._by_step(self.last)

    @staticmethod
    def _by_step(marks: list[tuple[int, int]]) -> dict[int, list[int]]:
        found: dict[int, list[int]] = {}
        for step, lane in marks:
            found.setdefault(step, []).append(lane)
        return found

    def forward(self, hmm: Hmm) -> tuple[np.ndarray, np.ndarray]:
        """Scale of each row (its product over a document is the likelihood)
        and the scaled forward variables."""
        alphas = hmm.emit[self.classes]
        scale, ones = np.empty(len(alphas)), np.ones(STATES)
        last = np.zeros((self.active[0], STATES))
        for t, n in enumerate(self.active.tolist()):
            now = last[:n] @ hmm.move
            begins = self.starting.get(t)
            if begins:
                now[begins] = hmm.start
            rows = slice(self.begin[t], self.begin[t + 1])
            now *= alphas[rows]
            total = now @ ones
            now /= total[:, None]
            scale[rows], alphas[rows] = total, now
            last = now
        return scale, alphas

    def log_likelihoods(self, hmm: Hmm, n_docs: int) -> np.ndarray:
        """Natural log of each document's probability."""
        scale, _ = self.forward(hmm)
        return np.bincount(self.doc, weights=np.log(scale), minlength=n_docs)

    def expected_counts(self, hmm: Hmm) -> np.ndarray:
        """log likelihood, starts, moves, emissions: one flat vector."""
        scale, alphas = self.forward(hmm)
        scaled = hmm.emit[self.classes] / scale[:, None]
        begins = np.array([self.begin[t] + lane for t, lane in self.first])
        moves = np.zeros((STATES, STATES))
        back = np.ascontiguousarray(hmm.move.T)
        ahead = np.zeros((self.active[0], STATES))  # emission x backward of the next step, scaled
        for t in range(len(self.active) - 1, -1, -1):
            n, rows = self.active[t], slice(self.begin[t], self.begin[t + 1])
            ends = self.ending.get(t)
            if ends:
                ahead[ends] = 0
            moves += alphas[rows].T @ ahead[:n]
            beta = ahead[:n] @ back
            if ends:
                beta[ends] = 1
            alphas[rows] *= beta  # from here on: chance of each state
            np.multiply(scaled[rows], beta, out=ahead[:n])
        start = alphas[begins].sum(axis=0)
        emit = np.stack([np.bincount(self.classes, weights=alphas[:, k], minlength=CLASSES) for k in range(STATES)], axis=1)
        flat = np.concatenate([[np.log(scale).sum()], start, (moves * hmm.move).ravel(), emit.ravel()])
        return np.concatenate([flat, np.zeros(LENGTH - len(flat))])


def chunks(batches: Iterator[pd.DataFrame], column: str = "classes") -> Iterator[tuple[pd.DataFrame, Lanes]]:
    """Documents in lanes, about CHUNK tokens of like lengths at a time."""
    for batch in batches:
        batch = batch.sort_values("n_tokens", ascending=False)
        ends = np.cumsum(batch["n_tokens"].to_numpy()) // CHUNK
        for _, part in batch.groupby(ends, sort=False):
            yield part, Lanes([np.frombuffer(c, dtype=np.uint16) for c in part[column]])


def train(encoded: DataFrame, rounds: int = ROUNDS) -> Hmm:
    """Baum-Welch over the training rows of the encoded documents."""
    hmm = Hmm.initial()
    rows = encoded.filter(~F.col("held_out")).select("n_tokens", "classes")
    if rows.isEmpty():
        return Hmm(hmm.start, hmm.move, np.full((CLASSES, STATES), 1 / CLASSES))
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(hmm)

        def expect(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            total = np.zeros(LENGTH)
            for _, lanes in chunks(batches):
                total += lanes.expected_counts(shared.value)
            yield as_rows(total, SLICE)

        flat = summed(rows.mapInPandas(expect, SCHEMA), LENGTH // SLICE, SLICE, np.float64)
        a, b = 1 + STATES, 1 + STATES + STATES**2
        start, moves = flat[1:a] + 0.1, flat[a:b].reshape(STATES, STATES) + 0.1
        emit = flat[b : b + CLASSES * STATES].reshape(CLASSES, STATES)
        overall = (emit.sum(axis=1) + 1) / (emit.sum() + CLASSES)
        emit = emit + PRIOR * overall[:, None]
        hmm = Hmm(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
        shared.unpersist()
    return hmm


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score, score_per_token."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    counts = cut_lineage(word_counts(rows.filter(~F.col("held_out"))), "word-counts")
    vocab = vocabulary(counts, head)
    encoded = cut_lineage(encode(rows.withColumn("rid", F.monotonically_increasing_id()), vocab), "encoded")
    hmm = train(encoded, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(hmm)

    def likelihoods(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, lanes in chunks(batches):
            yield pd.DataFrame({"rid": part["rid"], "path_log": lanes.log_likelihoods(shared.value, len(part)) / np.log(10)})

    paths = encoded.select("rid", "n_tokens", "classes").mapInPandas(likelihoods, "rid long, path_log double")
    tail = encoded.select("rid", F.inline(F.arrays_zip(F.col("tail").alias("word"), F.col("tail_n").alias("n")))).join(counts.select("word", "c"), "word")
    tail = tail.groupBy("rid").agg(F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_log"),
        # the end has a class of its own, also where it is not among the frequent words
        F.sum(F.when(F.col("word") != int(END), F.col("n") * F.log10(F.col("c") + 1))).alias("tail_group_log"))
    joined = encoded.drop("classes", "tail", "tail_n").join(paths, "rid").join(tail, "rid", "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    score = F.col("path_log") + F.col("head_group_log") + F.coalesce("tail_group_log", F.lit(0.0)) - F.col("group_norm")
    return joined.select(
        F.col("id").alias(doc_id), "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n_tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * F.lit(float(np.log10(vocab.n_tokens + vocab.n_distinct + 1)))).alias("base_score"),
        score.alias("score"), (score / F.col("n_tokens")).alias("score_per_token"),
    )
