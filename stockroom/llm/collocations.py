"""Collocations: phrase counts by vertical partitioning of word suffixes.

A suffix is a word and the words behind it in its piece, cut at depth
``DEPTH``. All suffixes together form a tree whose nodes are phrases; a
node's count is the number of suffixes below it. The tree is never built as
a whole:

1. Words are counted (depth one of the tree). Only frequent words can stand
   in a candidate, so suffixes end before a rare word; the test is a bitmap
   of fixed size, which lets a few rare words pass but stops no other one.
2. The prefixes are dealt into groups by a memory budget: word hashes fall
   into ``1 << GROUP_BITS`` ranges, neighbouring ranges are joined while their
   suffixes fit the budget, and a range beyond the budget (a very frequent
   word) has its prefixes extended to the full depth and is dealt over as
   many groups as it needs.
3. The suffixes go to their groups in packed blocks, equal ones of a block
   counted once. Each group sorts its suffixes, which is its subtree in
   preorder, and reads the counts of all nodes from the leaf totals. Groups
   do not depend on each other: a lost one is built again alone.
4. Counts of a prefix that was dealt over several groups are summed.

Scores, the removal of phrases inside longer ones and the ranks are joins
and aggregates over the frequent phrases. Words travel as 64-bit hashes of
(language, word); the texts of the ranked phrases are read in a last pass.

Defined results
    a null language is ``und``; null and blank texts have no words; repeated
    rows count as often as they stand there; an empty table gives an empty
    result. Scores are computed in DECIMAL(38). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.bitmaps import bitmap, holds
from stockroom.llm.bytehash import ByteHasher, mixed
from stockroom.llm.tokens import blocks, byte_class, slices
from stockroom.session import cut_lineage

DEPTH = 3
LEAST = 10  # occurrences of a candidate
COVERED = 50  # percent of them inside one longer candidate
TOP = 2000
BUDGET = 1 << 20  # suffixes of a group
GROUP_BITS = 16
BLOCK_ROWS = 1024
SALTS = 64

# Pieces end at . , ; : ! ? and line ends; words end at blanks too.
PIECE_END = byte_class((0x2E, 0x2E), (0x2C, 0x2C), (0x3A, 0x3B), (0x21, 0x21), (0x3F, 0x3F), (0x0A, 0x0D))
WORD = ~(PIECE_END | byte_class((0x20, 0x20), (0x09, 0x09)))


def text_rows(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))


def words_of(part: pa.RecordBatch, hasher: ByteHasher):
    """(block, starts, ends, rows, hashes of language and word, new piece before the word) for each block."""
    salt = _lang_salts(part.column("lang"), hasher)
    for block in blocks(part.column("text"), PIECE_END):
        starts, ends, rows = block.words(WORD)
        hashes = mixed(block.hashes(hasher, starts, ends) + salt[rows])
        pieces = np.cumsum(PIECE_END[block.codes])
        piece = pieces[starts] if len(starts) else starts
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (piece[1:] != piece[:-1]) | (rows[1:] != rows[:-1])
        yield block, starts, ends, rows, hashes, new


def _lang_salts(column: pa.Array, hasher: ByteHasher) -> np.ndarray:
    found = pc.dictionary_encode(column)
    names = [x.encode() for x in found.dictionary.to_pylist()]
    salts = np.array([hasher.spans(np.frombuffer(x, dtype=np.uint8), np.array([0]), np.array([len(x)]))[0] for x in names], dtype=np.uint64)
    # mixed once more: a word that is spelled like a language's name has the same hash
    return mixed(salts + np.uint64(1))[found.indices.to_numpy(zero_copy_only=False)]


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, lang, f) of all words; ``word`` is the hash of language and word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHasher()
        for batch in batches:
            for part in slices(batch, BLOCK_ROWS):
                hashes, at = [], []
                for _, _, _, rows, found, _ in words_of(part, hasher):
                    hashes.append(found)
                    at.append(rows)
                hashes, first, count = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
                lang = part.column("lang").take(pa.array(np.concatenate(at)[first]))
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), lang, pa.array(count)], names=["word", "lang", "f"])

    counted = rows.mapInArrow(run, "word long, lang string, f long")
    return counted.groupBy("word", "lang").agg(F.sum("f").alias("f"))


class Groups:
    """Deals prefixes into groups: ``first`` and ``count`` of each hash range."""

    def __init__(self, suffixes: np.ndarray, budget: int) -> None:
        self.first, self.count = np.zeros(len(suffixes), dtype=np.int64), np.ones(len(suffixes), dtype=np.int64)
        group, held = 0, 0
        for k, n in enumerate(suffixes.tolist()):
            if n > budget:
                group += held > 0
                self.count[k] = -(-n // budget)
                self.first[k], held = group, 0
                group += int(self.count[k])
                continue
            if held + n > budget:
                group, held = group + 1, 0
            self.first[k], held = group, held + n

    def of(self, prefix: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """The group of each suffix, from the hashes of its first word and of all its words."""
        at = (prefix >> np.uint64(64 - GROUP_BITS)).astype(np.int64)
        return self.first[at] + (whole % self.count[at].astype(np.uint64)).astype(np.int64)


def suffix_blocks(rows: DataFrame, frequent: np.ndarray, groups: Groups) -> DataFrame:
    """(group, words, codes, counts): packed suffixes of two words or more.
    ``words`` are hashes; ``codes`` holds DEPTH places in it for each suffix
    (0: the suffix has ended; else place + 1)."""
    shared = rows.sparkSession.sparkContext.broadcast((frequent, groups.first, groups.count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHasher()
        known, first, count = shared.value
        deal = Groups(np.zeros(0, dtype=np.int64), 1)
        deal.first, deal.count = first, count
        for batch in batches:
            for part in slices(batch, BLOCK_ROWS):
                suffixes = [cut_suffixes(hashes, new, holds(known, hashes)) for *_, hashes, new in words_of(part, hasher)]
                yield packed(np.concatenate(suffixes), deal)

    return rows.mapInArrow(run, "group int, words binary, codes binary, counts binary")


def cut_suffixes(hashes: np.ndarray, new: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The suffixes of at least two frequent words, DEPTH hashes each (0: ended)."""
    n = len(hashes)
    out = np.zeros((n, DEPTH), dtype=np.uint64)
    out[:, 0] = hashes
    goes_on = frequent.copy()
    for k in range(1, min(DEPTH, n)):
        goes_on = goes_on[:-1] & frequent[k:] & ~new[k:]
        out[: n - k, k] = np.where(goes_on, hashes[k:], np.uint64(0))
    return out[out[:, 1] != 0] if n > 1 else out[:0]


def packed(suffixes: np.ndarray, groups: Groups) -> pa.RecordBatch:
    """One row for each group with the distinct suffixes and their counts."""
    whole = suffixes[:, 0]
    for k in range(1, DEPTH):
        whole = mixed(whole * np.uint64(0x9E3779B97F4A7C15) + suffixes[:, k])
    whole, first, counts = np.unique(whole, return_index=True, return_counts=True)
    suffixes = suffixes[first]
    group = groups.of(suffixes[:, 0], whole)
    order = np.argsort(group, kind="stable")
    group, suffixes, counts = group[order], suffixes[order], counts[order]
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    out: tuple[list, list, list] = ([], [], [])
    for at, to in zip(starts, np.append(starts, len(group))[1:], strict=True):
        own = suffixes[at:to]
        words, codes = np.unique(own[own != 0], return_inverse=True)
        filled = np.zeros(own.shape, dtype=np.uint32)
        filled[own != 0] = codes + 1
        out[0].append(words.tobytes())
        out[1].append(filled.T.tobytes())
        out[2].append(counts[at:to].astype(np.uint32).tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(group[starts].astype(np.int32)), *(pa.array(x, pa.binary()) for x in out)], names=["group", "words", "codes", "counts"])


def subtree(blocks_of_group: list[tuple[bytes, bytes, bytes]], split: bool, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrases, counts) of a group's nodes of depth two and more. Nodes below
    ``least`` go, unless other groups hold a part of them (``split``)."""
    suffixes, counts = [], []
    for words, codes, count in blocks_of_group:
        names = np.concatenate([np.zeros(1, dtype=np.uint64), np.frombuffer(words, dtype=np.uint64)])
        suffixes.append(names[np.frombuffer(codes, dtype=np.uint32).reshape(DEPTH, -1)])
        counts.append(np.frombuffer(count, dtype=np.uint32))
    tree, leaves = np.concatenate(suffixes, axis=1), np.concatenate(counts).astype(np.int64)
    order = np.lexsort(tree[::-1])
    tree, leaves = tree[:, order], leaves[order]
    phrases, totals = [], []
    begins = np.zeros(tree.shape[1], dtype=bool)
    begins[0] = True
    begins[1:] = tree[0, 1:] != tree[0, :-1]
    for depth in range(1, DEPTH):
        begins[1:] |= tree[depth, 1:] != tree[depth, :-1]
        at = np.flatnonzero(begins)
        total = np.add.reduceat(leaves, at)
        # whole nodes below the limit go; the last depth is never split
        keep = (tree[depth, at] != 0) & ((total >= least) | (split and depth < DEPTH - 1))
        node = tree[:, at[keep]].copy()
        node[depth + 1 :] = 0
        phrases.append(node)
        totals.append(total[keep])
    return np.concatenate(phrases, axis=1), np.concatenate(totals)


def phrase_counts(rows: DataFrame, words: DataFrame, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """(w1, w2, w3, f): all phrases of two and three words with f >= least;
    w3 is 0 for two words. ``words``: (word, f) of the words with f >= least."""
    ranges = np.zeros(1 << GROUP_BITS, dtype=np.int64)
    place = F.shiftrightunsigned("word", 64 - GROUP_BITS)
    for at, total in words.groupBy(place.alias("at")).agg(F.sum("f")).collect():
        ranges[at] = total
    groups = Groups(ranges, budget)
    dealt_over = {int(g) for k in np.flatnonzero(groups.count > 1) for g in range(groups.first[k], groups.first[k] + groups.count[k])}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, bytes]] = []
        current = -1
        for batch in batches:
            for group, *block in zip(*(batch.column(c).to_pylist() for c in ("group", "words", "codes", "counts")), strict=True):
                if group != current and held:
                    yield nodes(held, current)
                    held = []
                current = group
                held.append(tuple(block))
        if held:
            yield nodes(held, current)

    def nodes(held: list[tuple[bytes, bytes, bytes]], group: int) -> pa.RecordBatch:
        phrases, totals = subtree(held, group in dealt_over, least)
        return pa.RecordBatch.from_arrays([*(pa.array(w.view(np.int64)) for w in phrases), pa.array(totals)], names=["w1", "w2", "w3", "f"])

    dealt = suffix_blocks(rows, bitmap(words, F.col("word")), groups)
    dealt = dealt.repartition("group").sortWithinPartitions("group")
    built = dealt.mapInArrow(build, "w1 long, w2 long, w3 long, f long")
    summed = built.groupBy("w1", "w2", "w3").agg(F.sum("f").alias("f"))
    return cut_lineage(summed.filter(F.col("f") >= least), "phrases")


def scored(phrases: DataFrame, words: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, w1, w2, w3, a, l, r, score) of the candidates that no longer one covers."""
    longer = phrases.filter("w3 <> 0")
    inside = longer.select("w1", "w2", "f").union(longer.select("w2", "w3", "f")).groupBy("w1", "w2").agg(F.max("f").alias("most"))
    twos = phrases.filter("w3 = 0").join(cut_lineage(inside, "phrase-covers"), ["w1", "w2"], "left")
    twos = twos.filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("f") * covered)).drop("most")

    single = words.select("word", F.col("f").alias("one"), "lang")
    pair = phrases.filter("w3 = 0").select(F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("f").alias("two"))

    def named(side: str, column: str) -> DataFrame:
        return single.select(F.col("word").alias(column), F.col("one").alias(side), *(["lang"] if column == "w1" else []))

    twos = twos.join(named("l1", "w1"), "w1").join(named("r1", "w2"), "w2")
    twos = twos.select("lang", "w1", "w2", "w3", F.col("f").alias("a"), F.array(F.struct(F.lit(1).alias("k"), F.col("l1").alias("l"), F.col("r1").alias("r"))).alias("cuts"))
    threes = longer.join(named("l1", "w1"), "w1").join(named("r2", "w3"), "w3")
    threes = threes.join(pair.select(F.col("p1").alias("w1"), F.col("p2").alias("w2"), F.col("two").alias("l2")), ["w1", "w2"])
    threes = threes.join(pair.select(F.col("p1").alias("w2"), F.col("p2").alias("w3"), F.col("two").alias("r1")), ["w2", "w3"])
    cuts = F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)))
    threes = threes.select("lang", "w1", "w2", "w3", F.col("f").alias("a"), cuts.alias("cuts"))

    score = F.expr("transform(cuts, c -> struct(cast(a as decimal(18,0)) * cast(a as decimal(18,0)) * 1000000BD"
                   " div (cast(c.l as decimal(18,0)) * cast(c.r as decimal(18,0))) as score, c.k as k, c.l as l, c.r as r))")
    lowest = twos.union(threes).withColumn("cut", F.array_min(score))
    return lowest.select("lang", "w1", "w2", "w3", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score"))


def leaders(found: DataFrame, k: int) -> DataFrame:
    """Each language's first k by score and a, with all ties of the last one;
    cut by parts first, so no task gets a whole language."""
    best = (F.col("score").desc(), F.col("a").desc())
    part = F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS))
    for keys in (("lang", "part"), ("lang",)):
        place = F.rank().over(Window.partitionBy(*keys).orderBy(*best))
        found = found.withColumn("part", part).withColumn("place", place).filter(F.col("place") <= k)
    return found.drop("part", "place")


def spelled(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(word, spelling) of the wanted word hashes, read from the texts."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(wanted, F.col("word")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = ByteHasher(), np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for part in slices(batch, BLOCK_ROWS):
                for block, starts, ends, _, hashes, _ in words_of(part, hasher):
                    at = np.flatnonzero(holds(shared.value, hashes))
                    new, first = np.unique(hashes[at], return_index=True)
                    fresh = ~np.isin(new, seen, assume_unique=True)
                    new, at = new[fresh], at[first[fresh]]
                    data = block.codes.tobytes()
                    spelling = [data[s:e].decode("utf-8", "replace") for s, e in zip(starts[at], ends[at], strict=True)]
                    seen = np.concatenate([seen, new]) if len(seen) < 1 << 20 else new
                    yield pa.RecordBatch.from_arrays([pa.array(new.view(np.int64)), pa.array(spelling, pa.string())], names=["word", "spelling"])

    found = rows.mapInArrow(run, "word long, spelling string").groupBy("word").agg(F.min("spelling").alias("spelling"))
    return found.join(wanted, "word", "left_semi")


def collocations(docs: DataFrame, k: int = TOP, least: int = LEAST, covered: int = COVERED, lang: str = "lang",
                 text: str = "text", budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best k collocations."""
    rows = text_rows(docs, lang, text)
    counted = cut_lineage(word_counts(rows), "words")
    totals = cut_lineage(counted.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
    words = cut_lineage(counted.filter(F.col("f") >= least), "frequent-words")
    phrases = phrase_counts(rows, words, least, budget)
    best = cut_lineage(leaders(scored(phrases, words, covered), k), "leading-phrases")

    places = best.select("lang", "w1", "w2", "w3", F.posexplode(F.array("w1", "w2", "w3")).alias("at", "word")).filter("word <> 0 or at < 2")
    spelling = cut_lineage(spelled(rows, places.select("word").distinct()), "spellings")
    texts = places.join(spelling, "word").groupBy("w1", "w2", "w3").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "spelling"))), lambda x: x["spelling"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.join(texts, ["w1", "w2", "w3"]).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= k)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
