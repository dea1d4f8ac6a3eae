"""Nearest neighbours by inner product with multi-index hashing.

Binary codes are the signs of a learned rotation of the vectors (iterative
quantisation, fitted on a bounded sample). A code is split into substrings
and each substring has its own index. If two codes differ in at most ``r``
bits, some substring differs in at most ``r // substrings`` bits; so probing
every index within that distance retrieves every code within the Hamming
radius r of a query. What is retrieved is reranked by the inner product of
the original vectors in double precision.

The vectors are written once, in pieces of at most ``PIECE`` bytes. A task
holds a group of queries and streams a share of the pieces past it, ``BLOCK``
codes at a time, each block with its own substring indexes; it keeps the k + 1
best vectors of each query, so that what it returns does not grow with the
number of blocks. There are at least ``SHARES`` shares, and more only as long
as all that is returned stays below the number of vectors. Nothing is copied
for the visits: the tasks read pieces and groups where they lie.

Probes that would retrieve a good part of a block (a large radius) do not pay:
then all products of the block are computed in single precision, and what may
be among the best by them, error included, is held against the radius and
scored like the rest.

Equal vectors are one entry with their smallest ids, of which no result can
need more than k + 1, so that a vector with very many copies costs as much as
one. The radius is the one that holds ``RECALL`` of the true neighbours of the
sample. Queries with fewer than k + 1 vectors inside it are asked again with a
larger one, until they have them or all vectors are in.

Inner products of vectors of different lengths are reduced to angles by one
more component that brings every vector to the largest length.

Defined results
    null vectors, zero vectors and vectors with a null or non-finite
    component take no part, neither as query nor as candidate; null ids
    neither; rows with equal id and equal vector are one row; vectors of
    another dimension than most take no part; ties go to the smaller id; an
    empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from stockroom.session import cut_lineage, small_batches

BITS = 64
SUBSTRINGS = 4
WIDTH = BITS // SUBSTRINGS
SAMPLE = 4096
ROTATIONS = 40
RECALL = 0.99
BLOCK = 16384
FIRST = 2048  # codes in a task's first block
MOST = 1 << 24  # bytes of doubles in a block
PIECE = 1 << 19  # bytes of vectors in a row of the index
# row groups of a few pieces, so that readers take up a few at a time
PIECES_TABLE = {"parquet.block.row.count.limit": "16"}
QUERIES = (256, 4096)  # in a group: no fewer for more tasks, no more than these
GROUP = 1 << 20  # bytes of single-precision vectors in a group of queries
SHARES = 4
TILE = 2048  # codes whose products are computed at once
CHUNK = 256  # queries held against a block at once
PAIRS = 1 << 15  # pairs scored at once
PAYS = 8  # probes may retrieve one in so many codes


@dataclass(frozen=True)
class Coder:
    """Rotation learned on a sample, largest squared length, search radius."""

    mean: np.ndarray
    rotation: np.ndarray  # (dimension + 1) x BITS
    longest: float
    radius: int

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def substrings(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes of the rows of x as ``SUBSTRINGS`` columns of unsigned ints."""
        up = np.column_stack([x, np.zeros(len(x))]) if query else self.lifted(x)
        bits = (up - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(f">u{WIDTH // 8}").astype(np.uint32)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which each of a differs from each of b."""
    return np.bitwise_count(a[:, None] ^ b[None, :])


def learn(x: np.ndarray, longest: float, k: int, recall: float = RECALL, seed: int = 3) -> Coder:
    """Iterative quantisation: alternate signs and the rotation nearest to them."""
    rng = np.random.default_rng(seed)
    blank = Coder(np.zeros(x.shape[1] + 1), np.zeros((x.shape[1] + 1, BITS)), longest, BITS)
    up = blank.lifted(x)
    mean = up.mean(axis=0)
    _, _, axes = np.linalg.svd(up - mean, full_matrices=False)
    basis = np.zeros((x.shape[1] + 1, BITS))
    used = min(BITS, len(axes))
    basis[:, :used] = axes[:used].T
    if used < BITS:  # fewer dimensions than bits: random directions fill the code
        basis[:, used:] = rng.normal(size=(x.shape[1] + 1, BITS - used)) / np.sqrt(x.shape[1] + 1)
    projected = (up - mean) @ basis
    turn, _ = np.linalg.qr(rng.normal(size=(BITS, BITS)))
    for _ in range(ROTATIONS):
        left, _, right = np.linalg.svd(np.sign(projected @ turn).T @ projected)
        turn = (left @ right).T
    coder = Coder(mean, basis @ turn, longest, BITS)
    queries = x[: min(len(x), 512)]
    near = queries @ x.T
    near[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    best = np.argsort(-near, axis=1)[:, : min(k, max(len(x) - 1, 1))]
    codes, asked = coder.substrings(x), coder.substrings(queries, query=True)
    apart = sum(distances(asked[:, j], codes[:, j]).astype(np.int64) for j in range(SUBSTRINGS))
    radius = int(np.quantile(np.take_along_axis(apart, best, axis=1), recall, method="higher"))
    return Coder(mean, basis @ turn, longest, radius)


@cache
def masks(reach: int) -> np.ndarray:
    """All substrings with at most ``reach`` bits set."""
    every = np.arange(1 << WIDTH, dtype=np.uint32)
    return every[np.bitwise_count(every) <= reach]


class Block:
    """Substring indexes over a block of codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes

    @cached_property
    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each substring the codes in its order, and where each value begins."""
        def table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            starts = np.concatenate([[0], np.cumsum(np.bincount(keys, minlength=1 << WIDTH))])
            return np.argsort(keys.astype(np.uint16), kind="stable"), starts

        return [table(self.codes[:, j]) for j in range(SUBSTRINGS)]

    def apart(self, who: np.ndarray, what: np.ndarray) -> np.ndarray:
        """Bits in which the codes ``who`` differ from those at ``what``."""
        return np.bitwise_count(who ^ self.codes[what]).sum(axis=1)

    def probe(self, asked: np.ndarray, radius: int, most: float = math.inf) -> tuple[np.ndarray, np.ndarray] | None:
        """The pairs (asked, code) within the radius, in order, out of the
        probed buckets; None if those hold or cost more than ``most``. By the
        pigeonhole principle the first ``radius % m + 1`` indexes are probed
        to radius // m bits, the others to one bit less."""
        low, extra = divmod(radius, SUBSTRINGS)
        reaches = [low if j <= extra else low - 1 for j in range(SUBSTRINGS)]
        if len(asked) * sum(len(masks(min(r, WIDTH))) for r in reaches if r >= 0) > most:
            return None
        spans = []
        for j, reach in enumerate(reaches):
            if reach >= 0:
                keys = asked[:, j, None] ^ masks(min(reach, WIDTH))
                starts = self.tables[j][1]
                spans.append((j, starts[keys].ravel(), (starts[keys + 1] - starts[keys]).ravel(), keys.shape[1]))
        if sum(int(counts.sum()) for _, _, counts, _ in spans) > most:
            return None
        pairs = []
        for j, begins, counts, width in spans:
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            what = self.tables[j][0][np.repeat(begins, counts) + place]
            pairs.append(np.repeat(np.arange(len(counts)) // width, counts) * len(self.codes) + what)
        who, what = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.codes)))
        near = self.apart(asked[who], what) <= radius
        return who[near], what[near]

    def within(self, asked: np.ndarray, radius: int) -> np.ndarray:
        """queries x codes: which codes lie within the radius."""
        pairs = self.probe(asked, radius, len(asked) * len(self.codes) / PAYS)
        if pairs is not None:
            found = np.zeros((len(asked), len(self.codes)), dtype=bool)
            found[pairs] = True
            return found
        apart = np.zeros((len(asked), len(self.codes)), dtype=np.uint8)
        for j in range(SUBSTRINGS):
            apart += distances(asked[:, j], self.codes[:, j])
        return apart <= radius


class Ids:
    """The ids of vectors, one after the other, and how many each has."""

    def __init__(self, every: np.ndarray, counts: np.ndarray) -> None:
        self.every, self.starts = every, np.concatenate([[0], np.cumsum(counts)])
        self.firsts = every[self.starts[:-1]]

    def more(self, at: np.ndarray) -> np.ndarray:
        """The ids of vectors after the first; None if there are none."""
        out = np.full(len(at), None, dtype=object)
        for i in np.flatnonzero(self.starts[at + 1] - self.starts[at] > 1):
            out[i] = self.every[self.starts[at[i]] + 1 : self.starts[at[i] + 1]].tolist()
        return out


class Group:
    """Queries and the k + 1 best vectors that have gone past them."""

    def __init__(self, vectors: list[bytes], size: int, coder: Coder, radius: int, k: int) -> None:
        self.vectors, q = vectors, as_matrix(b"".join(vectors), len(vectors[0]) // size, size)
        self.q, self.coder, self.radius, self.k = q, coder, radius, k
        self.codes = coder.substrings(q, query=True)
        squares = (q * q).sum(axis=1)
        self.lengths = np.sqrt(squares) * math.sqrt(coder.longest)
        # squares out of the range of doubles give no unit vectors
        self.scalable = bool(np.isfinite(self.lengths).all()) and min(squares.min(), coder.longest) > 1e-280
        self.small = (q / np.sqrt(squares)[:, None]).astype(np.float32) if self.scalable else None
        # twice the rounding of products of unit vectors in single precision
        self.slack = (q.shape[1] + 16) * 2.0**-23
        self.scores = np.full((len(q), k + 1), -np.inf)
        self.firsts = np.zeros((len(q), k + 1), dtype=np.int64)
        self.more = np.full((len(q), k + 1), None, dtype=object)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.seen = 0

    def add(self, x: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Vectors wait for a full block; the first blocks are small, to find a bar for the others."""
        self.waiting.append((x, ids, counts))
        if sum(len(w[0]) for w in self.waiting) >= min(BLOCK, max(FIRST, self.seen), max(FIRST, MOST // x[0].nbytes)):
            self.empty()

    def empty(self) -> None:
        if self.waiting:
            x, ids, counts = (np.concatenate(part) for part in zip(*self.waiting, strict=True))
            self.waiting, self.seen = [], self.seen + len(x)
            self.pass_by(x, Ids(ids, counts))

    def pass_by(self, x: np.ndarray, ids: Ids) -> None:
        """Hold a block of vectors against the queries."""
        block = Block(self.coder.substrings(x))
        small = (x / math.sqrt(self.coder.longest)).astype(np.float32) if self.scalable else None
        for at in range(0, len(self.q), CHUNK):
            rows = np.arange(at, min(at + CHUNK, len(self.q)))
            pairs = block.probe(self.codes[rows], self.radius, len(rows) * len(x) / PAYS)
            if pairs is not None:
                self.keep(rows[pairs[0]], pairs[1], x, ids)
                continue
            full = (self.scores[rows, -1] > -np.inf) & self.scalable
            for few in np.array_split(rows[~full], -(-int((~full).sum()) // 64) or 1):
                if len(few):
                    self.fill(few, block, x, ids)
            rows = rows[full]
            if len(rows):
                self.pick(rows, block, small, x, ids)

    def pick(self, rows: np.ndarray, block: Block, small: np.ndarray, x: np.ndarray, ids: Ids) -> None:
        """What may be among the best of queries that have k + 1 vectors."""
        bar = (self.scores[rows, -1] / self.lengths[rows] - self.slack).astype(np.float32)[:, None]
        asked, near = self.small[rows], np.empty(len(rows) * TILE, dtype=np.float32)
        found = []
        for at in range(0, len(x), TILE):  # a tile stays in the processor's cache
            tile = small[at : at + TILE].T
            products = np.matmul(asked, tile, out=near[: len(rows) * tile.shape[1]].reshape(len(rows), -1))
            who, what = np.divmod(np.flatnonzero(products >= bar), tile.shape[1])
            found.append((who, what + at))
        who, what = (np.concatenate(part) for part in zip(*found, strict=True))
        who = rows[who]
        for at in range(0, len(who), PAIRS):
            w, v = who[at : at + PAIRS], what[at : at + PAIRS]
            inside = block.apart(self.codes[w], v) <= self.radius
            self.keep(w[inside], v[inside], x, ids)

    def fill(self, rows: np.ndarray, block: Block, x: np.ndarray, ids: Ids) -> None:
        """The best of a block for queries that have no bar yet."""
        near = np.where(block.within(self.codes[rows], self.radius), self.q[rows] @ x.T, -np.inf)
        top = np.argpartition(-near, min(self.k, near.shape[1] - 1), axis=1)[:, : self.k + 1]
        # products that rounding cannot tell apart from the last one kept
        least = np.take_along_axis(near, top, axis=1).min(axis=1)
        close = near >= (least - 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(least), least, 0))))[:, None]
        who, what = np.nonzero(close & np.isfinite(near))
        self.keep(rows[who], what, x, ids)

    def keep(self, who: np.ndarray, what: np.ndarray, x: np.ndarray, ids: Ids) -> None:
        """Score pairs in doubles; the k + 1 best of each query stay, ties to the smaller first id."""
        for at in range(0, len(who), PAIRS):
            w, v = who[at : at + PAIRS], what[at : at + PAIRS]
            exact = (self.q[w] * x[v]).sum(axis=1)
            better = exact >= self.scores[w, -1]
            w, v, exact = w[better], v[better], exact[better]
            touched = np.unique(w)
            before, place = np.nonzero(self.scores[touched] > -np.inf)
            before = touched[before]
            w = np.concatenate([before, w])
            scores = np.concatenate([self.scores[before, place], exact])
            first = np.concatenate([self.firsts[before, place], ids.firsts[v]])
            more = np.concatenate([self.more[before, place], ids.more(v)])
            order = np.lexsort((first, -scores, w))
            w = w[order]
            place = np.arange(len(w)) - np.searchsorted(w, w)
            w, order, place = w[place <= self.k], order[place <= self.k], place[place <= self.k]
            self.scores[w, place], self.firsts[w, place], self.more[w, place] = scores[order], first[order], more[order]

    def found(self) -> pa.RecordBatch:
        """A row for each query, those without a vector too."""
        self.empty()
        who, place = np.nonzero(self.scores > -np.inf)
        lists = [[first, *(more or ())] for first, more in zip(self.firsts[who, place].tolist(), self.more[who, place], strict=True)]
        sizes = np.array([len(i) for i in lists], dtype=np.int64)
        every = np.array([i for some in lists for i in some], dtype=np.int64)
        entries = pa.StructArray.from_arrays(
            [pa.array(-self.scores[who, place], pa.float64()), pa.array(self.firsts[who, place], pa.int64()), as_lists(every, sizes)],
            names=["s", "first", "ids"])
        return pa.record_batch({"query": pa.array(self.vectors, pa.binary()), "best": as_lists(entries, np.bincount(who, minlength=len(self.q)))})


def as_lists(values, sizes: np.ndarray) -> pa.ListArray:
    """Values cut into lists of these sizes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, pa.int64()))


def as_bytes(x: np.ndarray) -> list[bytes]:
    """The rows of x, equal ones as equal bytes: in single precision where that
    holds them exactly, else in doubles."""
    x = x + x.dtype.type(0)
    with np.errstate(over="ignore"):
        small = np.ascontiguousarray(x, dtype=np.float32)
    out = [row.tobytes() for row in small]
    for at in np.flatnonzero(~(small == x).all(axis=1)):
        out[at] = x[at].tobytes()
    return out


def as_matrix(vectors: bytes, dim: int, size: int) -> np.ndarray:
    """Doubles of vectors whose components have ``size`` bytes."""
    return np.frombuffer(vectors, dtype=f"f{size}").astype(np.float64).reshape(-1, dim)


def matrices(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of lists and their values, those of a length at a time; not the empty ones."""
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for dim in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == dim)
        yield at, values[offsets[at][:, None] + np.arange(dim)]


def with_values(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows with an id and a vector without null components."""
    kind = "array<float>" if rows.schema[vec_col].dataType in (ArrayType(FloatType(), True), ArrayType(FloatType(), False)) else "array<double>"
    whole = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("v"))
    return whole.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull()))


def usable(rows: DataFrame, id_col: str, vec_col: str, most_ids: int) -> DataFrame:
    """(vec, dim, ids): distinct usable vectors as bytes with their
    ``most_ids`` smallest ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column("id").to_numpy(), {}
            for at, x in matrices(batch.column("v")):
                good = np.isfinite(x).all(axis=1) & x.any(axis=1)
                for key, vec in zip(ids[at[good]].tolist(), as_bytes(x[good]), strict=True):
                    found.setdefault((vec, x.shape[1]), set()).add(key)
            # a vector with very many copies is cut down here first
            lists = [sorted(keys)[:most_ids] for keys in found.values()]
            yield pa.record_batch({
                "vec": pa.array([v for v, _ in found], pa.binary()), "dim": pa.array([d for _, d in found], pa.int32()),
                "ids": pa.array(lists, pa.list_(pa.int64()))})

    packed = with_values(rows, id_col, vec_col).mapInArrow(pack, "vec binary, dim int, ids array<long>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most_ids)
    return packed.groupBy("vec", "dim").agg(ids.alias("ids"))


def pieces(vectors: DataFrame) -> DataFrame:
    """(dim, size, n, longest, vecs, ids, counts): vectors of one dimension and
    component size in rows of at most ``PIECE`` bytes; ids one after the other,
    with how many each vector has."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            sizes = pc.binary_length(batch.column("vec")).to_numpy() // dims
            for dim, size in {*zip(dims.tolist(), sizes.tolist(), strict=True)}:
                same = np.flatnonzero((dims == dim) & (sizes == size))
                most = max(1, PIECE // (dim * size))
                for at in range(0, len(same), most):
                    part = batch.take(pa.array(same[at : at + most]))
                    vecs, lists = b"".join(part.column("vec").to_pylist()), part.column("ids")
                    x = as_matrix(vecs, dim, size)
                    counts = np.diff(lists.offsets.to_numpy()).astype(np.int32)
                    yield pa.record_batch({
                        "dim": pa.array([dim], pa.int32()), "size": pa.array([size], pa.int32()), "n": pa.array([len(x)], pa.int64()),
                        "longest": pa.array([(x * x).sum(axis=1).max()]), "vecs": pa.array([vecs], pa.binary()),
                        "ids": pa.array([lists.flatten().to_numpy().astype(np.int64).tobytes()], pa.binary()),
                        "counts": pa.array([counts.tobytes()], pa.binary())})

    return vectors.mapInArrow(cut, "dim int, size int, n long, longest double, vecs binary, ids binary, counts binary")


def learned(index: DataFrame, dim: int, n: int, longest: float, k: int, sample: int, recall: float) -> Coder:
    """The coder of a sample that does not depend on how the vectors lie."""

    def doubles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = as_matrix(batch.column("vecs")[row].as_buffer(), dim, batch.column("size")[row].as_py())
                yield pa.record_batch({"vec": pa.array([v.tobytes() for v in x], pa.binary())})

    every = index.select("size", "vecs").mapInArrow(doubles, "vec binary").withColumn("h", F.xxhash64("vec", F.lit("sample")))
    # few more than are drawn, so that no task sends a whole sample
    low = every.filter(F.col("h") < -(1 << 63) + (4 * sample << 64) // n) if 4 * sample < n else every
    drawn = low.orderBy("h").limit(sample).toPandas()
    if len(drawn) < min(sample, n):
        drawn = every.orderBy("h").limit(sample).toPandas()
    return learn(np.stack([np.frombuffer(v, dtype=np.float64) for v in drawn["vec"]]), longest, k, recall)


def groups(asked: DataFrame, dim: int, number: int, most: int) -> DataFrame:
    """(qsize, queries): about ``number`` rows of at most ``most`` query vectors, dealt out evenly."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("vec")).to_numpy() // dim
            for size in np.unique(sizes):
                same = np.flatnonzero(sizes == size)
                for at in np.array_split(same, -(-len(same) // most)):
                    vecs = b"".join(batch.column("vec").take(pa.array(at)).to_pylist())
                    yield pa.record_batch({"qsize": pa.array([size], pa.int32()), "queries": pa.array([vecs], pa.binary())})

    # a task that makes several deals them out in turn
    return asked.coalesce(max(1, number // 16)).mapInArrow(pack, "qsize int, queries binary").repartition(number)


def search(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """The k nearest rows of each query by inner product, the query's own id
    excepted: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    index = cut_lineage(pieces(usable(rows, id_col, vec_col, k + 1)), "vectors", options=PIECES_TABLE)
    dims = index.groupBy("dim").agg(F.sum("n").alias("n"), F.max("longest").alias("longest")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n, longest = dims[0]
    index = index.filter(F.col("dim") == dim).select("size", "vecs", "ids", "counts")
    shared = spark.sparkContext.broadcast(learned(index, dim, n, longest, k, sample, recall))
    asked = usable(queries, id_col, vec_col, 1).filter(F.col("dim") == dim).select("vec")
    asked = cut_lineage(asked, "query-vectors")
    parts = index.rdd.getNumPartitions()

    def probe(asked: DataFrame, radius: int) -> DataFrame:
        """(query, best): the k + 1 best vectors inside the radius and their ids."""

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[bytes, Group] = {}
            for batch in batches:
                for row in batch.to_struct_array():
                    size, width = row["qsize"].as_py(), row["qsize"].as_py() * dim
                    vecs = memoryview(row["queries"].as_buffer())
                    first = bytes(vecs[:width])  # no other group has this vector
                    if first not in held:
                        held[first] = Group([bytes(vecs[i : i + width]) for i in range(0, len(vecs), width)], size, shared.value, radius, k)
                    ids, counts = (np.frombuffer(row[c].as_buffer(), dtype=t).copy() for c, t in (("ids", np.int64), ("counts", np.int32)))
                    held[first].add(as_matrix(row["vecs"].as_buffer(), dim, row["size"].as_py()), ids, counts)
            yield from (group.found() for group in held.values())

        number = asked.count()
        shares = min(parts, max(SHARES, n // max(1, number * (k + 1))))
        most = max(1, min(QUERIES[1], GROUP // (4 * dim)))
        tasks = -(-2 * spark.sparkContext.defaultParallelism // shares)
        dealt = max(1, -(-number // most), min(-(-number // QUERIES[0]), tasks))
        asked_groups = groups(asked, dim, dealt, -(-number // dealt) or 1)
        hits = index.coalesce(shares).hint("shuffle_replicate_nl").crossJoin(asked_groups).mapInArrow(
            visit, "query binary, best array<struct<s: double, first: long, ids: array<long>>>")
        best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k + 1)
        with small_batches(spark):
            return cut_lineage(hits.groupBy("query").agg(best.alias("best")), "neighbours")

    radius, enough = shared.value.radius, F.size("best") >= min(k + 1, n)
    lists = probe(asked, radius)
    while radius < BITS:
        asked = lists.filter(~enough).select(F.col("query").alias("vec"))
        if asked.isEmpty():
            break
        radius = min(BITS, 2 * radius + SUBSTRINGS)
        lists = lists.filter(enough).union(probe(asked, radius))
    # the k + 1 best vectors hold the k best rows, whatever the query's own id
    entries = F.flatten(F.transform("best", lambda v: F.transform(v["ids"], lambda i: F.struct(v["s"].alias("s"), i.alias("id")))))
    found = lists.select("query", F.slice(F.array_sort(entries), 1, (k + 1) * (k + 1)).alias("found"))
    return _ranked(with_values(queries, id_col, vec_col), found, dim, k)


def _ranked(members: DataFrame, lists: DataFrame, dim: int, k: int) -> DataFrame:
    """Give every query row the list of its vector, without its own id."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in matrices(batch.column("v")):
                if x.shape[1] == dim:
                    yield pa.record_batch({"query_id": batch.column("id").take(pa.array(at)), "query": pa.array(as_bytes(x), pa.binary())})

    keyed = members.mapInArrow(key, "query_id long, query binary").distinct()
    others = F.slice(F.filter("found", lambda e: e["id"] != F.col("query_id")), 1, k)
    out = keyed.join(lists, "query").select("query_id", F.posexplode(others).alias("pos", "e"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), (-F.col("e.s")).alias("score"))
