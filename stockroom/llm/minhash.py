"""Near-duplicate documents by MinHash, banding and exact confirmation.

A document is the set of its distinct word shingles (64-bit hashes).

1. One pass over the texts gives every document its set's size and key and
   a signature: the minima of ``BANDS * ROWS`` universal hash functions.
   Documents with equal sets become one node.
2. Banding: ``ROWS`` minima make a band; nodes with an equal band meet in its
   bucket. A pair at the limit of 0.8 misses all 32 bands of 4 minima with a
   probability of 5e-8.
3. Rounds of stars: in each bucket every node is a candidate with one pivot
   only, another pivot in each round. Candidates whose signatures agree in
   too few places go (a pair at the limit fails this with a probability of
   about 1e-8), first by two bits of each minimum, inside the join, then by
   the whole minima; the rest is confirmed on the full sets. Confirmed links
   are joined to components by large-star and small-star.
4. Buckets that then still hold several components are finished exactly:
   every node outside the bucket's largest component meets the nodes of
   other components. Pairs within one component are never made: they change
   nothing. What meets is compared inside the join, in the bucket of its first
   common band only: by two bits of each minimum, by one bit of ``FINE`` more
   minima, computed for the nodes that are left, and by the full sets of the
   nodes that have partners up to here. The first two joins only tell which
   nodes these are. A node linked with the largest component makes one row,
   however many of its nodes it is linked with; the other rows are links
   between smaller components. So many texts that share a passage, or near
   copies just short of the limit, make no rows but their own; the
   comparisons inside the joins still grow with the square of a bucket.

A bucket of copies costs its length a round, and no link between different
components is lost to a cap.

Defined results
    null and blank texts have empty sets and are linked with nothing; fewer
    words than a shingle are one shingle; rows with equal ids are documents
    of their own with one component; a null id counts as the largest; an
    empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.bitmaps import bitmap, holds
from stockroom.llm.bytehash import ByteHasher, mixed
from stockroom.llm.stars import components
from stockroom.llm.tokens import shingle_sets, slices
from stockroom.session import cut_lineage, lineage_scope

SHINGLE = 4
PERCENT = 80  # link when 100 * intersection >= PERCENT * union
BANDS, ROWS = 32, 4
SLACK = 5.6  # standard deviations that a signature may fall short
STARS = 2
FINE = 4096  # minima of which one bit is compared before all pairs of a bucket are confirmed
STEP = 1 << 17  # hashes computed at once
PLANES = ["p0", "p1", "p2", "p3"]  # two bits of each minimum


def hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of ``count`` universal hash functions
    h(x) = (a x + b mod 2**64) >> 32, the same in every run."""
    numbers = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:count] | np.uint64(1), numbers[count:]


def signature(tokens: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minima of all functions over a set, 32 bits each."""
    times, plus = family[0][:, None], family[1][:, None]
    least = np.full(len(times), np.uint64(2**64 - 1))
    step = STEP // len(times)
    for at in range(0, len(tokens), step):
        np.minimum(least, (times * tokens[None, at : at + step] + plus).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def set_key(tokens: np.ndarray) -> int:
    """64-bit hash of a set."""
    return int(np.add.reduce(mixed(tokens ^ np.uint64(0xA0761D6478BD642F))).astype(np.int64)) if len(tokens) else 0


def planes(minima: np.ndarray) -> list[np.ndarray]:
    """The lowest two bits of all minima of each signature, as longs: bit 0 of
    the first and of the second half, then bit 1 of both."""
    packed = [np.packbits((minima >> np.uint32(k)) & np.uint32(1) == 1, axis=1).view(np.int64) for k in (0, 1)]
    return [bits[:, half] for bits in packed for half in (0, 1)]


def scan(docs: DataFrame, size: int) -> DataFrame:
    """(id, body, n, node, minima) of every document; body: the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, family = ByteHasher(), hash_family(BANDS * ROWS)
        for batch in batches:
            for part in slices(batch, 256):
                sizes, keys, minima = [], [], []
                for tokens in shingle_sets(part.column("text"), size, hasher):
                    sizes.append(len(tokens))
                    keys.append(set_key(tokens))
                    minima.append(signature(tokens, family).tobytes())
                columns = [part.column("id"), part.column("body"), pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()), pa.array(minima, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "body", "n", "node", "minima"])

    return docs.mapInArrow(run, "id long, body long, n int, node long, minima binary")


def bands(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n): the band hashes of every node's signature. ``nodes``
    may hold a node several times; a batch gives it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            batch = batch.take(pa.array(np.unique(batch.column("node").to_numpy(), return_index=True)[1]))
            minima = _matrix(batch.column("minima")).reshape(batch.num_rows, BANDS, ROWS).astype(np.uint64)
            bucket = np.broadcast_to(salt, minima.shape[:2])
            for k in range(ROWS):
                bucket = mixed(bucket * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, k])
            columns = [pa.array(bucket.ravel().view(np.int64)), *(pa.array(np.repeat(batch.column(c).to_numpy(), BANDS)) for c in ("node", "n"))]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "node", "n"])

    return nodes.select("node", "n", "minima").mapInArrow(run, "bucket long, node long, n int")


def shared_bands(nodes: DataFrame) -> DataFrame:
    """The rows of ``bands`` whose bucket two nodes or more hold, each once: a
    bucket's rows are counted where they meet, in one shuffle."""
    whole, by_node = Window.partitionBy("bucket"), Window.partitionBy("bucket").orderBy("node")
    marked = bands(nodes).withColumns({"before": F.lag("node").over(by_node), "lo": F.min("node").over(whole), "hi": F.max("node").over(whole)})
    return marked.filter((F.col("lo") != F.col("hi")) & ~F.col("before").eqNullSafe(F.col("node"))).select("bucket", "node", "n")


def signatures(scanned: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, minima) of the wanted nodes, and of a few others that pass the
    bitmap of them, each node once."""
    shared = scanned.sparkSession.sparkContext.broadcast(bitmap(wanted, F.col("node")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(holds(shared.value, batch.column("node").to_numpy().view(np.uint64))))

    rows = scanned.filter("n > 0").select("node", "n", "minima").mapInArrow(run, "node long, n int, minima binary")
    return rows.groupBy("node").agg(F.first("n").alias("n"), F.first("minima").alias("minima"))


def with_planes(nodes: DataFrame) -> DataFrame:
    """(node, p0, p1, p2, p3): the bits that the joins compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits = planes(_matrix(batch.column("minima")))
                yield pa.RecordBatch.from_arrays([batch.column("node"), *(pa.array(np.ascontiguousarray(x)) for x in bits)], names=["node", *PLANES])

    return nodes.select("node", "minima").mapInArrow(run, "node long, " + ", ".join(f"{p} long" for p in PLANES))


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures of a binary column, a row each."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, BANDS * ROWS)


def agreeing(pairs: DataFrame, percent: int) -> DataFrame:
    """The rows whose signatures ``ma`` and ``mb`` agree often enough for a pair at the limit."""
    least = _least_agreeing(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2048):
                same = (_matrix(part.column("ma")) == _matrix(part.column("mb"))).sum(axis=1) >= least
                yield part.select(["a", "b"]).filter(pa.array(same))

    return pairs.mapInArrow(run, "a long, b long")


class Confirmer:
    """Tells which candidate pairs are links: by signature, then by the sets,
    which are read from the texts of the nodes concerned only."""

    def __init__(self, texts: DataFrame, scanned: DataFrame, nodes: DataFrame, size: int, percent: int) -> None:
        self.texts, self.nodes, self.size, self.percent = texts, nodes, size, percent
        one = F.min(F.struct("id", "body")).alias("one")
        chosen = scanned.filter("n > 0").groupBy("node").agg(one).select("node", F.col("one.id").alias("one_id"), F.col("one.body").alias("one_body"))
        self.chosen = cut_lineage(chosen, "minhash-chosen")

    def read(self, wanted: DataFrame, longs: Callable[[np.ndarray], np.ndarray], name: str) -> DataFrame:
        """(node, ``name``) of the wanted nodes, and of a few others: an array of
        longs made from the set, which is read from one text of the node. The
        texts are picked by a bitmap of their hashes and ids, without a shuffle
        of texts; each node comes once."""
        size = self.size
        chosen = self.chosen.join(wanted, "node", "left_semi")
        shared = self.texts.sparkSession.sparkContext.broadcast(bitmap(chosen, F.xxhash64("one_id", "one_body")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher = ByteHasher()
            for batch in batches:
                picked = batch.filter(pa.array(holds(shared.value, batch.column("mark").to_numpy().view(np.uint64))))
                for part in slices(picked, 256):
                    sets = {set_key(tokens): tokens for tokens in shingle_sets(part.column("text"), size, hasher)}
                    found = [longs(tokens) for tokens in sets.values()]
                    bounds = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(found).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), lists], names=["node", name])

        marked = self.texts.select(F.xxhash64("id", "body").alias("mark"), "text")
        found = cut_lineage(marked.mapInArrow(run, f"node long, {name} array<long>"), f"minhash-{name}")
        return found.groupBy("node").agg(F.first(name).alias(name))

    def fine_bits(self, wanted: DataFrame) -> DataFrame:
        """(node, fine): one bit of each of ``FINE`` minima."""

        def bits(tokens: np.ndarray) -> np.ndarray:
            return np.packbits(signature(tokens, hash_family(FINE)) & np.uint32(1) == 1).view(np.int64)

        return self.read(wanted, bits, "fine")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) -> those that are links."""
        with lineage_scope(pairs.sparkSession):
            return cut_lineage(self._linked(pairs), "minhash-links", outlives=True)

    def _linked(self, pairs: DataFrame) -> DataFrame:
        left = self.nodes.select(F.col("node").alias("a"), F.col("minima").alias("ma"))
        right = self.nodes.select(F.col("node").alias("b"), F.col("minima").alias("mb"))
        likely = cut_lineage(agreeing(pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb"), self.percent), "minhash-likely")
        if likely.isEmpty():
            return likely
        sets = self.read(likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct(), lambda tokens: tokens, "tokens")
        left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
        right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
        counted = likely.join(right, "b").join(left, "a").select(
            "a", "b", F.size(F.array_intersect("ta", "tb")).alias("common"), (F.size("ta") + F.size("tb")).alias("sizes"))
        return counted.filter(_enough_common(F.col("common"), F.col("sizes"), self.percent)).select("a", "b")


def _enough_common(common: Column, sizes: Column, percent: int) -> Column:
    """Sets with ``common`` tokens in both and ``sizes`` in sum are a link."""
    return common.cast("long") * 100 >= (sizes.cast("long") - common) * percent


def _least_agreeing(share: float, total: int = BANDS * ROWS) -> int:
    """Places, of all, in which signatures agree at least if each agrees with
    a probability of ``share``."""
    return int(np.floor(total * share - SLACK * np.sqrt(total * share * (1 - share))))


def _agreeing_bits() -> Column:
    """Minima whose two bits agree in p0.. and q0.."""
    return F.expr(f"{BANDS * ROWS} - bit_count((p0 ^ q0) | (p2 ^ q2)) - bit_count((p1 ^ q1) | (p3 ^ q3))")


def _like_sizes(percent: int) -> Column:
    small, large = F.least("n", "m").cast("long"), F.greatest("n", "m").cast("long")
    return small * 100 >= large * percent


def _likely(percent: int) -> Column:
    """Sizes (n, m) and bits (p0.., q0..) that a pair at the limit may have:
    two bits agree if the minima do, and else in one of four cases."""
    share = percent / 100
    return _like_sizes(percent) & (_agreeing_bits() >= _least_agreeing(share + (1 - share) / 4))


def _very_likely(percent: int) -> Column:
    """The same of the bits of ``FINE`` minima, one of each, in fp and fq."""
    share = (1 + percent / 100) / 2
    differ = F.aggregate(F.zip_with("fp", "fq", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n)
    return F.lit(FINE) - differ >= _least_agreeing(share, FINE)


def star_pairs(open_rows: DataFrame, star: int, percent: int) -> DataFrame:
    """(a, b): every node of a bucket with the bucket's pivot of this round,
    if it is of another component. The order of nodes is the same in all
    buckets, so buckets of like nodes share pivots."""
    own = (F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("label").alias("its"), *(F.col(p).alias(p.replace("p", "q")) for p in PLANES))
    order = F.struct(F.xxhash64("node", F.lit(star)).alias("h"), *own)
    pivots = cut_lineage(open_rows.groupBy("bucket").agg(F.min(order).alias("top")).select("bucket", "top.*").drop("h"), "minhash-pivots")
    drawn = open_rows.join(pivots, (open_rows["bucket"] == pivots["bucket"]) & (F.col("label") != F.col("its")) & _likely(percent))
    return drawn.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def rest_links(open_rows: DataFrame, links: DataFrame, confirmer: Confirmer) -> DataFrame:
    """(a, b): links by which the components that meet in the open buckets are
    joined as by all their links. Which nodes have a very likely partner is
    found first; only they get their sets, which are compared inside the joins.
    A node outside its bucket's largest component ``main`` comes out once if it
    is linked with any node of that, as a link with its label; then the links
    between the others come out whose components still differ."""
    percent = confirmer.percent
    marked = cut_lineage(open_rows.join(_largest(open_rows), "bucket"), "minhash-marked")
    left = cut_lineage(marked.select("node").distinct(), "minhash-left")
    # a bucket in which nodes of different components meet is open
    keys = marked.groupBy("node").agg(F.collect_set("bucket").alias("keys"))
    known = marked.join(cut_lineage(confirmer.fine_bits(left).join(keys, "node"), "minhash-fine"), "node")
    x = known.filter("label <> main").select(
        "bucket", F.col("node").alias("x"), "n", F.col("label").alias("lx"), "main", F.col("fine").alias("fp"), F.col("keys").alias("kx"), *PLANES)
    y = known.select(
        F.col("bucket").alias("its"), F.col("node").alias("y"), F.col("n").alias("m"), F.col("label").alias("ly"), (F.col("label") == F.col("main")).alias("inside"),
        F.col("fine").alias("fq"), F.col("keys").alias("ky"), *(F.col(p).alias(p.replace("p", "q")) for p in PLANES))
    near = cut_lineage(x.join(y, _meet(percent), "left_semi"), "minhash-near")
    if near.isEmpty():
        return links.limit(0)
    partners = cut_lineage(y.join(near, _meet(percent), "left_semi"), "minhash-partners")
    wanted = near.select(F.col("x").alias("node")).union(partners.select("y")).distinct()
    sets = confirmer.read(wanted, lambda tokens: tokens, "tokens")
    near = near.join(sets.select(F.col("node").alias("x"), F.col("tokens").alias("ta")), "x")
    partners = partners.join(sets.select(F.col("node").alias("y"), F.col("tokens").alias("tb")), "y")
    linked = _meet(percent) & _enough_common(F.size(F.array_intersect("ta", "tb")), F.size("ta") + F.size("tb"), percent)

    to_main = near.join(partners.filter("inside"), linked, "left_semi")
    to_main = cut_lineage(to_main.select(F.least("x", "main").alias("a"), F.greatest("x", "main").alias("b")).distinct(), "minhash-to-main")
    labels = components(links.union(to_main))
    near = near.join(labels.select(F.col("node").alias("x"), "label"), "x", "left").withColumn("lx", F.coalesce("label", "x")).drop("label")
    others = partners.filter("not inside").join(labels.select(F.col("node").alias("y"), "label"), "y", "left").withColumn("ly", F.coalesce("label", "y")).drop("label")
    between = cut_lineage(near.join(others, linked).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "minhash-between")
    return to_main.union(between)


def _largest(open_rows: DataFrame) -> DataFrame:
    """(bucket, main): the largest component of each bucket that holds several."""
    sizes = open_rows.groupBy("bucket", "label").agg(F.count("*").alias("held"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("held", "label")).alias("top"), F.count("*").alias("labels"))
    return cut_lineage(largest.filter("labels > 1").select("bucket", F.col("top.label").alias("main")), "minhash-largest")


def _meet(percent: int) -> Column:
    """Rows x and y of a bucket that are a very likely pair of different
    components. A pair counts in one order and in its first common bucket only."""
    once = F.col("inside") | (F.col("x") < F.col("y"))
    here = F.col("bucket") == F.array_min(F.array_intersect("kx", "ky"))
    return (F.col("bucket") == F.col("its")) & (F.col("lx") != F.col("ly")) & once & _likely(percent) & here & _very_likely(percent)


def open_buckets(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows (bucket, node, n, bits, label) of buckets that hold several components."""
    labels = components(links)
    rows = rows.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = cut_lineage(rows, "minhash-labelled")
    several = rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("bucket")
    return cut_lineage(rows.join(cut_lineage(several, "minhash-several"), "bucket"), "minhash-open")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    id reachable by links), kept (it is that document). Tables that the result
    does not read go before it is returned."""
    with lineage_scope(docs.sparkSession):
        members, named = _named_nodes(docs, doc_id, text, size, percent)
        named = cut_lineage(named, "minhash-named", outlives=True)
        members = cut_lineage(members, "minhash-members", outlives=True)
    filled = members.filter("n > 0").join(named, "node").select("id", "n", "component_id")
    blank = members.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return filled.union(blank).select(
        F.col("id").alias(doc_id), F.col("n").cast("long").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _named_nodes(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, n, node) of every document and (node, component_id) of every set."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("body"), F.col(text).alias("text"))
    scanned = cut_lineage(scan(texts, size), "minhash-scan")
    members = scanned.select("id", "body", "n", "node")
    rows = cut_lineage(shared_bands(scanned.filter("n > 0")), "minhash-shared-rows")
    nodes = cut_lineage(signatures(scanned, rows.select("node").distinct()), "minhash-nodes")
    confirmer = Confirmer(texts, members, nodes, size, percent)
    rows = cut_lineage(rows.join(with_planes(nodes), "node").withColumn("label", F.col("node")), "minhash-buckets")

    links = tested = spark.createDataFrame([], "a long, b long")
    for star in range(STARS):
        pairs = cut_lineage(star_pairs(rows, star, percent).join(tested, ["a", "b"], "left_anti"), "minhash-pairs")
        if pairs.isEmpty():
            continue
        found = confirmer.links(pairs)
        tested, links = tested.union(pairs), links.union(found)
        if not found.isEmpty():
            rows = open_buckets(rows, links)
            if rows.isEmpty():
                break
    if not rows.isEmpty():
        links = links.union(rest_links(rows, links, confirmer))

    labels = components(links)
    least = members.filter("n > 0").groupBy("node").agg(F.min("id").alias("least")).join(labels, "node", "left")
    least = cut_lineage(least.withColumn("label", F.coalesce("label", "node")), "minhash-least")
    smallest = cut_lineage(least.groupBy("label").agg(F.min("least").alias("component_id")), "minhash-smallest")
    return members.select("id", "n", "node"), least.join(smallest, "label").select("node", "component_id")
