"""Exact Jaccard self-join on word 5-grams with several global token orders.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two
sets that overlap enough share a token among the first quarter of either set
in *any* global order of tokens, so a pair must pass that test under every
order. Here all orders put rare tokens first (by classes of a frequency
sketch over all documents) and break ties by a different hash each.

1. One pass reads the texts: set size and set hash of every document, and
   a count sketch of all shingles (``2 ** SKETCH_BITS`` counters, whatever
   the input). Documents with equal sets become one node.
2. A second pass emits the prefix tokens of the first order. Only tokens
   held by two nodes or more are written, as posting lists; lists of the
   same nodes count as one from here on.
3. Star rounds: in each posting list every member is paired with a few
   others, not with all: first with a pivot of like size (in a list of two:
   with the other member), then with its neighbours in an order by a
   min-hash of the sets. The members of a large group of near copies meet
   in a few components.
4. What is left is exact: within each posting list all pairs of members of
   different components, less the pairs already compared. Pairs within a
   component need no comparison: they change no component.

A pair is compared only if it passes the prefix test under every order. The
test counts: sets that overlap enough share ``k`` tokens of the prefixes,
where k grows with the least overlap that the two sizes ask for.

No link between components is lost, and a posting list of copies costs its
length, not its square.

Defined results
    null and blank texts have empty sets and are linked with nothing; texts
    of fewer than five words are one shingle; repeated and null ids are
    allowed: every row is a member of its set's node and a null id counts
    as the largest; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.bitmaps import bitmap, holds
from stockroom.llm.bytehash import ByteHasher, mixed
from stockroom.llm.components import components
from stockroom.llm.tokens import shingle_sets, slices
from stockroom.session import cut_lineage, lineage_scope

SHINGLE = 5
PERCENT = 75  # link when 100 * intersection >= PERCENT * union
SKETCH_BITS = 22
SLICE = 1 << 17
ORDERS = 3
ROUNDS = (0, 8, 40)  # 0: a pivot; else that many neighbours
CLASS_SHIFT = np.uint64(58)


def set_key(tokens: np.ndarray) -> int:
    """64-bit hash of a set."""
    total = np.add.reduce(mixed(tokens * np.uint64(0xD6E8FEB86659FD93) + np.uint64(len(tokens))))
    return int(total.astype(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def order_keys(tokens: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """Position of each token in a global order: frequency class, then hash."""
    bits = int(classes.size).bit_length() - 1
    rank = classes[(tokens >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64)
    return (rank << CLASS_SHIFT) | (mixed(tokens + np.uint64(order + 1)) >> np.uint64(6))


def prefix(tokens: np.ndarray, classes: np.ndarray, order: int, percent: int) -> np.ndarray:
    keep = prefix_length(len(tokens), percent)
    if keep >= len(tokens):
        return tokens
    return tokens[np.argpartition(order_keys(tokens, classes, order), keep - 1)[:keep]]


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """Rows (id, body, n, node) of the documents (body: the text's hash) and
    (slice, counts, more) of the sketch: a byte for each counter of a slice,
    and (counter, rest) of those that a byte does not hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = ByteHasher(), np.zeros(1 << SKETCH_BITS, dtype=np.int32)
        for batch in batches:
            for part in slices(batch):
                sizes, keys = [], []
                for tokens in shingle_sets(part.column("text"), size, hasher):
                    np.add.at(counts, (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                    sizes.append(len(tokens))
                    keys.append(set_key(tokens) if len(tokens) else 0)
                yield scan_rows(part.num_rows, id=part.column("id"), body=part.column("body"), n=pa.array(sizes, pa.int32()), node=pa.array(keys, pa.int64()))
        for k, part in enumerate(counts.reshape(-1, SLICE)):
            if part.any():
                low = np.minimum(part, 255).astype(np.uint8)
                at = np.flatnonzero(part > 255).astype(np.int32)
                more = np.stack([at, part[at] - 255]).tobytes()
                yield scan_rows(1, slice=pa.array([k], pa.int32()), counts=pa.array([low.tobytes()], pa.binary()), more=pa.array([more], pa.binary()))

    def scan_rows(rows: int, **given: pa.Array) -> pa.RecordBatch:
        kinds = {"id": pa.int64(), "body": pa.int64(), "n": pa.int32(), "node": pa.int64(), "slice": pa.int32(), "counts": pa.binary(), "more": pa.binary()}
        return pa.RecordBatch.from_arrays([given.get(c, pa.nulls(rows, kind)) for c, kind in kinds.items()], names=list(kinds))

    return docs.mapInArrow(run, "id long, body long, n int, node long, slice int, counts binary, more binary")


def _sketch_classes(rows: DataFrame, total: int) -> np.ndarray:
    """Frequency class of every counter: 0 up to twice the mean count, then
    one more for each doubling. Each slice is added up by one task that
    streams its rows and sends a byte for each counter to the driver.
    ``total``: the sum of all counters."""
    mean = max(1.0, total / (1 << SKETCH_BITS))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, low, more in zip(*(batch.column(c) for c in ("slice", "counts", "more")), strict=True):
                total = sums.setdefault(k.as_py(), np.zeros(SLICE, dtype=np.int64))
                total += np.frombuffer(low.as_buffer(), dtype=np.uint8)
                at, rest = np.frombuffer(more.as_buffer(), dtype=np.int32).reshape(2, -1)
                total[at] += rest
        found = [np.floor(np.log2(np.maximum(x / (2 * mean), 0.5)) + 1).clip(0, 60).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(found, pa.binary())], names=["slice", "classes"])

    parts = (1 << SKETCH_BITS) // SLICE
    classes = np.zeros((parts, SLICE), dtype=np.uint8)
    for row in rows.repartition(parts, "slice").mapInArrow(add, "slice int, classes binary").collect():
        classes[row["slice"]] = np.frombuffer(row["classes"], dtype=np.uint8)
    return classes.ravel()


def _postings(docs: DataFrame, classes: np.ndarray, size: int, percent: int) -> DataFrame:
    """(token, node, n): the first order's prefix tokens that two nodes or more hold."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHasher()
        for part in (part for batch in batches for part in slices(batch)):
            seen: set[int] = set()
            tokens, nodes, sizes = [], [], []
            for found in shingle_sets(part.column("text"), size, hasher):
                key = set_key(found) if len(found) else 0
                if len(found) == 0 or key in seen:
                    continue
                seen.add(key)
                first = prefix(found, shared.value, 0, percent)
                tokens.append(first)
                nodes.append(np.full(len(first), key, dtype=np.int64))
                sizes.append(np.full(len(first), len(found), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes))],
                    names=["token", "node", "n"],
                )

    postings = docs.select("text").mapInArrow(run, "token long, node long, n int")
    # one shuffle: a token's rows are counted where they meet and singles go
    whole, by_node = Window.partitionBy("token"), Window.partitionBy("token").orderBy("node")
    marked = postings.withColumns({"before": F.lag("node").over(by_node), "lo": F.min("node").over(whole), "hi": F.max("node").over(whole)})
    shared_tokens = marked.filter((F.col("lo") != F.col("hi")) & ~F.col("before").eqNullSafe(F.col("node")))
    return shared_tokens.select("token", "node", "n")


def _sets(docs: DataFrame, marks: np.ndarray, classes: np.ndarray, size: int, percent: int) -> DataFrame:
    """(node, tokens, p1, c1, p2, c2, ...) of the documents whose ``mark`` may be
    in the bitmap ``marks``: the set and its prefixes under the other orders.
    Prefixes are cut to 32 bits; c1, c2, ... are the tokens of each that fall
    together with another one of it. A node may come several times."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    picked = docs.sparkSession.sparkContext.broadcast(marks)
    others = range(1, ORDERS)

    def short(tokens: np.ndarray) -> tuple[np.ndarray, int]:
        cut = (tokens >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return cut, len(cut) - len(np.unique(cut))

    def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(arrays), kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ByteHasher()
        chosen = (batch.filter(pa.array(holds(picked.value, batch.column("mark").to_numpy().view(np.uint64)))) for batch in batches)
        for part in (part for batch in chosen for part in slices(batch, 256)):
            by_key = {set_key(x): x for x in shingle_sets(part.column("text"), size, hasher)}
            found = list(by_key.values())
            columns = [pa.array(list(by_key), pa.int64()), lists([x.view(np.int64) for x in found], pa.int64())]
            for k in others:
                cuts = [short(prefix(x, shared.value, k, percent)) for x in found]
                columns += [lists([c for c, _ in cuts], pa.int32()), pa.array([together for _, together in cuts], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "tokens", *(f"{c}{k}" for k in others for c in "pc")])

    schema = "node long, tokens array<long>, " + ", ".join(f"p{k} array<int>, c{k} int" for k in others)
    return docs.select(F.xxhash64("id", "body").alias("mark"), "text").mapInArrow(run, schema)


def _like_sizes(a: str, b: str, percent: int) -> Column:
    small, large = F.least(a, b).cast("long"), F.greatest(a, b).cast("long")
    return small * 100 >= large * percent


def _least_shared(n: Column, m: Column, percent: int) -> Column:
    """Prefix tokens that sets of sizes n and m share under any order if they
    overlap enough to be linked."""
    overlap = F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))
    return 1 + overlap - F.ceil(F.lit(percent) * F.greatest(n, m) / F.lit(100))


class _Comparer:
    """Compares pairs of nodes; reads the sets of those that the first
    order's test leaves."""

    def __init__(self, texts: DataFrame, members: DataFrame, lists: DataFrame, classes: np.ndarray, size: int, percent: int) -> None:
        self.texts, self.members, self.classes, self.size, self.percent = texts, members, classes, size, percent
        held = lists.groupBy("node").agg(F.collect_list("token").alias("held"), F.first("n").alias("n"))
        self.held = cut_lineage(held, "shared-prefixes")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """Sets of the nodes, each read from one document, and of a few
        others: texts are picked by a bitmap of their hashes and ids, without a
        shuffle of texts. A node may come several times."""
        one = F.min(F.struct("id", "body")).alias("one")
        chosen = self.members.filter("n > 0").join(nodes, "node", "left_semi").groupBy("node").agg(one)
        marks = bitmap(chosen, F.xxhash64("one.id", "one.body"))
        return cut_lineage(_sets(self.texts, marks, self.classes, self.size, self.percent), "near-sets")

    def compare(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) -> (a, b, common, total) of those that pass
        the prefix tests."""
        with lineage_scope(pairs.sparkSession):
            return cut_lineage(self._compared(pairs), "compared", outlives=True)

    def _compared(self, pairs: DataFrame) -> DataFrame:
        left = self.held.select(F.col("node").alias("a"), F.col("held").alias("ha"), F.col("n").alias("na"))
        right = self.held.select(F.col("node").alias("b"), F.col("held").alias("hb"), F.col("n").alias("nb"))
        shared = F.size(F.array_intersect("ha", "hb")) >= _least_shared(F.col("na"), F.col("nb"), self.percent)
        passed = cut_lineage(pairs.join(left, "a").join(right, "b").filter(shared).select(
            "a", "b", _least_shared(F.col("na"), F.col("nb"), self.percent).cast("int").alias("least")), "first-passed")
        sets = self.sets(passed.select(F.col("a").alias("node")).union(passed.select("b")).distinct())
        names = [f"{c}{k}" for k in range(1, ORDERS) for c in "pc"]
        # one copy of each node; both sides of the joins read the same shuffle
        prefixes = sets.groupBy("node").agg(F.first(F.struct(*names)).alias("prefixes"))
        left = prefixes.select(F.col("node").alias("a"), F.col("prefixes").alias("pa"))
        right = prefixes.select(F.col("node").alias("b"), F.col("prefixes").alias("pb"))
        tested = passed.join(left, "a").join(right, "b")
        for k in range(1, ORDERS):
            # the intersection has distinct values: tokens that fall together count once
            both = F.size(F.array_intersect(F.col("pa")[f"p{k}"], F.col("pb")[f"p{k}"]))
            tested = tested.filter(both + F.least(F.col("pa")[f"c{k}"], F.col("pb")[f"c{k}"]) >= F.col("least"))
        tested = cut_lineage(tested.select("a", "b"), "all-passed")
        whole = sets.groupBy("node").agg(F.first("tokens").alias("tokens"))
        left = whole.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
        right = whole.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
        counted = tested.join(right, "b").join(left, "a").select(
            "a", "b", F.size(F.array_intersect("ta", "tb")).cast("long").alias("common"),
            (F.size("ta") + F.size("tb")).cast("long").alias("sizes"))
        return counted.select("a", "b", "common", (F.col("sizes") - F.col("common")).alias("total"))


def _may_link(n: Column, m: Column, room: Column, far_room: Column, percent: int) -> Column:
    """Sizes are alike, and both have enough tokens to share in the open lists
    from this one on. A pair that shares enough passes in its first list."""
    least_shared = _least_shared(n, m, percent)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (least_shared <= F.least(room, far_room))


def _alike(lists: DataFrame) -> DataFrame:
    """Lists with the same nodes as one of them: columns as given, alike: how
    many they are, mark1, mark2, ...: the least hash of their tokens in each
    round. A pair that shares many tokens then meets once for each different
    list, not once for each token."""
    lists = lists.repartition("token")  # one shuffle of the same columns for the counts and the join
    nodes = [F.count("n").alias("held"), F.min("node").alias("lo"), F.max("node").alias("hi"), *(F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (0, 1))]
    marks = [F.min(F.xxhash64("token", F.lit(star))).alias(f"mark{star}") for star, width in enumerate(ROUNDS) if width]
    one = lists.groupBy("token").agg(*nodes).groupBy("held", "lo", "hi", "x0", "x1").agg(F.min("token").alias("token"), F.count("*").alias("alike"), *marks)
    return lists.join(one.drop("held", "lo", "hi", "x0", "x1"), "token")


def _pivot_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): every list member with one pivot of its token and size band, and
    the two members of a list of two whatever their bands. A list of two
    then holds no uncompared pair that could be linked."""
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)))
    pivot = F.min(F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("other"), F.col("n").alias("m")))
    tops = lists.groupBy("token", band.alias("band")).agg(pivot.alias("top")).select("token", "band", "top.*")
    drawn = lists.withColumn("band", band).join(tops, ["token", "band"]).filter((F.col("node") != F.col("other")) & _like_sizes("n", "m", percent))
    drawn = drawn.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    member = F.struct("node", "n")
    twos = lists.groupBy("token").agg(F.min(member).alias("x"), F.max(member).alias("y"), F.count("*").alias("held")).filter("held = 2")
    twos = twos.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("m"))
    return drawn.union(twos.filter(_like_sizes("n", "m", percent)).select("a", "b")).distinct()


def _neighbour_pairs(lists: DataFrame, star: int, width: int, percent: int) -> DataFrame:
    """(a, b): every list member with the ``width`` before it in an order in
    which like sets tend to stand together: by the least hash of the set's
    shared tokens, another hash in each round. The order is the same in all
    lists, so sets that share many lists meet in the same pairs."""
    by_mark = Window.partitionBy("token").orderBy(f"mark{star}", F.xxhash64("node", F.lit(star))).rowsBetween(-width, -1)
    before = F.collect_list(F.struct("node", "n", "label", "room")).over(by_mark)
    others = F.filter("before", lambda o: (o["label"] != F.col("label")) & _may_link(F.col("n"), o["n"], F.col("room"), o["room"], percent))
    drawn = lists.withColumn("before", before).select("node", F.explode(others).alias("o"))
    return drawn.select(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b")).distinct()


def _with_room(lists: DataFrame) -> DataFrame:
    """Rows of lists of different components that may hold uncompared pairs,
    with the least marks of the node in these lists and ``room``: the node's tokens in these lists from this one on, short
    lists first. The order is the same for all nodes, so a pair shares no
    more tokens than either has room in the first list where it meets; long
    lists of a common passage come last, where little room is left."""
    several = lists.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("held"))
    several = several.filter("lo <> hi and held > 2").select("token", "held")
    own = Window.partitionBy("node")
    on = own.orderBy("held", "token").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    marks = {c: F.min(c).over(own) for c in lists.columns if c.startswith("mark")}
    return lists.join(several, "token").withColumns({"room": F.sum("alike").over(on), **marks}).drop("held")


def _label(postings: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return postings.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, node (its set), component_id (the
    smallest id reachable by links), links (of its set, among those compared).
    Tables that the result does not read go before it is returned."""
    with lineage_scope(docs.sparkSession):
        members, named = _named_nodes(docs, doc_id, text, size, percent)
        named = cut_lineage(named, "node-components", outlives=True)
        members = cut_lineage(members, "node-members", outlives=True)
    filled = members.filter("n > 0").join(named, "node").select("id", "n", "node", F.col("smallest").alias("component_id"), "links")
    blank = members.filter("n = 0").select("id", "n", "node", F.col("id").alias("component_id"), F.lit(0).cast("long").alias("links"))
    return filled.union(blank).select(F.col("id").alias(doc_id), F.col("n").cast("long").alias("n_shingles"), "node", "component_id", "links")


def _named_nodes(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(id, n, node) of every document and (node, smallest, links) of every set."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("body"))
    scanned = cut_lineage(_scan(texts, size), "shingle-scan")
    members = scanned.filter("slice is null").select("id", "body", "n", "node")
    total = members.agg(F.sum("n")).first()[0] or 0
    classes = _sketch_classes(scanned.filter("slice is not null").select("slice", "counts", "more"), total)

    lists = cut_lineage(_postings(texts, classes, size, percent), "lists")
    comparer = _Comparer(texts, members, lists, classes, size, percent)

    empty = spark.createDataFrame([], "a long, b long, common long, total long")
    tested = empty
    lists = cut_lineage(_alike(lists), "unlike-lists")
    current = lists.withColumn("label", F.col("node"))
    for star, width in enumerate(ROUNDS):
        pairs = _neighbour_pairs(current, star, width, percent) if width else _pivot_pairs(current, percent)
        pairs = cut_lineage(pairs.join(tested, ["a", "b"], "left_anti"), "star-pairs")
        if pairs.isEmpty():
            break
        tested = cut_lineage(tested.union(pairs.join(comparer.compare(pairs), ["a", "b"], "left").select(
            "a", "b", F.coalesce("common", F.lit(0)).alias("common"), F.coalesce("total", F.lit(1)).alias("total"))), "tested")
        current = _label(lists, _links(tested, percent).select("a", "b"))
        current = cut_lineage(_with_room(current), "open-lists")

    if "room" not in current.columns:
        current = current.withColumn("room", F.col("n"))
    x, y = (current.select("token", F.col("node").alias(k), F.col("n").alias("n" + k), F.col("label").alias("l" + k), F.col("room").alias("r" + k))
            for k in ("a", "b"))
    may = (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & _may_link(*map(F.col, ("na", "nb", "ra", "rb")), percent)
    rest = x.join(y, "token").filter(may)
    rest = cut_lineage(rest.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "rest-pairs")
    tested = tested.union(comparer.compare(rest)) if not rest.isEmpty() else tested
    links = cut_lineage(_links(tested, percent), "jaccard-links")

    degree = links.select("a").union(links.select("b")).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("links"))
    labels = components(links.select("a", "b"))
    nodes = members.groupBy("node").agg(F.min("id").alias("least")).join(labels, "node", "left").join(degree, "node", "left")
    nodes = cut_lineage(nodes.withColumn("label", F.coalesce("label", "node")), "node-labels")
    smallest = nodes.groupBy("label").agg(F.min("least").alias("smallest"))
    named = nodes.join(smallest, "label").select("node", "smallest", F.coalesce("links", F.lit(0)).alias("links"))
    return members.select("id", "n", "node"), named


def _links(tested: DataFrame, percent: int) -> DataFrame:
    return tested.filter(F.col("common") * 100 >= F.col("total") * percent)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each component, columns as
    given. Of several rows with that id one stays. Rows without an id cannot
    be told apart by it and all stay."""
    with lineage_scope(docs.sparkSession):
        found = cut_lineage(similar_documents(docs, doc_id, text).select(F.col(doc_id).alias("id"), "component_id"), "components")
        keep = found.filter(F.col("id") == F.col("component_id")).select(F.col("id").alias("__keep")).distinct()
        keep = cut_lineage(keep, "kept-ids", outlives=True)
        repeated = not found.filter("id is not null").groupBy("id").count().filter("count > 1").isEmpty()
    named = docs.join(keep, docs[doc_id] == F.col("__keep"), "left_semi")
    if repeated:
        named = named.dropDuplicates([doc_id])
    return named.union(docs.filter(F.col(doc_id).isNull()))
