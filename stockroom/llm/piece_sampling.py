"""Sampled SentencePiece segmentations and lossless decoding.

Every way to cut a text into pieces of the vocabulary is a path through a
lattice. A piece weighs 1 / (rank + 1) ** SHARPNESS by its rank in the
vocabulary, a path the product of its pieces. Forward filtering sums the
paths to every position; backward sampling then draws a path from the end,
so that a segmentation is drawn with probability in proportion to its
weight. The draws come from a hash of (row key, unit, step): the same row
gives the same segmentation in every run, batch and partition.

No piece of the vocabulary crosses the beginning of a run of spaces (checked
when the model is loaded), so the lattice of a text falls apart into units,
a run of spaces and the word after it. The distinct units of a chunk of
texts are filtered once, all together, position by position; the draws of
all occurrences are vectorised too.

Spaces are written as the space mark, with one mark before the text, as
SentencePiece does. A character without a piece, and a space mark that the
text itself contains, become byte pieces, so decoding returns every text
exactly.

Defined results
    null text gives null ids, empty text no ids; texts are never cut, however
    long; a null key is one key; rows with equal key and text get equal ids;
    an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from stockroom.llm.bytehash import ByteHasher, mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SHARPNESS = 1.0
SEED = 17
SPACE_MARK = 0x2581
LITERAL_MARK = 0x110000  # a space mark of the text itself: above all code points
FALLBACK = 1 << 22  # piece numbers from here on: a character in bytes
CHUNK = 1 << 18  # characters that are encoded together
DECODE = 1 << 20  # ids whose bytes are gathered together


class Pieces:
    """Vocabulary: lookup tables by length, weights, bytes of each piece."""

    def __init__(self, model: str = MODEL, sharpness: float = SHARPNESS) -> None:
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor(model_file=model)
        self.hasher = ByteHasher()
        self.byte_id = np.zeros(256, dtype=np.int32)
        self.raw: list[bytes] = []
        words: list[tuple[int, str]] = []
        for k in range(source.get_piece_size()):
            piece = source.id_to_piece(k)
            if source.is_byte(k):
                self.byte_id[int(piece[3:5], 16)] = k
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif source.is_control(k) or source.is_unknown(k):
                self.raw.append(b"")
            else:
                assert chr(SPACE_MARK) not in piece.lstrip(chr(SPACE_MARK)), "a piece crosses units"
                words.append((k, piece))
                self.raw.append(piece.replace(chr(SPACE_MARK), " ").encode())
        # of each piece, and of a character in bytes
        self.log_weight = -sharpness * np.log1p(np.arange(len(self.raw) + 1, dtype=np.float64))
        self.longest = max(len(p) for _, p in words)
        ids = {p: k for k, p in words}
        self.prefixes = []  # for each length: sorted hashes of prefixes, piece or -1
        for size in range(1, self.longest + 1):
            found = sorted({p[:size] for _, p in words if len(p) >= size})
            codes = np.frombuffer("".join(found).encode("utf-32-le"), dtype=np.uint32)
            starts = np.arange(len(found)) * size
            hashes = self.hasher.spans(codes, starts, starts + size)
            order = np.argsort(hashes)
            self.prefixes.append((hashes[order], np.array([ids.get(p, -1) for p in found], dtype=np.int32)[order]))

    def edges(self, codes: np.ndarray, room: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first positions, pieces) of all pieces in the text, by
        length; ``room`` is the number of characters to the end of the unit.
        Only prefixes of pieces are followed to the next length."""
        alive = np.arange(len(codes))
        for size in range(1, self.longest + 1):
            alive = alive[room[alive] >= size]
            hashes, known = self.prefixes[size - 1]
            looked = self.hasher.spans(codes, alive, alive + size)
            at = np.searchsorted(hashes, looked).clip(max=len(hashes) - 1)
            hit = hashes[at] == looked
            found = np.where(hit, known[at], -1)
            if size == 1:  # a character without a piece goes in bytes
                yield 1, alive, np.where(found >= 0, found, FALLBACK + codes[alive].astype(np.int32))
            elif (found >= 0).any():
                yield size, alive[found >= 0], found[found >= 0]
            alive = alive[hit]


class ByteTable:
    """Byte strings laid end to end, to be joined by number."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        sizes = self.size[numbers]
        ends = np.cumsum(sizes)
        return self.data[np.repeat(self.begin[numbers] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def code_points(text: str) -> np.ndarray:
    """Code points with a leading space mark and marks for spaces."""
    codes = np.frombuffer((" " + text).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes == 0x20, np.uint32(SPACE_MARK), np.where(codes == SPACE_MARK, np.uint32(LITERAL_MARK), codes))


def unit_starts(codes: np.ndarray) -> np.ndarray:
    mark = codes == SPACE_MARK
    return np.flatnonzero(mark & ~np.concatenate([[False], mark[:-1]]))


def utf8(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat UTF-8 bytes of code points and the number of bytes of each."""
    distinct, which = np.unique(np.where(codes == LITERAL_MARK, SPACE_MARK, codes), return_inverse=True)
    table = ByteTable([chr(int(c)).encode("utf-8", "surrogatepass") for c in distinct])
    return table.joined(which), table.size[which]


@dataclass(frozen=True)
class Lattice:
    """Edges by the node in which they end."""

    rank: np.ndarray  # node of each position
    begin: np.ndarray  # first edge of each node
    piece: np.ndarray
    length: np.ndarray
    chance: np.ndarray  # running sum of the chances of all edges

    def draw(self, end: np.ndarray, uniform: np.ndarray) -> np.ndarray:
        """One edge that ends at each position."""
        node = self.rank[end]
        edge, last, goal = self.begin[node], self.begin[node + 1] - 1, node + uniform
        on = np.arange(len(edge))
        while len(on := on[(edge[on] < last[on]) & (self.chance[edge[on]] <= goal[on])]):
            edge[on] += 1
        return edge


class Encoder:
    def __init__(self, model: str = MODEL, sharpness: float = SHARPNESS, seed: int = SEED) -> None:
        self.pieces, self.seed = Pieces(model, sharpness), np.uint64(seed)

    def filtered(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Lattice:
        """Forward filtering of the units laid end to end. Nodes are the
        positions, ordered by their place in the unit, so that all nodes of a
        place, and all edges that end there, lie together."""
        p, n = self.pieces, len(codes)
        place = np.arange(n) - np.repeat(starts, sizes)
        order = np.argsort(place, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        edges = list(p.edges(codes, np.repeat(sizes, sizes) - place))
        degree = np.zeros(n, dtype=np.int64)
        for size, first, _ in edges:
            degree[rank[first + size - 1]] += 1
        begin = np.concatenate([[0], np.cumsum(degree)])
        fill, count = begin[:-1].copy(), int(begin[-1])
        piece, length = np.empty(count, dtype=np.int32), np.empty(count, dtype=np.int64)
        source, log_chance = np.empty(count, dtype=np.int64), np.empty(count)
        for size, first, found in edges:
            node = rank[first + size - 1]
            at = fill[node]
            piece[at], length[at] = found, size
            source[at] = np.where(place[first] == 0, 0, rank[first - 1] + 1)
            log_chance[at] = p.log_weight[np.minimum(found, len(p.log_weight) - 1)]
            fill[node] += 1
        total = np.zeros(n + 1)  # log weight of all paths; entry 0: the start of a unit
        widths = np.bincount(place)
        low = 0
        for high in np.cumsum(widths):
            e = slice(begin[low], begin[high])
            log_chance[e] += total[source[e]]
            at = begin[low:high] - begin[low]
            top = np.maximum.reduceat(log_chance[e], at)
            log_chance[e] -= np.repeat(top, degree[low:high])
            sums = np.log(np.add.reduceat(np.exp(log_chance[e]), at))
            log_chance[e] -= np.repeat(sums, degree[low:high])
            total[low + 1 : high + 1] = top + sums
            low = high
        # chances of a node add up to 1: one running sum serves all nodes
        return Lattice(rank, begin, piece, length, np.cumsum(np.exp(log_chance)))

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each."""
        coded = [code_points(t) if t else np.empty(0, dtype=np.uint32) for t in texts]
        codes = np.concatenate([*coded, np.empty(0, dtype=np.uint32)])
        if not len(codes):
            return np.empty(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        per_text = [unit_starts(c) for c in coded]
        offsets = np.cumsum([0, *(len(c) for c in coded)])
        starts = np.concatenate([s + o for s, o in zip(per_text, offsets[:-1], strict=True)])
        counts = np.array([len(s) for s in per_text])
        sizes = np.diff(np.append(starts, len(codes)))
        _, first, unit = np.unique(self.pieces.hasher.spans(codes, starts, starts + sizes), return_index=True, return_inverse=True)

        # the distinct units, end to end
        unit_sizes = sizes[first]
        unit_at = np.cumsum(unit_sizes) - unit_sizes
        take = np.repeat(starts[first] - unit_at, unit_sizes) + np.arange(unit_sizes.sum())
        lattice = self.filtered(codes[take], unit_at, unit_sizes)

        # draw all occurrences from their ends
        owner = np.repeat(np.arange(len(texts)), counts)
        number = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
        stream = mixed(keys.view(np.uint64)[owner] + self.seed) + mixed(number.astype(np.uint64) << np.uint64(20))
        left, active, drawn = sizes.copy(), np.arange(len(starts)), []
        step = 0
        while len(active):
            h = mixed(stream[active] + mixed(np.uint64(step + 1) + np.zeros(1, dtype=np.uint64)))
            uniform = (h >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = lattice.draw(unit_at[unit[active]] + left[active] - 1, uniform)
            drawn.append((active, lattice.piece[edge]))
            left[active] -= lattice.length[edge]
            active = active[left[active] > 0]
            step += 1
        n_pieces = np.zeros(len(starts), dtype=np.int64)
        for who, _ in drawn:
            n_pieces[who] += 1
        last = np.cumsum(n_pieces) - 1
        flat = np.empty(int(n_pieces.sum()), dtype=np.int32)
        for step, (who, piece) in enumerate(drawn):
            flat[last[who] - step] = piece
        per_piece = np.ones(len(flat), dtype=np.int64)
        raw = np.flatnonzero(flat >= FALLBACK)
        if len(raw):
            data, width = utf8(flat[raw].astype(np.int64) - FALLBACK)
            per_piece[raw] = width
            wide = np.repeat(flat, per_piece)
            wide[np.repeat(np.isin(np.arange(len(flat)), raw), per_piece)] = self.pieces.byte_id[data]
        else:
            wide = flat
        behind = np.concatenate([[0], np.cumsum(per_piece)])[np.concatenate([[0], np.cumsum(n_pieces)])]
        return wide, np.diff(behind[np.concatenate([[0], np.cumsum(counts)])])


class Decoder:
    def __init__(self, model: str = MODEL) -> None:
        self.table = ByteTable(Pieces(model).raw)

    def decode(self, ids: np.ndarray) -> str:
        return self.table.joined(np.asarray(ids, dtype=np.int64)).tobytes().decode("utf-8", "surrogatepass")[1:]

    def texts(self, lists: pa.ListArray) -> pa.Array:
        """The texts of lists of ids (null: null). The bytes of all lists are
        gathered at once, those of a long list in parts."""
        bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]).astype(np.int64)
        ids = lists.flatten().to_numpy()
        parts = [self.table.joined(ids[at : at + DECODE]) for at in range(0, len(ids), DECODE)]
        data = np.concatenate([*parts, np.empty(0, dtype=np.uint8)])
        ends = np.concatenate([[0], np.cumsum(self.table.size[ids])])[bounds]
        # every text that is not empty begins with the space before it
        filled = np.diff(bounds) > 0
        keep = np.ones(len(data), dtype=bool)
        keep[ends[:-1][filled]] = False
        offsets = (ends - np.concatenate([[0], np.cumsum(filled)])).astype(np.int32)
        valid = np.packbits(lists.is_valid().to_numpy(zero_copy_only=False), bitorder="little")
        return pa.Array.from_buffers(pa.string(), len(lists), [pa.py_buffer(x.tobytes()) for x in (valid, offsets, data[keep])])


def chunked(texts: list[str], size: int = CHUNK) -> Iterator[slice]:
    """Slices of texts of about ``size`` characters."""
    begin = held = 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield slice(begin, k + 1)
            begin, held = k + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _arrow_ids(ids: np.ndarray, sizes: np.ndarray, missing: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, type=pa.int32()), mask=pa.array(missing))


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", ids: str = "piece_ids", model: str = MODEL,
                     sharpness: float = SHARPNESS, seed: int = SEED) -> DataFrame:
    """``docs`` plus ``ids``: a segmentation drawn for each row."""
    columns = [c for c in docs.columns if c != ids]
    rows = docs.select(*columns, F.xxhash64(F.col(key)).alias("__seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, sharpness, seed)
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            texts = batch.column(text).to_pylist()
            seeds = batch.column("__seed").to_numpy()
            for part in chunked(texts):
                found, sizes = encoder.encode([t or "" for t in texts[part]], seeds[part])
                missing = np.array([t is None for t in texts[part]])
                kept = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [*(kept.column(c) for c in columns), _arrow_ids(found, sizes, missing)], names=[*columns, ids])

    schema = docs.select(*columns).schema.add(ids, ArrayType(IntegerType()))
    return rows.mapInArrow(run, schema)


def decode_documents(rows: DataFrame, ids: str = "piece_ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` plus ``out``: the text that the ids stand for."""

    @F.arrow_udf("string")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(model)
        for part in parts:
            texts = [decoder.texts(part.slice(at, 512)) for at in range(0, len(part), 512)]
            yield pa.concat_arrays(texts) if texts else pa.array([], pa.string())

    return rows.withColumn(out, decode(F.col(ids)))
