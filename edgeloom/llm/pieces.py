"""SentencePiece encoding by sampling, and lossless decoding.

A text is a path through a lattice: its characters are nodes, every vocabulary
piece that matches is an edge. Forward filtering sums the weights of all paths that
reach a node; backward sampling walks from the end and draws each piece
in proportion to its share of that sum. So whole segmentations are drawn from their exact
distribution. Every draw is a hash of the row's key, the seed and the place in the
text: one row always gets one segmentation, wherever and however often it runs.

The vocabulary file is a BPE model, whose scores are ranks, not probabilities. A
piece's weight is ``rank ** -temper`` (Zipf's law). Characters without a piece
are edges made of their byte pieces.

**Lossless.** Blanks become U+2581 and one is put before the text, as usual; a
U+2581 of the text itself goes as bytes, and nothing is normalised. Decoding gives back
the very text. A null text has null ids and decodes to null, an empty one none.

**Work.** No piece crosses a border before U+2581, nor a character that is in no piece.
The lattice falls into units at these borders, which are independent. Each distinct unit
of a block is filtered once, all units in step; then all occurrences are sampled in
step. The lattice is laid out by step, and a step has only as many lengths as characters
before it. A very long unit takes steps in proportion to its length. Both directions work and
write by blocks of whole rows, and Spark hands over short batches, so memory follows the block or the longest text.
Repeated rows of one key and text get equal ids; rows without a key are seeded like
any other value. Extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.llm.language import code_points
from edgeloom.llm.textblocks import lean, mix, row_blocks, short_batches, utf8

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
TEMPER = 1.0
BLOCK_BYTES = 2**17
BLANK = 0x2581
# Stands for a U+2581 of the text, which must not be taken for a blank.
LITERAL = 0x110000
COLUMN = "__ids"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SLOT_BITS = 20


@dataclass
class Vocabulary:
    """Pieces as hashes of their code points, with their weights and bytes."""

    pieces: list[str]
    byte_ids: np.ndarray  # id of the piece of each byte
    plain: list[int]  # ids of the pieces that match text
    temper: float = TEMPER
    longest: int = field(init=False)

    def __post_init__(self):
        texts = [self.pieces[i] for i in self.plain]
        self.longest = max(map(len, texts), default=1)
        if any(a != chr(BLANK) and b == chr(BLANK) for t in texts for a, b in zip(t, t[1:])):
            raise ValueError("a piece goes on past the end of a word")
        ids = np.array(self.plain, np.int32)
        hashes = np.array([_hash_one(t) for t in texts], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order]
        self.weights = (self.ids + 1.0) ** -self.temper
        # The first piece of each slot of hashes; pieces of one slot are neighbours.
        slots = (self.hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        self.slots = np.full(2**_SLOT_BITS, -1, np.int32)
        self.slots[slots[::-1]] = np.arange(len(slots), dtype=np.int32)[::-1]
        self.crowd = int(np.bincount(slots).max(initial=1))
        self.known = np.zeros(0x110001, bool)
        self.known[list({ord(c) for t in texts for c in t})] = True
        self.byte_weight = (len(self.pieces) + 1.0) ** -self.temper
        self.bytes = [t.replace(chr(BLANK), " ").encode() for t in self.pieces]
        for value, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([value])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that are pieces, and which."""
        at = self.slots[hashes >> np.uint64(64 - _SLOT_BITS)]
        places = np.flatnonzero(at >= 0)
        at, wanted = at[places], hashes[places]
        true = self.hashes[at] == wanted
        for _ in range(1, self.crowd):
            rest = np.flatnonzero(~true)
            at[rest] = np.minimum(at[rest] + 1, len(self.hashes) - 1)
            true[rest] = self.hashes[at[rest]] == wanted[rest]
        return places[true], at[true]


def _hash_one(text: str) -> int:
    codes = np.array([ord(c) for c in text], np.uint64)
    return int(_range_hashes(_sums(codes), np.array([0]), len(codes))[0])


def _sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which the hash of any range follows, and the inverse powers."""
    powers, down = (np.full(len(codes) + 1, x, np.uint64) for x in (_BASE, _INVERSE))
    powers[0] = down[0] = 1
    with np.errstate(over="ignore"):
        powers, down = np.multiply.accumulate(powers), np.multiply.accumulate(down)
        values = mix((codes.astype(np.uint64) + np.uint64(1)) * _BASE)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1])]), down


def _range_hashes(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, size) -> np.ndarray:
    up, down = sums
    with np.errstate(over="ignore"):
        size = np.asarray(size)
        return mix((up[starts + size] - up[starts]) * down[starts] ^ size.astype(np.uint64))


def load(path: str = VOCABULARY, temper: float = TEMPER) -> Vocabulary:
    """Read a SentencePiece model with byte fallback; only its pieces are used."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids]
    byte_ids = [i for i in ids if model.is_byte(i)]
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary needs a piece for each byte")
    byte_ids.sort(key=lambda i: int(pieces[i][1:-1], 16))
    special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    plain = [i for i in ids if i not in special and not model.is_byte(i)]
    return Vocabulary(pieces, np.array(byte_ids, np.int32), plain, temper)


def _utf8_size(codes: np.ndarray) -> np.ndarray:
    codes = np.where(codes == LITERAL, BLANK, codes)
    return 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)


@dataclass
class Lattice:
    """The pieces that end at each character of some units, longest unit first, by step.

    Step ``t`` has one row for each unit of more than ``t`` characters, with a column for
    each length that fits: at ``base[t] + unit * width[t]`` in ``weights`` and ``ids``. Id -2 means the character's own
    bytes, -1 no piece.
    """

    base: np.ndarray
    width: np.ndarray
    active: np.ndarray
    weights: np.ndarray
    ids: np.ndarray
    longest: int

    def filter(self) -> None:
        """Forward filtering in place: weights become running sums of each length's share.

        Sums are scaled to 1 at each step, so long units do not underflow.
        """
        before = np.ones((int(self.active[0]) if len(self.active) else 0, 1))
        for base, width, m in zip(self.base, self.width, self.active, strict=True):
            rows = self.weights[base : base + m * width].reshape(m, width)
            rows *= before[:m]
            total = rows.sum(axis=1, keepdims=True)
            rows /= total
            np.cumsum(rows, axis=1, out=rows)
            after = np.empty((m, width + 1))
            after[:, 0] = 1.0
            np.divide(before[:m], total, out=after[:, 1:])
            before = after[:, : self.longest]


def _lattice(codes: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary) -> Lattice:
    """The lattice of units whose ``codes`` stand one after the other; ``sizes`` do not grow."""
    longest = vocabulary.longest
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), "left")
    width = np.minimum(np.arange(1, steps + 1), longest)
    cells = active * width
    base = np.cumsum(cells) - cells
    weights, ids = np.zeros(int(cells.sum())), np.full(int(cells.sum()), -1, np.int32)
    # Characters by step and unit: their first cells, and their places in ``codes``.
    offset = np.append(0, np.cumsum(active))
    unit = np.arange(offset[-1]) - np.repeat(offset[:-1], active)
    row = np.repeat(base, active) + unit * np.repeat(width, active)
    end = (np.cumsum(sizes) - sizes)[unit] + np.repeat(np.arange(steps), active)
    sums = _sums(codes)
    for size in range(1, min(longest, steps) + 1):
        first = offset[size - 1]
        found, which = vocabulary.find(_range_hashes(sums, end[first:] - (size - 1), size))
        at = row[first:][found] + size - 1
        weights[at] = vocabulary.weights[which]
        ids[at] = vocabulary.ids[which]
    bare = np.flatnonzero(ids[row] == -1)
    ids[row[bare]] = -2
    weights[row[bare]] = vocabulary.byte_weight ** _utf8_size(codes[end[bare]])
    return Lattice(base, width, active, weights, ids, longest)


def _units(codes: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """First characters of the units of all texts."""
    border = np.zeros(len(codes), bool)
    blank, known = codes == BLANK, vocabulary.known[codes]
    border[1:] = (blank[1:] & ~blank[:-1]) | ~known[1:] | ~known[:-1]
    border[offsets[offsets < len(codes)]] = True
    return np.flatnonzero(border)


def _distinct(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """For each unit the number of its kind, and one unit of each kind."""
    hashes = _range_hashes(_sums(codes), starts, sizes)
    _, one, kind = np.unique(hashes, return_index=True, return_inverse=True)
    inside = np.arange(len(codes)) - np.repeat(starts, sizes)
    same = codes[np.repeat(starts[one[kind]], sizes) + inside] if len(codes) else codes
    if (sizes != sizes[one[kind]]).any() or (same != codes).any():  # a collision
        return np.arange(len(starts)), np.arange(len(starts))
    return kind, one


def sample_ids(
    codes: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, vocabulary: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts one after the other, and the offsets in them."""
    rows = len(offsets) - 1
    if not len(codes):
        return np.empty(0, np.int32), np.zeros(rows + 1, np.int64)
    starts = _units(codes, offsets, vocabulary)
    sizes = np.diff(np.append(starts, len(codes)))
    kind, one = _distinct(codes, starts, sizes)
    order = np.argsort(-sizes[one], kind="stable")
    one, kind = one[order], np.argsort(order)[kind]
    kind_sizes = sizes[one]
    inside = np.arange(int(kind_sizes.sum())) - np.repeat(np.cumsum(kind_sizes) - kind_sizes, kind_sizes)
    lattice = _lattice(codes[np.repeat(starts[one], kind_sizes) + inside], kind_sizes, vocabulary)
    lattice.filter()

    drawn = np.full(len(codes), -1, np.int32)
    row = np.searchsorted(offsets, starts, "right") - 1
    first, seed = offsets[row], mix(seeds[row])
    unit, end = np.arange(len(starts)), sizes.copy()
    while len(unit):
        place = starts[unit] + end - 1
        with np.errstate(over="ignore"):
            spot = (place - first[unit]).astype(np.uint64)
            bits = mix(seed[unit] + (spot + np.uint64(1)) * _BASE)
        u = (bits >> np.uint64(11)) * 2.0**-53
        width = lattice.width[end - 1]
        at = lattice.base[end - 1] + kind[unit] * width
        # Scaled by the last sum, which rounding may leave off 1.
        goal = u * lattice.weights[at + width - 1]
        size = np.ones(len(unit), np.int64)
        longer = np.flatnonzero(lattice.weights[at] <= goal)
        while len(longer):
            size[longer] += 1
            longer = longer[lattice.weights[at[longer] + size[longer] - 1] <= goal[longer]]
        drawn[place] = lattice.ids[at + size - 1]
        end = end - size
        more = end > 0
        unit, end = unit[more], end[more]

    places = np.flatnonzero(drawn != -1)
    found = drawn[places]
    spelled = found == -2
    widths = np.where(spelled, _utf8_size(codes[places]), 1)
    out = np.repeat(found, widths)
    ends = np.cumsum(widths)
    own, which = np.unique(codes[places[spelled]], return_inverse=True)
    table = np.full((len(own), 4), -1, np.int32)
    for i, code in enumerate(own):
        raw = chr(BLANK if code == LITERAL else code).encode("utf-8", "surrogatepass")
        table[i, : len(raw)] = vocabulary.byte_ids[list(raw)]
    first = (ends - widths)[spelled]
    for k in range(4):
        has = widths[spelled] > k
        out[first[has] + k] = table[which[has], k]
    return out, np.append(0, ends)[np.searchsorted(places, offsets)]


def _prepared(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blanks marked, and one put before each text that is not empty."""
    codes = np.where(codes == BLANK, LITERAL, np.where(codes == 0x20, BLANK, codes))
    sizes = np.diff(offsets)
    full = sizes > 0
    return np.insert(codes, offsets[:-1][full], BLANK), np.append(0, np.cumsum(sizes + full))


def encode_column(column: pa.Array, seeds: pa.Array, vocabulary: Vocabulary) -> Iterator[pa.Array]:
    """Sampled ids of all rows, an array of lists for each block of rows."""
    all_data, all_offsets = utf8(column)
    seed = seeds.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    for first, last in row_blocks(all_offsets, BLOCK_BYTES):
        offsets = all_offsets[first : last + 1]
        codes = code_points(all_data[offsets[0] : offsets[-1]], offsets - offsets[0])
        ids, ends = sample_ids(*_prepared(*codes), seed[first:last], vocabulary)
        nulls = column.slice(first, last - first).is_null()
        yield pa.ListArray.from_arrays(
            pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()), mask=nulls
        )


def decode_column(column: pa.Array, vocabulary: Vocabulary) -> Iterator[pa.Array]:
    """The texts of all rows, an array for each block of rows."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    for first, last in row_blocks(offsets, BLOCK_BYTES):  # ids, each of a few bytes
        texts = [
            decode_ids(ids.values.to_numpy(), vocabulary) if ids.is_valid else None
            for ids in column.slice(first, last - first)
        ]
        yield pa.array(texts, pa.string())


def decode_ids(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    text = b"".join([vocabulary.bytes[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass")
    return text[1:]


def _seeds(key: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key))


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary | None = None,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 0,
) -> DataFrame:
    """``docs`` with ``__ids``, a sampled segmentation of the text as piece ids."""
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load())
    schema = T.StructType([*docs.schema.fields, T.StructField(COLUMN, T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            seeds = batch.column(batch.num_columns - 1)
            at = 0
            for ids in encode_column(column, seeds, shared.value):
                part = batch.slice(at, len(ids))
                at += len(ids)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=schema.names)

    return docs.withColumn("__seed", _seeds(key, seed)).mapInArrow(lean(run), schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None, to: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ``__ids`` stand for."""
    short_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary or load())
    schema = T.StructType([*encoded.schema.fields, T.StructField(to, T.StringType())])

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(COLUMN))
            at = 0
            for texts in decode_column(lists, shared.value):
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=schema.names)

    return encoded.mapInArrow(lean(run), schema)


def vocabulary_of(spark: SparkSession, path: str = VOCABULARY) -> Vocabulary:
    """The vocabulary named by ``spark.edgeloom.pieces``, or the default file."""
    return load(spark.conf.get("spark.edgeloom.pieces", path))
