"""Benchmark decontamination with a broadcast hash set of test n-grams.

The windows of ``n`` consecutive words of all benchmark items are hashed into a
set that every task gets; an item of fewer words is one window. Tasks hash the
same windows of the documents, look them up, compare the words of each hit
with the item's, and mark the words that any true occurrence covers. Documents
are read once and nothing is shuffled.

The set is built from about ``SLICE_BYTES`` of benchmark text and kept in flat arrays: the words
themselves, and 20 bytes a window, about five bytes for each byte of text. A larger
benchmark is dealt by item into slices of that size and the documents are
scanned once per slice; the marks of all slices are joined.

Words are runs of digits, letters a-z (A-Z are lower-cased) and characters from
U+0080. Null and empty texts have no words. Items without an id count, under
the name ``null``; items with one id are one item. Repeated documents are
handled each on its own. Columns of the documents besides the text are never
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.llm.textblocks import lean, row_blocks, runs, utf8, window_hashes, word_hashes
from edgeloom.storage import keep

WINDOW = 10
SLICE_BYTES = 2**24

_byte = np.arange(256)
IS_WORD = (
    (_byte >= 0x80)
    | ((_byte >= 0x30) & (_byte <= 0x39))
    | ((_byte >= 0x41) & (_byte <= 0x5A))
    | ((_byte >= 0x61) & (_byte <= 0x7A))
)


class Windows:
    """The benchmark's windows by length: sorted hashes, places in the items' words, items.

    Windows of one hash stand side by side; one item's equal windows are one.
    """

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.names = [item for item, _ in items]
        data, offsets = utf8(pa.array([text for _, text in items], pa.string()))
        starts, ends, rows = runs(IS_WORD[data], offsets)
        words = word_hashes(data, starts, ends)
        self.text, at = _joined(data, starts, ends)
        counts = np.bincount(rows, minlength=len(items))
        first_word = np.cumsum(counts) - counts
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        self.marks: dict[int, np.ndarray] = {}
        for length in sorted({int(n) for n in np.minimum(counts, size)} - {0}):
            hashes, first = window_hashes(words, rows, length)
            if length < size:  # whole items only
                own = np.isin(first, first_word[counts == length])
                own &= counts[rows[first]] == length
                hashes, first = hashes[own], first[own]
            item = rows[first].astype(np.int32)
            order = np.lexsort((item, hashes))
            hashes, first, item = hashes[order], first[order], item[order]
            begin, end = at[first].astype(np.uint32), (at[first + length] - 1).astype(np.uint32)
            fresh = np.ones(len(hashes), bool)
            same = (hashes[1:] == hashes[:-1]) & (item[1:] == item[:-1])
            for i in np.flatnonzero(same) + 1:
                fresh[i] = self.text[begin[i] : end[i]] != self.text[begin[i - 1] : end[i - 1]]
            table = tuple(x[fresh] for x in (hashes, begin, end, item))
            self.tables[length] = table
            # A first test on 16 bits spares most windows the binary search.
            self.marks[length] = np.zeros(2**16, bool)
            self.marks[length][table[0] >> np.uint64(48)] = True

    @property
    def nbytes(self) -> int:
        return len(self.text) + sum(x.nbytes for t in self.tables.values() for x in t)

    def occurrences(self, data, starts, ends, rows) -> Iterator[tuple[int, int, tuple[int, int]]]:
        """First word and length of each window found, words compared, and which it is."""
        words = word_hashes(data, starts, ends)
        for length, (known, begin, end, _) in self.tables.items():
            hashes, first = window_hashes(words, rows, length)
            maybe = np.flatnonzero(self.marks[length][hashes >> np.uint64(48)])
            at = np.minimum(np.searchsorted(known, hashes[maybe]), max(0, len(known) - 1))
            hit = known[at] == hashes[maybe]
            for i, k in zip(first[maybe[hit]].tolist(), at[hit].tolist(), strict=True):
                own = _words(data, starts, ends, i, length)
                while k < len(known) and self.text[begin[k] : end[k]] != own:
                    k = k + 1 if k + 1 < len(known) and known[k + 1] == known[k] else len(known)
                if k < len(known):
                    yield i, length, (length, k)

    def items_of(self, windows: set[tuple[int, int]]) -> list[str]:
        """Ids of the items that hold any of the windows found."""
        found = set()
        for length, k in windows:
            known, begin, end, item = self.tables[length]
            own, hashed = self.text[begin[k] : end[k]], known[k]
            while k < len(known) and known[k] == hashed:
                if self.text[begin[k] : end[k]] == own:
                    found.add(int(item[k]))
                k += 1
        return sorted({self.names[i] for i in found})


def _joined(data, starts, ends) -> tuple[bytes, np.ndarray]:
    """All words in lower case, a blank after each, and where each begins (and the last ends)."""
    lengths = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    inside = np.arange(at[-1]) - np.repeat(at[:-1], lengths)
    word = inside < np.repeat(lengths - 1, lengths)
    out = np.full(at[-1], 32, np.uint8)
    out[word] = data[(np.repeat(starts, lengths) + inside)[word]]
    return out.tobytes().lower(), at


def _words(data, starts, ends, i: int, length: int) -> bytes:
    pieces = (data[starts[k] : ends[k]].tobytes() for k in range(i, i + length))
    return b" ".join(pieces).lower()


def _scan(column: pa.Array, windows: Windows) -> Iterator[tuple[int, list, list]]:
    """For each row its number of words, the hit words as [first, end) and the items."""
    all_data, all_offsets = utf8(column)
    for first, last in row_blocks(all_offsets):
        offsets = all_offsets[first : last + 1]
        data, offsets = all_data[offsets[0] : offsets[-1]], offsets - offsets[0]
        starts, ends, rows = runs(IS_WORD[data], offsets)
        counts = np.bincount(rows, minlength=last - first)
        base = np.cumsum(counts) - counts
        spans: dict[int, list] = {}
        for i, length, which in windows.occurrences(data, starts, ends, rows):
            spans.setdefault(int(rows[i]), []).append((i - int(base[rows[i]]), length, which))
        for row in range(last - first):
            found = spans.get(row, [])
            hits = _merged([[begin, begin + length] for begin, length, _ in found])
            yield int(counts[row]), hits, windows.items_of({which for *_, which in found})


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def _without(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = runs(IS_WORD[data], np.array([0, len(data)]))
    parts, at = [], 0
    for begin, end in spans:
        parts.append(data[at : starts[begin]].tobytes())
        at = int(ends[end - 1])
    return b"".join([*parts, data[at:].tobytes()]).decode()


# What each scan adds; one reserved column, so other names cannot clash.
MARKS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.list_(pa.int64()))),
        ("items", pa.list_(pa.string())),
    ]
)
COLUMN = "__marks"


def _slices(benchmark: DataFrame, item: str, text: str, size: int, most: int) -> Iterator[Windows]:
    """Hash sets over parts of the benchmark, each from about ``most`` bytes."""
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / most))
    for i in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield Windows([tuple(r) for r in part.distinct().collect()], size)


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` with the struct column ``__marks(n_words, hits, items)``.

    ``hits`` are ranges of word numbers ``[first, end)`` that occurrences of
    benchmark windows cover; ``items`` are the ids of the items they come from.
    """
    spark = docs.sparkSession
    schema = T.StructType([*docs.schema.fields, T.StructField(COLUMN, MARKS)])
    marked = None
    for windows in _slices(benchmark, item, item_text, size, slice_bytes):
        shared = spark.sparkContext.broadcast(windows)

        def scan(batches, shared=shared, again=marked is not None):
            for batch in batches:
                column = batch.column(batch.schema.get_field_index(text))
                found = list(_scan(column, shared.value))
                if again:
                    before = batch.column(batch.num_columns - 1).to_pylist()
                    found = [
                        (n, _merged(h + b["hits"]), sorted({*i, *b["items"]}))
                        for (n, h, i), b in zip(found, before, strict=True)
                    ]
                rows = [{"n_words": n, "hits": h, "items": i} for n, h, i in found]
                arrays = batch.columns[: batch.num_columns - again]
                names = [f.name for f in batch.schema][: len(arrays)]
                marks = pa.array(rows, _ARROW)
                yield pa.RecordBatch.from_arrays([*arrays, marks], names=[*names, COLUMN])

        # Between slices the frame is written, so that one set is held at a time.
        marked = (docs if marked is None else keep(marked, "marked")).mapInArrow(lean(scan), schema)
    return marked


def n_hit(marks: str = COLUMN) -> F.Column:
    """Number of words that benchmark windows cover."""
    return F.aggregate(
        F.col(f"{marks}.hits"), F.lit(0).cast("bigint"), lambda n, h: n + h[1] - h[0]
    )


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """``(key, n_words, n_hit, items, contaminated)`` for each row of ``docs``."""
    marked = mark(docs.select(key, how.get("text", "text")), benchmark, **how)
    return marked.select(
        key,
        F.col(f"{COLUMN}.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.col(f"{COLUMN}.items").alias("items"),
        (F.size(f"{COLUMN}.hits") > 0).alias("contaminated"),
    )


def drop_documents(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    marked = mark(docs, benchmark, **how)
    return marked.where(F.size(f"{COLUMN}.hits") == 0).drop(COLUMN)


def drop_spans(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` with all words covered by benchmark windows cut out of the text."""
    text = how.get("text", "text")
    marked = mark(docs, benchmark, **how)
    schema = docs.schema

    def cut(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            marks = batch.column(batch.num_columns - 1).to_pylist()
            texts = [
                _without(t, m["hits"]) if t and m["hits"] else t
                for t, m in zip(batch.column(at).to_pylist(), marks, strict=True)
            ]
            arrays = batch.columns[:-1]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return marked.mapInArrow(lean(cut), schema)
