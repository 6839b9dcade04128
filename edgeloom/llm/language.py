"""Word-level language identification with a linear-chain conditional random field.

Each word of a text is a position of a chain whose states are the languages.
A word's score for a language is the sum of the weights of its features: the
word itself (lexicon), its affixes of up to three letters, and its letter
2- and 3-grams. Learned transition weights tie neighbouring words, so that
code-switched text splits into stretches. Forward-backward gives each word's
distribution; a document's language has the highest mean probability over its words.

**Training.** The model is fitted on the driver to a bounded sample of rows: of those
with a letter and at most ``LONGEST`` characters, the ``PER_LANGUAGE`` of each language with the least hashes
of their ids, and ``SAMPLE`` in all. Their texts train as a whole: each is cut into stretches of up to
``RUN_WORDS`` words, and all stretches are strung together, often of different
languages, which is what the transitions are learned from. All weights are fitted together by
the gradient of the chain's likelihood.

**Prediction** reads every whole text in tasks; it needs no shuffle. Each distinct word of a block is scored
once. Chains are cut into segments of ``SEGMENT`` words: a segment's transfer matrix carries
messages across it, so all segments of a block go on in step and a very long text takes no more
steps than others. Letters are characters of category L; other characters separate words. Null texts and texts without letters are ``und`` with score
0, and so is everything if no labelled row was given. Rows without a language do not
train. Repeated rows get equal results; extra columns are carried along.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.llm.textblocks import lean, mix, row_blocks, runs, short_batches, utf8

UNKNOWN = "und"
PER_LANGUAGE, SAMPLE, LONGEST = 100, 1000, 2**16
RUN_WORDS, SEQUENCE_RUNS = 24, 4
SEGMENT = 64
FEATURE_BITS = 18
ROUNDS, RATE, DECAY = 40, 0.15, 1e-4
BLOCK_BYTES = 2**19
COLUMN = "__lang"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BEGIN, _END = np.uint64(0x110000), np.uint64(0x110001)
_tables: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, whether it is a letter, and its lower case."""
    if not _tables:
        letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            char = chr(i)
            if char.isalpha():
                letter[i] = True
                small = char.lower()
                if len(small) == 1:
                    lower[i] = ord(small)
        _tables.extend((letter, lower))
    return _tables[0], _tables[1]


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes as code points, and the offsets in them."""
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    text = data.tobytes().decode("utf-8", "surrogatepass")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, begins[offsets]


def word_kinds(codes: np.ndarray, offsets: np.ndarray):
    """Starts, ends and rows of all words, the kind of each, and the letters of each kind.

    Words whose lower case has equal 64-bit hashes are of one kind. The letters of all kinds stand
    one after the other, with offsets.
    """
    is_letter, lower = _letters()
    letters = is_letter[codes]
    starts, ends, rows = runs(letters, offsets)
    if not len(starts):
        return starts, ends, rows, starts, codes[:0], np.zeros(1, np.int64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    small = lower[codes[letters]]
    place = np.arange(len(small)) - np.repeat(first, sizes)
    with np.errstate(over="ignore"):
        spread = mix((small.astype(np.uint64) + np.uint64(1)) * _BASE + (place.astype(np.uint64) << np.uint64(32)))
        hashes = mix(np.add.reduceat(spread, first))
    _, one, kind = np.unique(hashes, return_index=True, return_inverse=True)
    own = np.cumsum(sizes[one])
    inside = np.arange(own[-1]) - np.repeat(own - sizes[one], sizes[one])
    return starts, ends, rows, kind, small[np.repeat(first[one], sizes[one]) + inside], np.append(0, own)


@dataclass
class Words:
    """Words of a block: place, row, and the numbers of their features."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    whole: np.ndarray  # words x 3: the word, its prefix and its suffix of three letters
    grams: np.ndarray  # all 2- and 3-grams; number 0 stands for none
    first_gram: np.ndarray

    def gram_words(self) -> np.ndarray:
        sizes = np.diff(np.append(self.first_gram, len(self.grams)))
        return np.repeat(np.arange(len(self.starts)), sizes)


def featurize(codes: np.ndarray, offsets: np.ndarray) -> Words:
    is_letter, lower = _letters()
    letters = is_letter[codes]
    starts, ends, rows = runs(letters, offsets)
    n, sizes = len(starts), ends - starts
    # Each word between two border marks, all words one after the other.
    first = np.concatenate([[0], np.cumsum(sizes + 2)])[:-1]
    padded = np.empty(int(sizes.sum()) + 2 * n, np.uint64)
    if n:
        inner = np.ones(len(padded), bool)
        inner[first] = inner[first + sizes + 1] = False
        padded[first], padded[first + sizes + 1] = _BEGIN, _END
        padded[inner] = lower[codes[letters]]
    shift = np.uint64(64 - FEATURE_BITS)
    with np.errstate(over="ignore"):
        spread = mix((padded + np.uint64(1)) * _BASE)
        two = spread[:-1] * np.uint64(3) + spread[1:] * np.uint64(5)
        three = two[:-1] * np.uint64(7) + spread[2:] * np.uint64(11) if n else two[:0]
        four = three[:-1] * np.uint64(13) + spread[3:] * np.uint64(17) if n else two[:0]
        last = first + sizes + 1

        def number(values, kind):
            return (mix(values ^ np.uint64(kind)) >> shift).astype(np.int64)

        grams = np.zeros((len(padded), 2), np.int64)
        grams[: len(two), 0] = number(two, 1)
        grams[: len(three), 1] = number(three, 2)
        grams[last] = 0
        grams[last[sizes > 0] - 1, 1] = 0
        whole = np.zeros((n, 3), np.int64)
        if n:
            places = np.arange(len(padded)) - np.repeat(first, sizes + 2)
            sums = np.add.reduceat(mix(spread + places.astype(np.uint64) * _BASE), first)
            whole[:, 0] = number(sums, 3)
            long = np.flatnonzero(sizes >= 3)
            whole[long, 1] = number(four[first[long]], 4)
            whole[long, 2] = number(four[last[long] - 3], 5)
    return Words(starts, ends, rows, whole, grams.reshape(-1), 2 * first)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages; row 0 stays 0
    start: np.ndarray
    moves: np.ndarray  # from x to

    def emissions(self, words: Words) -> np.ndarray:
        if not len(words.starts):
            return np.zeros((0, len(self.languages)), np.float32)
        sums = np.add.reduceat(self.weights[words.grams], words.first_gram, axis=0)
        return sums + self.weights[words.whole].sum(axis=1)


def marginals(emissions: np.ndarray, counts: np.ndarray, start: np.ndarray, moves: np.ndarray):
    """Forward-backward over several chains at once.

    ``emissions`` holds the log scores of all chains one after the other,
    ``counts`` their lengths. Returns each position's distribution, the sum of the pair
    distributions of neighbours, and the chains' first distributions' sum.
    """
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    lengths = counts[order]
    base = (np.cumsum(counts) - counts)[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    likely = np.exp((emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64))
    step, begin = np.exp(moves), np.exp(start)
    forward = np.empty_like(likely)
    pairs = np.zeros_like(step)
    state = np.repeat(begin[None], len(base), axis=0)
    for t in range(steps):
        m = active[t]
        state = (state if t == 0 else state[:m] @ step)[:m] * likely[base[:m] + t]
        state /= state.sum(axis=1, keepdims=True)
        forward[base[:m] + t] = state
    out = np.empty_like(likely)
    back = np.ones((len(base), len(begin)))
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = base[:m] + t
        both = forward[at] * back[:m]
        out[at] = both / both.sum(axis=1, keepdims=True)
        message = likely[at] * back[:m]
        if t:
            joint = forward[at - 1][:, :, None] * step[None] * message[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        message = message @ step.T
        back[:m] = message / message.sum(axis=1, keepdims=True)
    return out, pairs, out[base].sum(axis=0)


def posteriors(
    emissions: np.ndarray, kind: np.ndarray, counts: np.ndarray, start: np.ndarray, moves: np.ndarray
) -> np.ndarray:
    """Each position's distribution, as ``marginals`` gives it, by segments of chains.

    Position ``i`` has the log scores ``emissions[kind[i]]``. Inside a segment ``spread`` is the matrix that
    carries a message over it; messages at segment borders go on chain by chain, then all
    segments are worked through in step.
    """
    likely = np.exp((emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64))[kind]
    step, k = np.exp(moves), len(start)
    per_chain = -(-counts // SEGMENT)
    chain = np.repeat(np.arange(len(counts)), per_chain)
    nth = np.arange(len(chain)) - np.repeat(np.cumsum(per_chain) - per_chain, per_chain)
    base = (np.cumsum(counts) - counts)[chain] + nth * SEGMENT
    size = np.minimum(counts[chain] - nth * SEGMENT, SEGMENT)

    order = np.argsort(-size, kind="stable")
    base, size, nth, chain = base[order], size[order], nth[order], chain[order]
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), "left")
    spread = np.repeat(np.eye(k)[None], len(base), axis=0)
    for t in range(1, steps):
        m = active[t]
        moved = (spread[:m].reshape(-1, k) @ step).reshape(m, k, k) * likely[base[:m] + t][:, None, :]
        spread[:m] = moved / moved.sum(axis=(1, 2), keepdims=True)

    # Messages into the first position of each segment, and back into its last one.
    place = np.lexsort((chain, nth))
    bounds = np.searchsorted(nth[place], np.arange(int(nth.max(initial=-1)) + 2))
    entry, back = np.empty((len(base), k)), np.ones((len(base), k))
    at = np.full(len(counts), -1)
    for n, (first, last) in enumerate(zip(bounds, bounds[1:], strict=False)):
        now = place[first:last]
        if n == 0:
            entry[now] = np.exp(start)
        else:
            old = at[chain[now]]
            left = np.einsum("ni,nij->nj", entry[old] * likely[base[old]], spread[old]) @ step
            entry[now] = left / left.sum(axis=1, keepdims=True)
        at[chain[now]] = now
    after = np.full(len(counts), -1)
    for first, last in reversed(list(zip(bounds, bounds[1:], strict=False))):
        now = place[first:last]
        known = after[chain[now]] >= 0
        new = after[chain[now[known]]]
        message = np.einsum("nij,nj->ni", spread[new], back[new])
        right = (message * likely[base[new]]) @ step.T
        back[now[known]] = right / right.sum(axis=1, keepdims=True)
        after[chain[now]] = now

    forward = np.empty_like(likely)
    state = entry
    for t in range(steps):
        m = active[t]
        state = (state[:m] if t == 0 else state[:m] @ step) * likely[base[:m] + t]
        state /= state.sum(axis=1, keepdims=True)
        forward[base[:m] + t] = state
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = base[:m] + t
        both = forward[at] * back[:m]
        forward[at] = both / both.sum(axis=1, keepdims=True)
        message = (likely[at] * back[:m]) @ step.T
        back[:m] = message / message.sum(axis=1, keepdims=True)
    return forward


def held_out(key: Column) -> Column:
    """Rows that never train: a quarter by the checksum of the id, and rows without one."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(True))


def sample(
    docs: DataFrame, key: str, text: str, language: str, per_language: int, most: int
) -> list[tuple[str, list[str]]]:
    """A bounded sample of labelled rows: language, and all words of the text.

    A task keeps ``per_language`` ids of each language before the shuffle. Texts are read for the
    chosen ids.
    """
    has_letter = F.col(text).rlike(r"\p{L}") & (F.length(text) <= LONGEST)
    ids = docs.where(~held_out(F.col(key)) & F.col(language).isNotNull() & has_letter).select(
        F.col(key).alias("id"), F.col(language).alias("lang")
    )
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (
        ids.withColumn("rank", F.row_number().over(by_hash))
        .where(F.col("rank") <= per_language)
        .orderBy("rank", "lang", "id")
        .limit(most)
        .select("id", "lang")
        .distinct()
    )
    # At most ``most`` rows are broadcast; of rows with one id and language the least text counts.
    found = (
        docs.where(has_letter)
        .select(F.col(key).alias("id"), F.col(language).alias("lang"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), ["id", "lang"])
        .groupBy("id", "lang")
        .agg(F.min("text").alias("text"))
        .select("id", "lang", F.regexp_extract_all("text", F.lit(r"\p{L}+"), 0).alias("words"))
    )
    return [(r.lang, r.words) for r in found.orderBy("lang", "id").collect()]


def _sequences(rows: list[tuple[str, list[str]]], seed: int = 7):
    """All stretches of all texts strung together, half of the time in another language."""
    draw = random.Random(seed)
    pool: dict[str, list[list[str]]] = {}
    for language, words in rows:
        at = 0
        while at < len(words):
            size = draw.randint(1, RUN_WORDS)
            pool.setdefault(language, []).append(words[at : at + size])
            at += size
    for stretches in pool.values():
        draw.shuffle(stretches)
    languages = sorted(pool)
    while languages:
        now, out = draw.choice(languages), []
        while languages and len(out) < SEQUENCE_RUNS:
            if now not in languages or draw.random() < 0.5:
                now = draw.choice(languages)
            out.append((now, pool[now].pop()))
            if not pool[now]:
                languages.remove(now)
        yield out


@dataclass
class Task:
    """Sequences to fit: their words' kinds, true labels, and the features of each kind."""

    texts: list[str]
    labels: list[int]
    n_labels: int

    def __post_init__(self):
        data, offsets = utf8(pa.array(self.texts))
        _, _, rows, self.kind, letters, own = word_kinds(*code_points(data, offsets))
        self.words = featurize(letters, own)
        n, k = len(rows), self.n_labels
        assert n == len(self.labels)
        self.counts = np.bincount(rows, minlength=len(self.texts))
        self.truth = np.eye(k)[self.labels]
        near = rows[1:] == rows[:-1]
        self.true_pairs = self.truth[:-1][near].T @ self.truth[1:][near]
        self.true_firsts = self.truth[np.cumsum(self.counts) - self.counts].sum(axis=0)
        features = np.concatenate([self.words.whole.ravel(), self.words.grams])
        kinds = np.arange(len(self.words.starts))
        self.owners = np.concatenate([np.repeat(kinds, 3), self.words.gram_words()])
        self.used, self.numbers = np.unique(features, return_inverse=True)

    def slopes(self, model: Model) -> list[np.ndarray]:
        """Gradient of the sum of log-likelihoods by the used weights, starts and moves."""
        scores = model.emissions(self.words)[self.kind]
        found, pairs, begins = marginals(scores, self.counts, model.start, model.moves)
        error, k = self.truth - found, self.n_labels
        kinds = len(self.words.starts)
        by_kind = np.stack([np.bincount(self.kind, error[:, c], kinds) for c in range(k)], axis=1)
        by_use = [np.bincount(self.numbers, by_kind[self.owners, c], len(self.used)) for c in range(k)]
        slope = np.stack(by_use, axis=1)
        slope[self.used == 0] = 0
        return [slope, self.true_firsts - begins, self.true_pairs - pairs]


def fit(rows: list[tuple[str, list[str]]]) -> Model | None:
    """The chain's weights by Adam on the mean log-likelihood of all sequences."""
    languages = sorted({language for language, _ in rows})
    if not languages:
        return None
    texts, labels = [], []
    for sequence in _sequences(rows):
        texts.append(" ".join(w for _, words in sequence for w in words))
        labels += [languages.index(name) for name, words in sequence for _ in words]
    task = Task(texts, labels, len(languages))
    k, n = len(languages), len(labels)
    model = Model(languages, np.zeros((2**FEATURE_BITS, k), np.float32), np.zeros(k), np.zeros((k, k)))
    moments = [[0.0, 0.0] for _ in range(3)]
    for step in range(1, ROUNDS + 1):
        found, begins, pairs = task.slopes(model)
        slopes = [
            found / n - DECAY * model.weights[task.used],
            begins / len(texts) - DECAY * model.start,
            pairs / n - DECAY * model.moves,
        ]
        moved = []
        for m, g in zip(moments, slopes, strict=True):
            m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.99 * m[1] + 0.01 * g * g
            moved.append(RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8))
        model.weights[task.used] += moved[0]
        model.weights[0] = 0
        model.start, model.moves = model.start + moved[1], model.moves + moved[2]
    return model


def train(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    per_language: int = PER_LANGUAGE,
    most: int = SAMPLE,
) -> Model | None:
    """Fit the model to a sample of the labelled rows that are not held out."""
    return fit(sample(docs, key, text, language, per_language, most))


def _spans(labels: np.ndarray, starts: np.ndarray, ends: np.ndarray, names: list[str]) -> list:
    """Stretches of one language as (first, end, language), in code points."""
    cuts = np.flatnonzero(np.diff(labels)) + 1
    begins, lasts = np.append(0, cuts), np.append(cuts, len(labels)) - 1
    return [
        {"start": int(starts[a]), "end": int(ends[b]), "lang": names[labels[a]]}
        for a, b in zip(begins, lasts, strict=True)
    ]


def predict(column: pa.Array, model: Model | None, spans: bool) -> Iterator[dict]:
    """For each row its language, score and, if asked for, its stretches."""
    all_data, all_offsets = utf8(column)
    nothing = {"lang": UNKNOWN, "score": 0.0, "spans": [] if spans else None}
    for first, last in row_blocks(all_offsets, BLOCK_BYTES):
        if model is None:
            yield from (nothing for _ in range(first, last))
            continue
        offsets = all_offsets[first : last + 1]
        codes, offsets = code_points(all_data[offsets[0] : offsets[-1]], offsets - offsets[0])
        starts, lasts, rows, kind, letters, own = word_kinds(codes, offsets)
        counts = np.bincount(rows, minlength=last - first)
        scores = model.emissions(featurize(letters, own))
        found = posteriors(scores, kind, counts, model.start, model.moves)
        ends = np.cumsum(counts)
        means = np.zeros((last - first, len(model.languages)))
        full = counts > 0
        if full.any():
            means[full] = np.add.reduceat(found, (ends - counts)[full]) / counts[full][:, None]
        best, score = means.argmax(axis=1), np.minimum(1.0, means.max(axis=1, initial=0.0))
        for row in range(last - first):
            if not counts[row]:
                yield nothing
                continue
            out = {"lang": model.languages[best[row]], "score": float(score[row]), "spans": None}
            if spans:
                span = slice(ends[row] - counts[row], ends[row])
                labels = found[span].argmax(axis=1)
                places = starts[span] - offsets[row], lasts[span] - offsets[row]
                out["spans"] = _spans(labels, *places, model.languages)
            yield out


_SPAN = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("lang", T.StringType()),
    ]
)
RESULT = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(_SPAN)),
    ]
)
_ARROW = pa.struct(
    [
        ("lang", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])),
        ),
    ]
)


def label(docs: DataFrame, model: Model | None, text: str = "text", spans: bool = False) -> DataFrame:
    """``docs`` with the struct column ``__lang(lang, score, spans)``.

    ``spans`` are the stretches of one language, from the most probable language of each
    word; they are null unless asked for.
    """
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            found = pa.array(list(predict(column, shared.value, spans)), _ARROW)
            names = [*batch.schema.names, COLUMN]
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField(COLUMN, RESULT)])
    return docs.mapInArrow(lean(run), schema)
