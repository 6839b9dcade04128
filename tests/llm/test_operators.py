"""The operators against brute force, on small tables with odd rows."""

import base64
import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edgeloom.llm import (
    arc,
    decontam,
    exact,
    html,
    jaccard,
    language,
    lines,
    pieces,
    sharding,
    textblocks,
    toxicity,
)

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, __cuts STRING, n STRING, id INT"


def table(spark, rows):
    """Documents with extra columns whose names operators may use themselves."""
    return spark.createDataFrame([(i, t, "xx", "c", "n", 1) for i, t in rows], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "délta", "ε", "zeta9", "eta.", "theta", "iota", "x"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "ONE two"), (7, "one two")]
    base = [draw.choice(words) + str(draw.randint(0, 40)) for _ in range(120)]
    for i in range(8, 40):
        copy = list(base)
        for _ in range(draw.randint(0, 6)):
            copy[draw.randrange(len(copy))] = "new" + str(draw.randint(0, 10**6))
        rows.append((i, " ".join(copy)))
    rows += [(i, " ".join(draw.choice(words) for _ in range(draw.randint(1, 60)))) for i in range(40, 70)]
    rows += [(70, "long " * 30_000), (70, "long " * 30_000), (None, "one two"), (None, None), (71, rows[8][1])]
    return rows


# ------------------------------------------------------------------ sharding


def jump_by_hand(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 16, 100, 1000])
def test_jump_equals_the_published_loop(spark, n):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), *random.Random(1).sample(range(10**12), 300)]
    df = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    for k, found in df.select("k", sharding.jump(F.col("k"), n)).collect():
        assert (found.shard, found.grown) == (jump_by_hand(k, n), jump_by_hand(k, n + 1))


def test_shards_have_gapless_slots(spark, odd_rows):
    rows = sharding.with_slots(
        sharding.shards(table(spark, odd_rows), 4), "shard", ["doc_id", "size", "text_crc32"]
    ).collect()
    assert len(rows) == len(odd_rows)
    for shard in range(4):
        own = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        ids = [(r.doc_id is not None, r.doc_id or 0) for r in own]
        assert ids == sorted(ids)
    assert all(r.grown_shard in (r.shard, 4) for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (1, 2)} == {1}
    assert sharding.with_slots(sharding.shards(table(spark, []), 4), "shard", ["doc_id"]).count() == 0


# ---------------------------------------------------------------- line dedup


def test_line_dedup_equals_brute_force(spark):
    draw = random.Random(5)
    shared = [f"  Shared LINE number {i} " + "é" * 30 + "\t" for i in range(6)]
    rows = [
        (i, "\n".join(draw.choice(shared + ["short", "", f"own line of {i} " * 4]) for _ in range(draw.randint(1, 9))))
        for i in range(40)
    ]
    rows += [(100, None), (101, ""), (None, shared[0]), (7, shared[1]), (7, shared[1]), (102, (shared[2] + "\n") * 5000)]

    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    held = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 40:
                held[key(line)].add(i)
    bad = {k: max(v) for k, v in held.items() if len(v) >= 5}
    want = []
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if i is None or bad.get(key(x), i) == i]
        want.append((str(i), "\n".join(kept), len(own), len(own) - len(kept)))
    found = lines.dedup_lines(table(spark, rows))
    assert found.columns[:-1] == table(spark, rows).columns
    got = [
        (str(r.doc_id), r.text, r["__lines"].n_lines, r["__lines"].n_dropped)
        for r in found.drop("n").collect()
    ]
    assert sorted(got) == sorted(want)
    assert bad and lines.dedup_lines(table(spark, [])).count() == 0


# --------------------------------------------------------------- exact dedup


@pytest.mark.parametrize("rows_per_stripe", [2, 2**15])
def test_exact_dedup_equals_brute_force(spark, odd_rows, monkeypatch, rows_per_stripe):
    monkeypatch.setattr(exact, "ROWS_PER_STRIPE", rows_per_stripe)
    rows = [*odd_rows, (80, "lo ng" * 30_000), (81, "long" * 30_000 + "x")]
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i or 0))
    got = exact.dedup_exact(table(spark, rows), first_bytes=2, growth=3).collect()
    assert len(got) == len(rows)
    by_digest = collections.defaultdict(list)
    for r in got:
        by_digest[r.text_sha256].append(r)
    for text, members in groups.items():
        own = by_digest.pop(hashlib.sha256(text.encode()).hexdigest())
        best = min(members)
        assert len(own) == len(members) and sum(r.kept for r in own) == 1
        assert {(r.keep_id, r.group_size) for r in own} == {(None if best[1] else best[2], len(members))}
        assert next(r for r in own if r.kept).doc_id == own[0].keep_id
    assert not by_digest
    assert exact.dedup_exact(table(spark, [])).count() == 0


# -------------------------------------------------------------- Jaccard join


def components_by_hand(rows, size, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        own = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}
        sets.append(own if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).extend([i] if i is not None else [])
    return [(i, len(sets[k]), min(least[find(k)], default=None)) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize(("size", "percent", "orders"), [(4, 85, 2), (2, 60, 3), (5, 80, 1)])
def test_near_duplicates_equal_brute_force(spark, odd_rows, size, percent, orders):
    got = jaccard.near_duplicates(
        table(spark, odd_rows), size=size, percent=percent, orders=orders, bucket_bits=8
    )
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, components_by_hand(odd_rows, size, percent))
    )


def test_other_ways_beyond_the_size_checks_find_the_same(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard, "HOT_BITS", 1)
    got = jaccard.near_duplicates(table(spark, odd_rows), size=4, percent=85, bucket_bits=8).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, components_by_hand(odd_rows, 4, 85)))


def test_pipeline_keeps_one_row_of_each_component(spark):
    import corpus_pipeline

    near, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(None, near), (4, near + " end"), (2, near), (2, near), (2, other), (None, "a b c d e f g h")]
    rows += [(None, "a b c d e f g h"), (9, ""), (None, None)]
    docs = table(spark, rows).repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    wanted = [(2, near), (2, other), (None, "a b c d e f g h"), (9, ""), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(wanted, key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").count() == 0


def test_near_duplicates_of_an_empty_table(spark):
    assert jaccard.near_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("scale", [3, 300, 80_000])
def test_sketches_rule_out_no_link(scale):
    rng = np.random.default_rng(scale)
    known = rng.integers(0, 2**63, 2 * scale, dtype=np.uint64)
    sets = [np.unique(rng.choice(known, scale * 3 // 2)) for _ in range(12)]
    sets += [np.unique(np.append(s[:-1], known[:1])) for s in sets] + sets[:2]
    pairs = list(itertools.combinations(range(len(sets)), 2))
    marks = [pa.scalar(jaccard.sketch(s), pa.binary()).as_py() for s in sets]
    columns = [
        pa.array([a for a, _ in pairs]),
        pa.array([b for _, b in pairs]),
        pa.array([len(sets[a]) + len(sets[b]) for a, b in pairs]),
        pa.array([marks[a] for a, _ in pairs]),
        pa.array([marks[b] for _, b in pairs]),
    ]
    batch = pa.RecordBatch.from_arrays(columns, names=["a", "b", "total", "left", "right"])
    (kept,) = jaccard._possible(85)([batch])
    kept = set(zip(*(c.to_pylist() for c in kept.columns)))
    for a, b in pairs:
        both = len(np.intersect1d(sets[a], sets[b]))
        total = len(np.union1d(sets[a], sets[b]))
        assert (a, b) in kept or 100 * both < 85 * total


# ----------------------------------------------------------- decontamination

BENCH = [
    (1, " ".join(f"Bench{k}" for k in range(14))),
    (2, "alpha beta, gamma"),
    (3, None),
    (10, " ".join(f"bench{k}" for k in range(12))),
    (None, "only here now"),
]


def hits_by_hand(text, size=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, hit, items = pattern.findall(lower(text)), set(), set()
    for item, bench in BENCH:
        own = pattern.findall(lower(bench))
        n = min(size, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == own[k : k + n]:
                    hit.update(range(at, at + n))
                    items.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(items)


@pytest.mark.parametrize("slice_bytes", [2**20, 30])
def test_contamination_equals_brute_force(spark, odd_rows, slice_bytes):
    rows = [
        *odd_rows,
        (90, "before " + BENCH[0][1].upper() + " behind"),
        (91, " - ".join(f"bench{k}" for k in range(2, 13)) + " alpha? Beta gamma"),
        (92, "Only here, now"),
        (93, " ".join(f"bench{k}" for k in range(9))),
    ]
    bench = spark.createDataFrame(BENCH, "item_id BIGINT, text STRING")
    got = decontam.contamination(table(spark, rows), bench, slice_bytes=slice_bytes).collect()
    want = [(i, *hits_by_hand(t)) for i, t in rows]
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in got) == sorted(map(str, want))
    kept = decontam.drop_documents(table(spark, rows), bench, slice_bytes=slice_bytes)
    assert kept.columns == table(spark, rows).columns
    assert kept.count() == sum(not w[2] for w in want)
    cut = {r.doc_id: r.text for r in decontam.drop_spans(table(spark, rows), bench).collect()}
    assert (cut[90], cut[92], cut[1]) == ("before  behind", "", None)
    assert decontam.contamination(table(spark, []), bench).count() == 0
    assert decontam.contamination(table(spark, rows), bench.limit(0)).where("contaminated").count() == 0


def test_window_table_is_flat_and_small():
    draw = random.Random(9)
    items = [(str(i), " ".join(f"{draw.choice('abc')}ord{draw.randint(0, 9**4)}" for _ in range(300))) for i in range(300)]
    items += [("r", "same words again " * 20_000), ("s", "two words"), ("t", "two words"), ("u", ""), ("v", "é")]
    windows = decontam.Windows(items, 10)
    assert windows.nbytes < 6 * sum(len(text.encode()) for _, text in items)
    text = pa.array(["same words again " * 5, "x two  WORDS, É", None])
    assert [(n, h, i) for n, h, i in decontam._scan(text, windows)] == [
        (15, [[0, 15]], ["r"]), (4, [[1, 3]], ["s", "t"]), (0, [], []),
    ]


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontam, "window_hashes", lambda w, r, n: _one_hash(textblocks.window_hashes(w, r, n)))
    windows = decontam.Windows([("1", "a b c"), ("2", "b c d a b"), ("3", "a b c"), ("4", "c c c c")], 3)
    text = pa.array(["A b c", "b c d", "c c c", "d a x", "a b c d a b"])
    found = [(h, i) for _, h, i in decontam._scan(text, windows)]
    assert found == [
        ([[0, 3]], ["1", "3"]), ([[0, 3]], ["2"]), ([[0, 3]], ["4"]), ([], []), ([[0, 6]], ["1", "2", "3"]),
    ]


def _one_hash(found):
    return np.full(len(found[0]), 7, np.uint64), found[1]


# --------------------------------------------------------------- language ID


def test_forward_backward_equals_enumeration():
    draw = np.random.default_rng(2)
    scores, start, moves = draw.normal(size=(9, 3)), draw.normal(size=3), draw.normal(size=(3, 3))
    counts = np.array([4, 0, 5])
    found, pairs, _ = language.marginals(scores, counts, start, moves)
    expected_pairs = np.zeros((3, 3))
    for base, n in ((0, 4), (4, 5)):
        total, mass, both = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=n):
            logs = start[path[0]] + sum(scores[base + t, s] for t, s in enumerate(path))
            p = np.exp(logs + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += p
            for t, s in enumerate(path):
                mass[t, s] += p
            for a, b in zip(path, path[1:]):
                both[a, b] += p
        np.testing.assert_allclose(found[base : base + n], mass / total, rtol=1e-9)
        expected_pairs += both / total
    np.testing.assert_allclose(pairs, expected_pairs, rtol=1e-9)


def test_segments_give_the_same_posteriors(monkeypatch):
    draw = np.random.default_rng(5)
    counts = np.array([0, 1, 700, 63, 64, 65, 0, 128, 129, 3])
    scores, kind = 4 * draw.normal(size=(40, 4)), draw.integers(0, 40, counts.sum())
    start, moves = draw.normal(size=4), 2 * draw.normal(size=(4, 4))
    want, _, _ = language.marginals(scores[kind], counts, start, moves)
    for segment in (1, 2, 7, 64, 1000):
        monkeypatch.setattr(language, "SEGMENT", segment)
        got = language.posteriors(scores, kind, counts, start, moves)
        np.testing.assert_allclose(got, want, rtol=1e-7, atol=1e-12)
    assert language.posteriors(scores, kind[:0], counts * 0, start, moves).shape == (0, 4)


def test_gradient_equals_finite_differences():
    texts, labels = ["ab cab dé ab", "cab x"], [0, 1, 1, 0, 1, 0]
    task = language.Task(texts, labels, 2)
    draw = np.random.default_rng(6)
    k = 2

    def model_at(theta):
        weights = np.zeros((2**language.FEATURE_BITS, k))
        weights[task.used] = theta[: len(task.used) * k].reshape(-1, k)
        weights[0] = 0
        rest = theta[len(task.used) * k :]
        return language.Model(["a", "b"], weights, rest[:k], rest[k:].reshape(k, k))

    def likelihood(theta):
        model, total, at = model_at(theta), 0.0, 0
        scores = model.emissions(task.words)[task.kind]
        for n in task.counts:
            own, truth = scores[at : at + n], labels[at : at + n]

            def log(path):
                moved = sum(model.moves[a, b] for a, b in zip(path, path[1:]))
                return model.start[path[0]] + moved + sum(own[t, c] for t, c in enumerate(path))

            total += log(truth) - np.log(sum(np.exp(log(p)) for p in itertools.product(range(k), repeat=int(n))))
            at += n
        return total

    theta = 0.3 * draw.normal(size=len(task.used) * k + k + k * k)
    slopes = task.slopes(model_at(theta))
    got = np.concatenate([x.ravel() for x in slopes])
    for i in draw.choice(len(theta), 40, replace=False).tolist() + list(range(len(theta) - 6, len(theta))):
        step = np.zeros(len(theta))
        step[i] = 1e-5
        near = (likelihood(theta + step) - likelihood(theta - step)) / 2e-5
        assert abs(near - got[i]) < 1e-6


def test_sample_is_of_rows_and_leaves_texts_whole(spark):
    draw = random.Random(8)
    rows = [(i, None if i % 3 == 0 else "12 !" if i % 3 == 1 else f"Word{i} " * draw.randint(1, 90)) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "de") for i, t in rows], "doc_id BIGINT, text STRING, lang STRING")
    found = language.sample(docs, "doc_id", "text", "lang", 10, 100)
    assert [lang for lang, _ in found] == ["de"] * 10 + ["en"] * 10
    whole = {tuple(re.findall(r"[^\W\d_]+", t or "")) for _, t in rows}
    assert all(tuple(words) in whole for _, words in found)
    trained = [w for sequence in language._sequences(found) for _, words in sequence for w in words]
    assert sorted(trained) == sorted(w for _, words in found for w in words)


def test_held_out_documents_and_code_switches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs)
    found = language.label(docs.select("doc_id", "text"), model)
    rows = (
        found.join(docs.select("doc_id", "lang"), "doc_id")
        .where(language.held_out(F.col("doc_id")))
        .select("lang", F.col("__lang.lang").alias("pred"), "__lang.score")
        .collect()
    )
    assert sum(r.lang == r.pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    texts = dict(docs.where("length(text) BETWEEN 200 AND 900").groupBy("lang").agg(F.min("text")).collect())
    both = texts["de"] + " \n" + texts["es"]
    odd = [(1, None), (2, ""), (3, "12 -- 7"), (4, both), (4, both), (5, "that " * 20_000)]
    got = language.label(table(spark, odd), model, spans=True).collect()
    assert [r["__lang"].lang for r in got][:3] == ["und"] * 3
    assert [r["__lang"].score for r in got][:3] == [0.0] * 3
    assert got[3]["__lang"] == got[4]["__lang"]
    spans = got[3]["__lang"].spans
    assert {"de", "es"} <= {s.lang for s in spans}
    in_second = sum(s.end - s.start for s in spans if s.lang == "es" and s.start >= len(texts["de"]))
    assert in_second > 0.8 * len(texts["es"])
    assert language.label(table(spark, []), model).count() == 0
    assert language.train(docs.limit(0)) is None
    assert language.label(table(spark, odd), None).first()["__lang"].lang == "und"


# -------------------------------------------------------------------- pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def test_samples_follow_the_exact_distribution(vocabulary):
    text = "there"
    codes = np.array([pieces.BLANK, *map(ord, text)])
    rank = {vocabulary.pieces[i]: (i + 1.0) ** -1.0 for i in vocabulary.plain}
    whole, weights = "".join(map(chr, codes)), {}
    for cuts in itertools.product([0, 1], repeat=len(whole) - 1):
        at = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(whole)]
        parts = tuple(whole[a:b] for a, b in zip(at, at[1:]))
        if all(p in rank for p in parts):
            weights[parts] = np.prod([rank[p] for p in parts])
    total, n = sum(weights.values()), 20_000
    offsets = np.arange(n + 1) * len(codes)
    ids, ends = pieces.sample_ids(np.tile(codes, n), offsets, np.arange(n).astype(np.uint64), vocabulary)
    drawn = collections.Counter(
        tuple(vocabulary.pieces[i] for i in ids[a:b]) for a, b in zip(ends, ends[1:])
    )
    assert set(drawn) <= set(weights)
    for parts, weight in weights.items():
        p = weight / total
        assert abs(drawn[parts] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_any_text_comes_back(spark, odd_rows, vocabulary):
    odd = ["▁", " ▁ ▁", "  two  blanks ", "<s> <0x41> </s>", "a\n\n\tb\r\n", "漢字と🙂🙂", "é́", "x" * 5000]
    rows = [*odd_rows, *((200 + i, t) for i, t in enumerate(odd))]
    encoded = pieces.encode(table(spark, rows), vocabulary)
    decoded = pieces.decode(encoded, vocabulary).select("doc_id", "text", "decoded", "__ids").collect()
    assert len(decoded) == len(rows)
    assert all(r.text == r.decoded for r in decoded)
    assert {r.doc_id: r["__ids"] for r in decoded}[1] is None
    assert {r.doc_id: r["__ids"] for r in decoded}[2] == []
    same = [r["__ids"] for r in decoded if r.doc_id == 70]
    assert same[0] == same[1]
    again = pieces.encode(table(spark, rows).repartition(5), vocabulary).select("doc_id", "__ids").collect()
    assert sorted(map(str, ((r.doc_id, r["__ids"]) for r in again))) == sorted(
        map(str, ((r.doc_id, r["__ids"]) for r in decoded))
    )
    other = pieces.encode(table(spark, rows), vocabulary, seed=1).where("doc_id = 8").first()["__ids"]
    assert other != {r.doc_id: r["__ids"] for r in decoded}[8]
    assert pieces.encode(table(spark, []), vocabulary).count() == 0


def test_texts_pass_through_python_by_short_batches(spark, vocabulary):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    texts = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.lit("one two " * 500).alias("text"))
    set_by_user = spark.conf.get(textblocks.BATCH_SETTING, None)
    try:
        for wanted, most in ((None, textblocks.BATCH_BYTES), ("16m", 2**24)):
            spark.conf.unset(textblocks.BATCH_SETTING)
            if wanted:
                spark.conf.set(textblocks.BATCH_SETTING, wanted)
            encoded = pieces.encode(texts, vocabulary)
            assert 0.5 * most < max(r.bytes for r in encoded.mapInArrow(sizes, "bytes bigint").collect()) < 1.1 * most
    finally:
        spark.conf.unset(textblocks.BATCH_SETTING)
        if set_by_user:
            spark.conf.set(textblocks.BATCH_SETTING, set_by_user)


def test_pieces_are_decoded_by_blocks(vocabulary):
    texts = [None, "", *(f"text {i} " * 200 for i in range(600)), None]
    arrays = list(pieces.encode_column(pa.array(texts), pa.array(range(len(texts))), vocabulary))
    whole = pa.concat_arrays(arrays)
    for start in (0, 7):
        found = list(pieces.decode_column(whole.slice(start), vocabulary))
        assert len(found) > 2 and max(len(f) for f in found) < 400
        assert pa.concat_arrays(found).to_pylist() == texts[start:]
    assert not list(pieces.decode_column(whole.slice(0, 0), vocabulary))


# ------------------------------------------------------------------ toxicity


def test_chain_finds_planted_categories(spark):
    draw = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        text = [draw.choice(words) for _ in range(draw.randint(5, 60))]
        rude, threat = i % 4 == 0, i % 8 == 0
        text += ["Scum"] * rude + ["hurt", "you"] * threat
        draw.shuffle(text)
        rows.append((i, " ".join(text)))
        if i < 900:
            labels.append((i, int(rude), int(threat)))
    labels += [(5000, 1, 1), (None, 1, 1), (3, None, 1)]
    known = spark.createDataFrame(labels, "doc_id BIGINT, rude INT, threat INT")
    rows += [(2000, None), (2001, ""), (2002, "SCUM!!! " * 3), (2002, "SCUM!!! " * 3)]
    docs = table(spark, rows)
    chain = toxicity.train(docs, known, ["rude", "threat"], most=700)
    got = [(r.doc_id, r["__toxicity"]) for r in toxicity.score(docs, chain).collect()]
    assert len(got) == len(rows)
    new = [(i, t) for i, t in got if 900 <= i < 1200]
    assert sum(t.rude == (i % 4 == 0) and t.threat == (i % 8 == 0) for i, t in new) >= 0.98 * len(new)
    last = [t for i, t in got if i >= 2000]
    assert [t.rude for t in last] == [False, False, True, True]
    none = toxicity.train(docs, known.limit(0), ["rude", "threat"])
    assert not toxicity.score(docs, none).first()["__toxicity"].rude


def test_training_rows_have_a_bound_in_characters(spark):
    rows = [(i, f"word{i} " * (20_000 if i % 10 == 0 else 20)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id BIGINT, bad INT")
    texts = table(spark, [*rows, (7, "again"), (3, None)])
    words, truth = toxicity.training_rows(texts, labels, ["bad"], "doc_id", "text", 8000, 10**9)
    assert len(words) == 202 and truth.shape == (202, 1)
    some, _ = toxicity.training_rows(texts, labels, ["bad"], "doc_id", "text", 8000, 400_000)
    assert 5 < len(some) < 60
    names = {tuple(w.tolist()) for w in words}
    assert all(tuple(w.tolist()) in names for w in some)  # whole texts


def test_rare_forms_of_a_second_language_are_found(spark):
    draw = random.Random(12)
    parts = ["ka", "lo", "mi", "tu", "re", "sa", "no", "vé", "di", "po"]
    word = {"a": lambda: f"w{draw.randrange(300)}", "b": lambda: "".join(draw.choices(parts, k=4))}
    rows, labels, wanted = [], [], set()
    for i in range(1600):
        lang, rude = "b" if i % 8 < 2 else "a", i % 16 in (1, 2)
        text = [word[lang]() for _ in range(draw.randint(20, 60))]
        if rude:  # in b one of 1,000 forms, each in a handful of texts at most
            text += ["scum"] if lang == "a" else [f"ébo{''.join(draw.choices(parts, k=3))}" for _ in range(3)]
        rows.append((i, " ".join(text)))
        if i < 1200:
            labels.append((i, int(rude)))
        elif rude:
            wanted.add(i)
    docs = table(spark, rows)
    chain = toxicity.train(docs, spark.createDataFrame(labels, "doc_id BIGINT, rude INT"), ["rude"])
    found = toxicity.score(docs.where("doc_id >= 1200"), chain).where(f"{toxicity.COLUMN}.rude")
    got = {r.doc_id for r in found.collect()}
    second = {i for i in wanted if i % 8 < 2}
    assert len(got & second) >= 0.9 * len(second) and len(got & wanted) >= 0.9 * len(got)


# ------------------------------------------------------------------- archives

PAGES = "page_id BIGINT, url STRING, html STRING, digest STRING, name STRING"


def test_pages_come_back_through_archives(spark, monkeypatch):
    monkeypatch.setattr(arc, "ARC_BYTES", 2000)
    rows = [(i, f"http://x.org/{i} a", f"<p>é {i % 7}</p>\r\n\r\nWARC/1.1\r\n" * (i % 5)) for i in range(60)]
    rows += [(70, None, None), (71, "", ""), (None, "http://n.org/", "<p>é 1</p>"), (5, "http://y", "again")]
    rows += [(72, "http://long", "0123456789\n" * 20_000), (5, "http://y", "again")]
    pages = spark.createDataFrame([(*r, "d", "n") for r in rows], PAGES).repartition(3)
    got = arc.pages_through_archives(pages).collect()
    assert len(got) == len(rows)
    groups = collections.defaultdict(list)
    for i, _, text in rows:
        groups[(text or "").encode()].append(i)
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        own = [r for r in got if r.payload_digest == digest]
        assert sorted(map(str, ids)) == sorted(str(r.page_id) for r in own)
        assert {r.payload_bytes for r in own} == {len(payload)}
        first = [r for r in own if r.record_type == "response"]
        least = min((i for i in ids if i is not None), default=None)
        assert [r.page_id for r in first] == [least] and first[0].payload == payload
        others = [r for r in own if r.record_type == "revisit"]
        assert len(others) == len(own) - 1
        assert {(r.refers_to, r.refers_to_record) for r in others} <= {(least, first[0].record_id)}
    kept = arc.pages_through_archives(pages, min_bytes=100).where("payload_bytes < 100")
    assert {r.record_type for r in kept.collect()} == {"response"}
    assert arc.pages_through_archives(pages.limit(0)).count() == 0


def test_both_versions_and_damaged_files():
    for version, tail in ((1, ""), (2, " 200 - - 0 f.arc")):
        start = arc._arc_start("f.arc", version)
        body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\nhello\nworld"
        line = f"\nhttp://a/ 1.2.3.4 19990102030405 text/html{tail} {len(body)}\n".encode()
        first, doc = arc.read_arc(start + line + body)
        assert first.fields["URL"] == "filedesc://f.arc" and not doc.cut
        assert (doc.payload, doc.page_id, doc.offset) == (b"hello\nworld", 4, len(start) + 1)
        ((fields, block),) = arc.read_warc(arc.convert(doc, "f.arc"))
        assert (fields["WARC-Type"], fields["WARC-Date"]) == ("response", "1999-01-02T03:04:05Z")
        assert fields["WARC-Payload-Digest"] == "sha1:" + arc.base32_sha1(b"hello\nworld") and block == body
        *_, short = arc.read_arc(start + line + body[:-3])
        assert short.cut and b"WARC-Truncated: length" in arc.convert(short, "f.arc")
        *_, reject = arc.read_arc(start + line + body + b"\nno header\nrest")
        assert reject.error == "header line"
    dns = arc.Document(9, {"URL": "dns:a", "Archive-date": "20010101", "Content-type": "text/dns"}, b"x")
    assert b"WARC-Type: resource" in arc.convert(dns, "f") and b"2001-01-01T00:00:00Z" in arc.convert(dns, "f")


def test_files_without_version_block_and_urls_with_blanks():
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    line = f"http://a/b c 1.2.3.4 19990102030405 text/html {len(body)}\n".encode()
    (reject,) = arc.read_arc(line + body)
    assert reject.error == "no version block" and reject.block == line + body
    for block in (b"1 0 x", b"1 0 x\n"):
        start = f"filedesc://f 0.0.0.0 20080101000000 text/plain {len(block)}\n".encode() + block
        first, one, two = arc.read_arc(start + (b"\n" + line + body) * 2)
        assert one.fields["URL"] == two.fields["URL"] == "http://a/b c" and not one.error
        assert one.payload == two.payload == b"hello" and arc.convert(first, "f")
        assert b"WARC-Target-URI: http://a/b%20c\r\n" in arc.convert(two, "f")


def archive(payloads, version=1, date="19990102030405"):
    start = arc._arc_start("x.arc", version)
    tail = {1: "text/html", 2: "text/html 200 - - 0 x.arc"}[version]
    out = [start]
    for i, payload in enumerate(payloads):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
        out.append(f"\nhttp://a/{i} 1.2.3.4 {date} {tail} {len(block)}\n".encode() + block)
    return out


def test_any_legacy_file_is_converted(spark, tmp_path):
    import gzip

    kinds = {
        "one/part-1.arc": b"".join(archive([b"hello", b"alpha"])),
        "two/part-1.arc": b"".join(archive([b"world", b"alpha"], 2)),
        "three/part-1.arc": b"".join(archive([b"gamma", b""])),
        "three/IAH-2008.arc.gz": b"".join(gzip.compress(x) for x in archive([b"delta", b"hello"], 2)),
        "three/old": b"".join(archive([b"no date"], date="-")),
        "three/cut.arc.gz": b"".join(gzip.compress(x) for x in archive([b"zeta", b"eta"]))[:-9],
        "three/other.bin": b"not an archive",
        "three/_marker": b"",
    }
    for name, content in kinds.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    source, out = f"file://{tmp_path}/{{one,two,three}}", str(tmp_path / "warc")
    rejects = arc.arc_to_warc(spark, source, out).collect()
    assert sorted((r.name.rpartition("/")[2], r.error) for r in rejects) == [
        ("cut.arc.gz", "gzip member"), ("old", "date"), ("other.bin", "no version block"),
    ]
    rows = arc.warc_records(spark, out).collect()
    whole = [b"hello", b"alpha", b"world", b"gamma", b"", b"delta", b"zeta"]
    assert len({r.record_id for r in rows}) == len(rows)
    first = {r.payload_digest: r for r in rows if r.record_type == "response"}
    assert {arc.base32_sha1(p) for p in whole} <= set(first)
    again = [r for r in rows if r.record_type == "revisit"]
    assert sorted(r.payload_digest for r in again) == sorted(arc.base32_sha1(p) for p in (b"alpha", b"hello"))
    assert all(first[r.payload_digest].record_id == r.refers_to_record for r in again)
    documents = [d for n, c in kinds.items() for d in arc.read_arc(c)]
    info = [d for d in documents if not d.error and d.fields["URL"].startswith("filedesc:")]
    assert len(rows) + len(rejects) + len(info) == len(documents)


@pytest.mark.parametrize(
    ("date", "want"),
    [
        ("19990102030405", "1999-01-02T03:04:05Z"),
        ("19990102030405123", "1999-01-02T03:04:05Z"),
        ("1999", "1999-01-01T00:00:00Z"),
        ("199912", "1999-12-01T00:00:00Z"),
        ("19991", "1999-01-01T00:00:00Z"),
        ("", None),
        ("-", None),
        ("19991302", None),
        ("00000101", None),
    ],
)
def test_dates(date, want):
    assert arc.iso_date(date) == want


def test_warc_files_of_other_versions():
    def record(version, body=b"x"):
        return b"WARC/%s\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (version, len(body), body)

    found = list(arc.read_warc(record(b"1.0") + record(b"0.18", b"yz") + record(b"1.1")))
    assert [block for _, block in found] == [b"x", b"yz", b"x"]
    for bad in (b"junk", record(b"1.0") + b"junk", record(b"1.0")[:-6], b"WARC/1.0\r\n"):
        with pytest.raises(ValueError):
            list(arc.read_warc(bad))


# ----------------------------------------------------------------------- HTML


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("no markup &amp; 1 &lt; 2", "no markup & 1 < 2"),
        (
            "<head><title>T</title><style>p{}</style></head><body><nav><a>menu, a, b, c, d</a></nav>"
            "<div class='ad'>Buy this, now, it is good.</div><article><header><h1>Head</h1></header>"
            "<p>One.<p><b>Two\n  words<br><p>A&amp;B &copy;</p><section class='comments'><p>First, reader!"
            "</p></section><script>var t='</p>';</script></article><footer>&copy; us, all rights.</footer>",
            "Head\nOne.\nTwo words\nA&B ©",
        ),
        (
            "<body><header>Site, of things</header><div id=content><h2>Title</h2><p>A long enough, first "
            "paragraph.</p><p>And another one, as long.</p></div><div class=sidebar><p>Links, more links, all "
            "links.</p></div><form><label>Name, please</label></form></body>",
            "Title\nA long enough, first paragraph.\nAnd another one, as long.",
        ),
    ],
)
def test_main_text(page, want):
    assert html.main_text(page) == want


def test_main_text_of_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = html.extract(pages).collect()
    from html import unescape

    for r in rows:
        inside = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        blocks = re.split(r"</?(?:p|h1)>", inside.replace("<b>", "").replace("<br>", " "))
        texts = (" ".join(unescape(b).split()) for b in blocks)
        assert r["__main_text"] == "\n".join(t for t in texts if t)
    assert html.extract(pages.limit(0)).count() == 0


# ----------------------------------------------------------------- text blocks


BODY = [" ".join(["Words of the body, long enough to be text."] * n) for n in (4, 5, 3)]
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in BODY)
CARDS = "<article class=card><h3>Tease</h3><p>More, short.</p></article>" * 3


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<body><nav><a>m, n</a></nav><div><h1>T</h1>{PARAGRAPHS}</div>{CARDS}</body>", ["T", *BODY]),
        (f"<body><main><h1>T</h1>{PARAGRAPHS}{CARDS}</main></body>", ["T", *BODY]),
        (f"<body><main><h1>T</h1><article>{PARAGRAPHS}</article></main></body>", ["T", *BODY]),
        (f"<body><div>{PARAGRAPHS}</div><article><p>{BODY[1]}</p></article></body>", [*BODY, BODY[1]]),
        (f"<body><article>{PARAGRAPHS}</article><div>One line.</div></body>", BODY),
        (f"<body><article>{PARAGRAPHS}<div>{'<span>x</span>' * 60}</div></article></body>", [*BODY, "x" * 60]),
        (f"<body><div>{PARAGRAPHS}<p>Yes.</p></div><div>{'<a>a</a>' * 60}</div></body>", [*BODY, "Yes."]),
        (f"<body>{f'<article><h2>P</h2><p>{BODY[0]}</p></article>' * 2}</body>", ["P", BODY[0]] * 2),
    ],
)
def test_paths_pick_the_nodes_on_every_page(page, want):
    assert html.main_text(page) == "\n".join(want)


ITEMS = [f"item {i}" for i in range(40)]
CELLS = [f"c{i}" for i in range(30)]
LIST = "<ul>" + "".join(f"<li>{x}</li>" for x in ITEMS) + "</ul>"
TABLE = "<table><caption>Cap</caption>" + "".join(f"<tr><td>{x}</td></tr>" for x in CELLS) + "</table>"
MORE = "<blockquote>Quote</blockquote><figure><img><figcaption>Fig</figcaption></figure><pre>a  b\nc</pre>"
KINDS = ["Quote", "Fig", "a b c"]


@pytest.mark.parametrize("around", ["article", "main", "div", "section"])
def test_no_block_of_the_article_is_lost(around):
    page = f"<body><nav><a>m</a></nav><{around}>{PARAGRAPHS}{LIST}{TABLE}{MORE}</{around}><footer>f</footer></body>"
    assert html.main_text(page) == "\n".join([*BODY, *ITEMS, "Cap", *CELLS, *KINDS])


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article><div id='market-share'>{PARAGRAPHS}</div><p class=grid-search>g</p></article>", [*BODY, "g"]),
        (f"<article>{PARAGRAPHS}<div class='share'>{PARAGRAPHS}</div><div class=share>Tell all</div></article>", BODY * 2),
        (f"<article>{PARAGRAPHS}<div class='comment-list'>{PARAGRAPHS}</div></article>", BODY),
        (f"<article>{PARAGRAPHS}<div class='site-nav x'>a, b</div><div class='ads'>{BODY[0]}</div></article>", BODY),
        (f"<body><form action=x><div>{PARAGRAPHS}<label>Your name</label><input></div></form></body>", BODY),
        (f"<article>{PARAGRAPHS}<form><p>Your name</p><button>Go</button></form></article>", BODY),
        (f"<article>{PARAGRAPHS}<ul>{'<li><a href=x>Other page</a></li>' * 9}</ul></article>", BODY),
        (f"<article>{PARAGRAPHS}<p><a href=x>One link.</a></p></article>", [*BODY, "One link."]),
        (f"<div><p>{BODY[0]}</p>{LIST}</div>", [BODY[0], *ITEMS]),
        (f"<article>{PARAGRAPHS}<![foo[ bar ]]><p>x</p><![ foo ]><![CDATA[c]]></article>", [*BODY, "x"]),
        (f"<!DOCTYPE html [<!ENTITY a 'b'> ]><article>{PARAGRAPHS}</article><![", BODY),
        (f"<?xml version='1'?><article>{PARAGRAPHS}<!-- open <p>gone</p></article>", BODY),
        (f"<!DOCTYPE x><!><!-><!--><article>{PARAGRAPHS}<!---><!-- a --!>b<?pi</article>", [*BODY, "b"]),
        (f"<article>{PARAGRAPHS}<script>var x = '<p>no</p>'", BODY),
        ("<p", ""),
        ("a &#xD800; &#0; &bogus; &amp b", "a \ufffd \ufffd &bogus; & b"),
    ],
)
def test_odd_markup_names_and_forms(page, want):
    assert html.main_text(page) == ("\n".join(want) if isinstance(want, list) else want)


def test_deep_pages_take_memory_in_proportion():
    import time
    import tracemalloc

    def peak(n, tag):
        tracemalloc.start()
        began = time.process_time()
        text = html.main_text(f"<{tag}>t " * n + "</q>" * n)
        used = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert text.split() == ["t"] * (0 if tag == "form" else n)  # forms without prose
        return used, time.process_time() - began

    for tag in ("font", "form", "article"):
        small, large = peak(5_000, tag), peak(50_000, tag)
        assert large[0] < 14 * small[0] and large[1] < 40 * small[1] + 1, tag
        assert large[0] < 100e6
    assert html.main_text("<font>t " * 100_000).split() == ["t"] * 100_000


def paths_by_hand(nodes):
    """The published ratios, node by node."""
    rows = [(n.element.path, len(n.text.strip()), sum(not (c.isalnum() or c == "_" or c.isspace()) for c in n.text), bool(n.element.article)) for n in nodes]

    def mean(path, i):
        own = [r[i] for r in rows if r[0] == path]
        return sum(own) / len(own)

    def smooth(i, k):
        near = [(j, np.exp(-((i - j) ** 2) / (2 * html.SIGMA**2))) for j in range(i - 3, i + 4) if 0 <= j < len(rows)]
        return sum(mean(rows[j][0], k) * w for j, w in near) / sum(w for _, w in near)

    score = [smooth(i, 1) * (1 + smooth(i, 2)) for i in range(len(rows))]
    level = sum(s * r[1] for s, r in zip(score, rows)) / sum(r[1] for r in rows)
    out = set()
    for path in {r[0] for r in rows}:
        own = [s for s, r in zip(score, rows) if r[0] == path]
        inside = any(r[3] for r in rows if r[0] == path)
        if sum(own) / len(own) >= level * (html.ARTICLE_SHARE if inside else html.SHARE):
            out.add(path)
    return out


def test_path_scores_equal_brute_force():
    draw = random.Random(4)
    for _ in range(20):
        tags = draw.choices(["p", "li", "td", "b", "h2", "article", "div", "a"], k=40)
        page = "".join(f"<{t}>{draw.choice(['', 'x', *BODY])}" + (f"</{t}>" if draw.random() < 0.8 else "") for t in tags)
        parser = html.PageParser()
        parser.feed(page)
        parser.close()
        full = [n for n in parser.counted() if n.text.strip()]
        if full:
            assert html.content_paths(full) == paths_by_hand(full)


def test_runs_and_windows_stay_inside_rows():
    data, offsets = textblocks.utf8(pa.array(["ab c", None, "", "C ab", "abc"]))
    starts, ends, rows = textblocks.runs(jaccard.IS_WORD[data], offsets)
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert (words, rows.tolist()) == (["ab", "c", "C", "ab", "abc"], [0, 0, 3, 3, 4])
    hashes = textblocks.word_hashes(data, starts, ends)
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] and len(set(hashes)) == 3
    found, first = textblocks.window_hashes(hashes, rows, 2)
    assert first.tolist() == [0, 2] and found[0] != found[1]
    assert list(textblocks.row_blocks(offsets, 5)) == [(0, 3), (3, 4), (4, 5)]
