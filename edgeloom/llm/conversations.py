"""Conversations brought back into turn order at the least cost, by a suffix-shared automaton.

A repaired conversation's roles are ``(s?(ua)+)?`` by their initials: perhaps a system row, then
user and assistant in turn. Each row is kept (K, cost 0), given another role (R, 1; user or
assistant), deleted (D, 2), and rows without text can be put in anywhere (I, 5). Blank and repeated
rows have to go; a truncated row that stays costs 5 more. Of equal costs the audit, the string of
edits, that comes first in ASCII order is taken.

**The automaton.** What a row allows depends on its role's initial and its fault alone: one of nine
signs. A conversation is a word of signs, and the cost of its rest depends on the suffix that is left
and on the state of the role grammar. So words are merged from the end: each node of the automaton is one
distinct suffix, whatever the conversations that share it. Costs-to-go and first edits are worked out once for each node and grammar
state, from the child's, and audits are read off by following first edits. Different edits have
different letters, so the first letter settles a tie.

**Spread.** Equal words are counted first. Distinct words are range-partitioned and sorted by
their reversal, which walks the automaton depth first: a task holds one path of it, however
many words it has. (A path that a partition border cuts is worked out on both sides.) A word of
very many conversations is dealt over stripes on the way back. Rows of a conversation pass through
one task, in order, as a stream: its audit is one string and its digest one chain, but its texts are
never held together. Texts are shuffled once.

Rows of a conversation stand by turn, nulls first, then by role and the SHA-256 of the text. A null
role, text, turn or id counts as one blank where its value is asked for; rows without id are one
conversation. Empty tables give empty results; other columns are not read, and very long texts
are read as a whole. Column names of the results are fixed; the id has the name given.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.operators.skew import hot_limit, hot_rows, split_join
from edgeloom.storage import keep

BLANKS = " \t\n\x0b\x0c\r"
# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Grammar states: nothing yet, after system, after user, after assistant. A conversation may end
# in the first and the last; any state has one role that can be put in.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Signs: a row that has to go, else the initial, as a capital when truncated.
GONE, OTHER = "x", "o"
FAR = 2**60


# ------------------------------------------------------------------ the automaton


class Suffixes:
    """One path of the automaton, from the end of words: costs and first edits of each suffix.

    ``seek`` moves to another word, of which only what differs at the front is worked out.
    """

    def __init__(self) -> None:
        self.word, self.worked = "", 0
        self.costs, self.edits = array("q"), bytearray()
        self._settle([0, FAR, FAR, 0], [ord("-")] * 4)

    def _settle(self, cost: list[int], edit: list[int]) -> None:
        """Add a node whose costs without insertion are given."""
        for state in (USER, ASSISTANT, START, SYSTEM):
            with_row = cost[NEXT[state]] + INSERT
            if with_row < cost[state] or (with_row == cost[state] and ord("I") < edit[state]):
                cost[state], edit[state] = with_row, ord("I")
        self.costs.extend(cost)
        self.edits.extend(edit)
        self.worked += 1

    def _push(self, sign: str) -> None:
        child = self.costs[-4:]
        cost = [child[state] + DELETE for state in range(4)]
        edit = [ord("D")] * 4
        if sign != GONE:
            stays = TRUNCATED if sign.isupper() else 0
            for state in range(4):
                keeps = kept_state(state, sign.lower())
                if keeps is not None and child[keeps] + stays < cost[state]:
                    cost[state], edit[state] = child[keeps] + stays, ord("K")
                as_other = child[NEXT[state]] + REROLE + stays
                if as_other < cost[state]:
                    cost[state], edit[state] = as_other, ord("R")
        self._settle(cost, edit)

    def seek(self, reversed_word: str) -> None:
        same, most = 0, min(len(self.word), len(reversed_word))
        while same < most and self.word[same] == reversed_word[same]:
            same += 1
        del self.costs[4 * (same + 1) :]
        del self.edits[4 * (same + 1) :]
        for sign in reversed_word[same:]:
            self._push(sign)
        self.word = reversed_word

    def best(self) -> tuple[int, str]:
        """Cost and audit of the present word."""
        out, state, node = bytearray(), START, len(self.word)
        while node or self.edits[4 * node + state] == ord("I"):
            edit = self.edits[4 * node + state]
            out.append(edit)
            if edit == ord("K"):
                state = kept_state(state, self.word[node - 1].lower())
            elif edit != ord("D"):
                state = NEXT[state]
            node -= edit != ord("I")
        return self.costs[4 * len(self.word)], out.decode()


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row with this initial, None if it cannot stand there."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return USER if initial == "u" and state != USER else None


def solve(words: DataFrame, tasks: int) -> DataFrame:
    """``(word, cost, audit)`` of the distinct reversed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = Suffixes()
        for batch in batches:
            found = []
            for word in batch["word"].to_pylist():
                path.seek(word)
                found.append(path.best())
            costs, audits = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch["word"], pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                ["word", "cost", "audit"],
            )

    ordered = words.select("word").repartitionByRange(tasks, "word").sortWithinPartitions("word")
    return ordered.mapInArrow(run, "word string, cost bigint, audit string")


# ------------------------------------------------------------------ rows and their faults


def _stated(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, turn, role, text)`` with planted faults, by the CRC-32 of ``key:turn``.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes its final marks away, 3
    repeats it, 4 makes it the user's.
    """
    lot = F.crc32(F.encode(F.concat(_stated(key), F.lit(":"), _stated("turn")), "UTF-8")) % 20
    text = F.when(lot == 1, "").when(lot == 2, F.translate(_stated("text"), ".!?", ""))
    copies = F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.where(lot != 0).select(
        key,
        "turn",
        F.when(lot == 4, "user").otherwise(_stated("role")).alias("role"),
        text.otherwise(_stated("text")).alias("text"),
        F.explode(copies).alias("copy"),
    )
    return rows.drop("copy")


def _ordered(rows: DataFrame, key: str) -> DataFrame:
    """``(key, turn, role, text, same)``; ``same`` stands for the text where rows are compared."""
    return rows.select(
        F.col(key).alias("key"),
        "turn",
        _stated("role").alias("role"),
        _stated("text").alias("text"),
        F.unhex(F.sha2(F.encode(_stated("text"), "UTF-8"), 256)).alias("same"),
    )


def _signed(rows: DataFrame) -> DataFrame:
    """Narrow rows in the order of conversations: ``(key, turn, initial, fault)``.

    Faults are 1 blank, 2 duplicate, 3 truncated, 0 none. All steps go by one shuffle on the key.
    """
    end = F.rtrim("text", F.lit(BLANKS))
    narrow = rows.select(
        "key",
        "turn",
        "role",
        "same",
        (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"),
    ).repartition("key")
    before = Window.partitionBy("key", "role", "same").orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(F.col("blank"), 1)
        .when(F.col("nth") > 1, 2)
        .when(F.col("truncated"), 3)
        .otherwise(0)
    )
    marked = narrow.withColumn("nth", F.row_number().over(before))
    ordered = marked.sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "same", "nth")
    return ordered.select("key", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


class _Word:
    """What is known of one conversation while its rows pass by."""

    def __init__(self, key) -> None:
        self.key, self.signs, self.last = key, bytearray(), None
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.turns, self.first, self.turn = 0, None, None

    def add(self, turn, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.turn:
            self.turns, self.turn = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        sign = initial if initial in ("s", "u", "a") else OTHER
        self.signs += (GONE if fault in (1, 2) else sign.upper() if fault == 3 else sign).encode()

    def row(self) -> tuple:
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        self.signs.reverse()
        return (self.key, self.signs.decode(), gaps, *self.faults[1:], self.illegal)


_WORD = "word string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"


def _words(rows: DataFrame) -> DataFrame:
    """One row a conversation: its reversed word and its counts."""
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", *(f.split()[0] for f in _WORD.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, schema = None, None
        for batch in batches:
            schema = pa.schema(
                [("key", batch.schema.field("key").type), ("word", pa.string())]
                + [(n, pa.int64()) for n in names[2:]]
            )
            done = []
            columns = (batch[c].to_pylist() for c in ("key", "turn", "initial", "fault"))
            for key, turn, initial, fault in zip(*columns, strict=True):
                if word is None or key != word.key:
                    if word:
                        done.append(word.row())
                    word = _Word(key)
                word.add(turn, initial, fault)
            if done:
                yield _batch(done, schema)
        if word:
            yield _batch([word.row()], schema)

    return _signed(rows).mapInArrow(run, f"key {kind}, {_WORD}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


# ------------------------------------------------------------------ repairs


def audits(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row a conversation: ``(key, gaps, blank, duplicate, truncated, illegal, cost, audit)``."""
    spark = rows.sparkSession
    words = keep(_words(_ordered(rows, key)), "words")
    counts = keep(words.groupBy("word").agg(F.count("*").alias("n_left")), "counts")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    solved = solve(counts, tasks)
    hot = hot_rows(
        counts.withColumn("n_right", F.lit(1)),
        "word",
        hot_limit(counts.agg(F.coalesce(F.sum("n_left"), F.lit(0))).first()[0]),
    )
    found = split_join(words, solved, "word", ("key", "word"), hot)
    return found.select(
        F.col("key").alias(key), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )


def repairs(rows: DataFrame, found: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, pos, edit, turn, role, text)``: all edits of each conversation, in order.

    Role and text are the repaired ones, null where the edit is D; rows put in have no turn.
    ``found`` is what ``audits`` gave for the rows. The rows of a conversation
    stand one after the other in one partition.
    """
    old = _ordered(rows, key).withColumns({"kind": F.lit(1), "audit": F.lit(None).cast("string")})
    heads = found.select(F.col(key).alias("key"), "audit", F.lit(0).alias("kind"))
    both = old.unionByName(heads, allowMissingColumns=True).repartition("key")
    ordered = both.sortWithinPartitions("key", "kind", F.col("turn").asc_nulls_first(), "role", "same")
    kinds = {f.name: f.dataType.simpleString() for f in old.schema}
    out = f"key {kinds['key']}, pos bigint, edit string, turn {kinds['turn']}, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, schema = None, None
        for batch in batches:
            schema = schema or pa.schema(
                [
                    ("key", batch.schema.field("key").type),
                    ("pos", pa.int64()),
                    ("edit", pa.string()),
                    ("turn", batch.schema.field("turn").type),
                    ("role", pa.string()),
                    ("text", pa.string()),
                ]
            )
            edits = []
            columns = (batch[c].to_pylist() for c in ("key", "kind", "turn", "role", "text", "audit"))
            for row_key, kind, turn, role, text, audit in zip(*columns, strict=True):
                if kind == 0:
                    if state:
                        edits += state.end()
                    state = _Edits(row_key, audit)
                else:
                    edits += state.next(turn, role, text)
            if edits:
                yield _batch(edits, schema)
        if state and (last := state.end()):
            yield _batch(last, schema)

    columns = ordered.select("key", "kind", "turn", "role", "text", "audit")
    return columns.mapInArrow(run, out).withColumnRenamed("key", key)


class _Edits:
    """An audit carried out on the rows of its conversation as they pass by."""

    def __init__(self, key, audit: str) -> None:
        self.key, self.audit, self.at, self.state = key, audit, 0, START

    def _put(self, edit: str, turn, role, text) -> tuple:
        self.at += 1
        if edit in "RI":
            self.state = NEXT[self.state]
            role = ROLES[self.state]
        elif edit == "K":
            self.state = kept_state(self.state, role[:1])
        else:
            role = text = None
        return (self.key, self.at, edit, turn, role, text)

    def end(self) -> list[tuple]:
        out = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            out.append(self._put("I", None, None, ""))
        return out

    def next(self, turn, role: str, text: str) -> list[tuple]:
        return [*self.end(), self._put(self.audit[self.at], turn, role, text)]


def digests(repaired: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, repaired_sha256)`` of ``repairs``, read in the order in which it gives its rows.

    The digest of a conversation's ``role:text``, joined by line feeds.
    """
    kind = repaired.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_now, chain, any_row, schema = None, None, False, None
        for batch in batches:
            schema = pa.schema([("key", batch.schema.field("key").type), ("repaired_sha256", pa.string())])
            done = []
            columns = (batch[c].to_pylist() for c in ("key", "role", "text"))
            for row_key, role, text in zip(*columns, strict=True):
                if chain is None or row_key != key_now:
                    if chain:
                        done.append((key_now, chain.hexdigest()))
                    key_now, chain, any_row = row_key, hashlib.sha256(), False
                if role is not None:
                    chain.update((("\n" if any_row else "") + f"{role}:{text}").encode())
                    any_row = True
            if done:
                yield _batch(done, schema)
        if chain:
            yield _batch([(key_now, chain.hexdigest())], schema)

    rows = repaired.select(F.col(key).alias("key"), "role", "text")
    return rows.mapInArrow(run, f"key {kind}, repaired_sha256 string").withColumnRenamed("key", key)
