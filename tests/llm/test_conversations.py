"""Conversation repairs against a search over all edit strings."""

import functools
import hashlib
import itertools
import random
import re
import sys
import zlib

import pytest

from edgeloom.llm import conversations as repair
from edgeloom.llm.queries import op13_conversation_repair

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, word STRING, cost INT, key INT, kind INT"
# The search below goes one step deeper for each row.
sys.setrecursionlimit(20_000)
INSIDE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        lot = zlib.crc32(name.encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(conv, turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def signs_of(rows):
    """Faults and signs of a conversation's rows in order."""
    seen, faults, signs = set(), [], []
    for _, _, role, text in rows:
        inside = INSIDE.findall(text)
        fault = "blank" if not inside else "duplicate" if (role, text) in seen else None
        if not fault and inside[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faults.append(fault)
        sign = role[:1] if role[:1] in ("s", "u", "a") else "o"
        signs.append("x" if fault in ("blank", "duplicate") else sign.upper() if fault else sign)
    return faults, "".join(signs)


def search(signs):
    """Cheapest and then least edit string, over every string whose result is legal."""

    @functools.cache
    def best(at, roles):
        # roles: the initials so far, cut down to what the pattern can tell apart.
        options = []
        if at == len(signs) and re.fullmatch("(s?(ua)+)?", roles):
            options.append((0, ""))

        def add(letter, cost, to, new):
            if new is None or re.match("^(s?(ua)*u?)$", roles + new):
                rest = best(to, shorten(roles + (new or "")))
                if rest:
                    options.append((cost + rest[0], letter + rest[1]))

        if at < len(signs):
            sign = signs[at]
            add("D", 2, at + 1, None)
            if sign != "x":
                extra = 5 if sign.isupper() else 0
                if sign.lower() != "o":
                    add("K", extra, at + 1, sign.lower())
                for new in "ua":
                    add("R", 1 + extra, at + 1, new)
        return min(options) if options else None

    def with_rows(at, roles, n):
        """At most ``n`` rows put in before the next one is decided."""
        found = [best_without(at, roles)]
        if n:
            for new in "ua":
                if re.match("^(s?(ua)*u?)$", roles + new):
                    rest = with_rows(at, shorten(roles + new), n - 1)
                    if rest:
                        found.append((rest[0] + 5, "I" + rest[1]))
        found = [f for f in found if f]
        return min(found) if found else None

    best_without = best
    best = functools.cache(lambda at, roles: with_rows(at, roles, 3))
    return best(0, "")


def shorten(roles):
    return re.sub("^(s?ua)(ua)+", r"\1", roles)


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4])
def test_every_short_word(length):
    path = repair.Suffixes()
    for word in sorted("".join(w)[::-1] for w in itertools.product("xsuaoSUAO", repeat=length)):
        path.seek(word)
        assert path.best() == search(word[::-1]), word[::-1]


def test_long_words_and_shared_suffixes():
    draw = random.Random(2)
    ends = ["".join(draw.choices("xsuaoSUAO", k=40)) for _ in range(4)]
    words = {"".join(draw.choices("ssuuuaaaxoSUAO", k=draw.randint(0, 9))) + draw.choice(ends) for _ in range(300)}
    path = repair.Suffixes()
    for word in sorted(w[::-1] for w in words):
        path.seek(word)
        assert path.best() == search(word[::-1])
    suffixes = {w[i:] for w in words for i in range(len(w) + 1)}
    assert path.worked == len(suffixes)


def by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest())
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=order)
        faults, signs = signs_of(own)
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = search(signs)
        lines, at, before = [], iter(own), ""
        for edit in audit:
            row = None if edit == "I" else next(at)
            if edit == "D":
                continue
            due = "assistant" if before[:1] == "u" else "user"
            before = row[2] if edit == "K" else due
            lines.append(f"{before}:{row[3] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines)) and next(at, None) is None
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, *counts, illegal, cost, audit, digest)
    return sorted(out.values(), key=str)


def talks(seed):
    draw = random.Random(seed)
    texts = ["Yes.", "No?", "Cut off", " \t\n", "", None, "Wait! \r\n", "ß…", "Ok.", "x" * 50_000 + "."]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(draw.randint(1, 8)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "agent"])
            rows.append((conv, draw.choice([turn, turn, turn + 3, None]), role, draw.choice(texts)))
    rows += [rows[0], rows[0], (1000, None, None, None)]
    rows += [(2000, i, "ua"[i % 2] if i % 9 else "s", f"Row {i}.") for i in range(300)]
    rows += [(c, 0, "user", "Same.") for c in range(3000, 3060)]
    return rows


def test_repairs_equal_brute_force(spark, tmp_path):
    rows = talks(1)
    table = spark.createDataFrame([(*r, "w", 1, 2, 3) for r in rows], SCHEMA)
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    got = op13_conversation_repair(spark, str(tmp_path))
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert got.columns == names
    want = by_hand(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_repaired_rows_are_whole(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "user", "Hi!"), (1, 3, "tool", "Done.")]
    table = spark.createDataFrame([(*r, "w", 1, 2, 3) for r in rows], SCHEMA)
    found = repair.audits(table)
    assert [r.audit for r in found.collect()] == ["KKDR"]
    got = repair.repairs(table, found).collect()
    assert [(r.pos, r.edit, r.turn, r.role, r.text) for r in got] == [
        (1, "K", 0, "system", "Be kind."), (2, "K", 1, "user", "Hi!"), (3, "D", 2, None, None), (4, "R", 3, "assistant", "Done."),
    ]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert op13_conversation_repair(spark, str(tmp_path)).collect() == []
