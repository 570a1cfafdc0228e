"""Conversation repair against a search over all edits."""

import itertools
import random
import re
from functools import lru_cache
from hashlib import sha256

from rastro.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, key string, position string, block string"


def cheapest(codes):
    """(cost, audit), by trying every edit at every place; at most three inserted in a row."""

    @lru_cache(None)
    def best(i, roles, inserted):
        ways = []
        if i == len(codes) and re.fullmatch("(s?(ua)+)?", roles):
            ways.append((0, ""))
        if inserted < 3:
            for r in "ua":
                ways.append(added(5, "I", i, roles + r, inserted + 1))
        if i < len(codes):
            ways.append(added(2, "D", i + 1, roles, 0))
            if codes[i] != "d":
                more = 5 if codes[i].isupper() else 0
                ways += [added(1 + more, "R", i + 1, roles + r, 0) for r in "ua"]
                ways.append(added(more, "K", i + 1, roles + codes[i].lower(), 0))
        return min(ways, default=(10**9, ""))

    def added(cost, edit, i, roles, inserted):
        if not re.fullmatch("s?(ua)*u?", roles):
            return (10**9, "")
        # What came before matters by its state alone.
        state = "" if not roles else roles if roles == "s" else "u" if roles[-1] == "u" else "ua"
        c, audit = best(i, state, inserted)
        return c + cost, edit + audit

    return best(0, "", 0)


def test_least_edits_equal_a_search():
    draw = random.Random(1)
    runs = [t for n in range(4) for t in itertools.product("suaxdSUA", repeat=n)]
    runs += [draw.choices("suaxdUA", k=draw.randrange(5, 14)) for _ in range(150)]
    for run in runs:
        codes = "".join(run)
        cost, edits, _ = cv.least_edits(codes)
        assert (cost, "".join(edits)) == cheapest(codes), codes


def test_checkpoints_do_not_matter():
    draw = random.Random(2)
    codes = "".join(draw.choices("suaxdUAS", k=3_000))
    cost, edits, _ = cv.least_edits(codes)
    ends, state, parts = [cv.END], 0, []
    for low in reversed(range(0, 3_000, 700)):
        costs = ends[-1]
        for code in reversed(codes[low : low + 700]):
            costs = cv.back(costs, code)
        ends.append(costs)
    assert ends[-1][0] == cost
    for k, low in enumerate(range(0, 3_000, 700)):
        _, own, state = cv.least_edits(codes[low : low + 700], ends[-2 - k], state, low + 700 >= 3_000)
        parts += own
    assert parts == edits


def plain(rows):
    """Reports by conversation, from rows in their order."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        codes, seen, faults = "", [], [0, 0, 0]
        for _, role, text in own:
            end = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else 3
            seen.append((role, text))
            if fault < 3:
                faults[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault < 2 else code.upper() if fault == 2 else code
        cost, audit = cheapest(codes)
        lines, at, state = [], 0, ""
        for edit in audit:
            following = "assistant" if state == "u" else "user"
            if edit == "I":
                lines.append(following + ":")
                state = following[0]
                continue
            _, role, text = own[at]
            at += 1
            if edit != "D":
                role = following if edit == "R" else role
                lines.append(f"{role}:{text}")
                state = role[0]
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *faults, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())
    return out


def some_rows(n, most):
    draw = random.Random(n)
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", "", None]
    texts = ["Hello.", "What?", "An end without a mark", "Yes! \n", "", " \t", None, "Ünï."]
    rows = []
    for conv in [None, *range(n)]:
        for _ in range(draw.randrange(1, most)):
            text = draw.choice(texts + [f"{draw.randrange(99)}."] * 12)
            rows.append((conv, draw.choice([None, *range(12)]), draw.choice(roles), text))
    return rows


def reports(spark, rows, **given):
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    found = cv.repair(table, **given).collect()
    assert len(found) == len({r["conv_id"] for r in found})
    return {r[0]: tuple(r)[1:] for r in found}


def test_reports_equal_plain_ones(spark):
    rows = some_rows(60, 14)
    assert reports(spark, rows) == plain(rows)


def test_blocks_equal_whole_conversations(spark):
    rows = some_rows(12, 40)
    whole = reports(spark, rows)
    assert reports(spark, rows, long_rows=9, block_rows=4) == whole
    assert reports(spark, rows, long_rows=0, block_rows=1) == whole
    assert reports(spark, rows, long_bytes=60, block_rows=7) == whole
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    turns = {tuple(r) for r in cv.repaired_turns(table).collect()}
    assert {tuple(r) for r in cv.repaired_turns(table, long_rows=9, block_rows=4).collect()} == turns
    for conv, report in whole.items():
        own = sorted(t for t in turns if t[0] == conv)
        own.sort(key=lambda t: t[1])
        assert "".join(t[2] for t in own) == report[6]
        text = "\n".join(f"{t[4]}:{t[5]}" for t in own if t[2] != "D")
        assert sha256(text.encode()).hexdigest() == report[7]


def test_odd_tables(spark):
    assert reports(spark, []) == {}
    long = "A very long turn. " * 100_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes.")]
    assert reports(spark, rows) == plain(rows)
    gone = spark.createDataFrame([(5, 1, "user", "x.", True), (6, 1, "user", "x.", False)], "conv_id long, turn long, role string, text string, gone boolean")
    for given in ({}, {"long_rows": 0, "block_rows": 2}):
        found = {r["conv_id"]: tuple(r)[1:] for r in cv.repair(gone, "gone", **given).collect()}
        assert found[5] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
        assert found[6] == (0, 0, 0, 0, 0, 2, "D", sha256(b"").hexdigest())


def test_damage(spark, sample):
    """Each kind of damage hits about one row in twenty, and is undone where it can be."""
    rows = cv.damaged(sample("conversations"))
    n = sample("conversations").count()
    assert n < rows.count() < 1.2 * n
    assert 0 < rows.filter("_dropped").count() < 0.2 * n
    assert cv.repair(rows, "_dropped").count() == sample("conversations").select("conv_id").distinct().count()
