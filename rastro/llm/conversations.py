"""Repair of conversation structure with the fewest, least edits.

What is left of a conversation must have the roles ``(s?(ua)+)?`` by their initials. A state says
what came last: nothing (0), a system turn (1), a user turn (2), an assistant turn (3). The cost
from a row and a state to the end follows from the cost behind the row; walking forward along
edits that are tight under these costs, the ASCII-least first, gives the least of the cheapest
audits.

Cost vectors are kept at checkpoints only, about the square root of the rows apart, and the rows
of a block are worked out again when the walk comes to it. A conversation of ordinary size is
repaired in one task from sorted rows. One that is longer is cut into blocks in Spark: each block
gives the matrix that takes costs at its end to costs at its start, the vectors at the blocks'
borders are the checkpoints, and blocks walk side by side, once for each state that they may be
entered in.
"""

from __future__ import annotations

from hashlib import sha256
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.functions.running import row_rank
from rastro.llm.common import pinned, with_keys

#: Fixed values of the task: costs of edits, what a kept truncated row adds, the roles given.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
GIVEN = {2: "user", 3: "assistant"}

#: The state that an inserted turn or a new role leads to, from each state.
NEXT = (2, 2, 3, 2)
#: The state after a kept row, by its initial, from each state; -1: the row can't stay.
KEEP = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
#: Costs behind the last row.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60

#: Conversations beyond either of these are repaired in blocks of so many rows.
LONG_ROWS, LONG_BYTES, BLOCK_ROWS = 20_000, 32 << 20, 16_384

#: A deleted row's code; other codes are initials, "x" if none may stay, upper case if truncated.
GONE = "d"

REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
TURNS = "conv_id long, position long, edit string, turn long, role string, text string"

_SPACES = "\\x20\\x09-\\x0D"
_STRIPPED = " \t\n\v\f\r"


def back(after: tuple, code: str) -> tuple:
    """Costs at a row from the costs behind it."""
    if code == GONE:
        costs = [DELETE + c for c in after]
    else:
        more = TRUNCATED if code.isupper() else 0
        stays = KEEP.get(code.lower())
        costs = [min(DELETE + after[q], REROLE + more + after[NEXT[q]]) for q in range(4)]
        if stays:
            for q, to in enumerate(stays):
                if to >= 0:
                    costs[q] = min(costs[q], more + after[to])
    return inserted(costs)


def inserted(costs) -> tuple:
    """The same where turns may be inserted before the row."""
    user, assistant = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + user), min(costs[1], INSERT + user), user, assistant


def _walk(codes: str, costs: list[tuple], state: int) -> tuple[list[str], int]:
    """Edits of a run of rows, entered in a state, and the state behind it; ``costs`` has the
    vectors at each row and the one behind the run."""
    edits = []
    for i, code in enumerate(codes):
        here, after = costs[i], costs[i + 1]
        more = TRUNCATED if code.isupper() else 0
        while True:
            cost = here[state]
            if cost == DELETE + after[state]:
                edits.append("D")
                break
            if cost == INSERT + here[NEXT[state]]:
                edits.append("I")
                state = NEXT[state]
                continue
            to = KEEP.get(code.lower(), (-1,) * 4)[state]
            if to >= 0 and cost == more + after[to]:
                edits.append("K")
                state = to
            else:
                edits.append("R")
                state = NEXT[state]
            break
    return edits, state


def _closing(state: int) -> list[str]:
    edits = []
    while END[state]:
        edits.append("I")
        state = NEXT[state]
    return edits


def least_edits(codes: str, after: tuple = END, state: int = 0, last: bool = True):
    """(cost, edits, state behind): the ASCII-least of the cheapest edits of rows with these
    codes, where ``after`` are the costs behind them. Checkpoints are a square root apart."""
    size = isqrt(len(codes)) + 1
    starts = list(range(0, len(codes), size))
    checkpoints = [after] * (len(starts) + 1)
    for k in reversed(range(len(starts))):
        costs = checkpoints[k + 1]
        for code in reversed(codes[starts[k] : starts[k] + size]):
            costs = back(costs, code)
        checkpoints[k] = costs
    cost, edits = checkpoints[0][state], []
    for k, start in enumerate(starts):
        block = codes[start : start + size]
        costs = [checkpoints[k + 1]]
        for code in reversed(block):
            costs.append(back(costs[-1], code))
        own, state = _walk(block, costs[::-1], state)
        edits += own
    return cost, edits + (_closing(state) if last else []), state


def _replayed(edits, codes: str, state: int = 0):
    """(edit, row, role) of each edit: the place of the row that it takes or comes before, and
    the role that it gives, if it gives one."""
    row = 0
    for edit in edits:
        given = None
        if edit in "IR":
            state = NEXT[state]
            given = GIVEN[state]
        elif edit == "K":
            state = KEEP[codes[row].lower()][state]
        yield edit, row, given
        row += edit != "I"


def _code(initial: str, truncated: bool) -> str:
    code = initial if initial in KEEP else "x"
    return code.upper() if truncated else code


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _solved(rows: list[tuple]) -> tuple:
    """The report of one conversation and its turns, from rows (turn, role, text) in order."""
    seen: set[tuple[str, str]] = set()
    codes, initials, faults = [], [], [0, 0, 0]
    for _, role, text in rows:
        ended = text.rstrip(_STRIPPED)
        known = (role, text) in seen
        seen.add((role, text))
        initials.append(role[0] if role[:1] in KEEP else "x")
        truncated = ended[-1:] not in (".", "!", "?")
        fault = 0 if not ended else 1 if known else 2 if truncated else 3
        if fault < 3:
            faults[fault] += 1
        codes.append(GONE if fault < 2 else _code(role[:1], truncated))
    whole = "".join(codes)
    cost, edits, _ = least_edits(whole)
    turns = []
    for edit, row, given in _replayed(edits, whole):
        turn, role, text = rows[row] if edit != "I" else (None, given, "")
        turns.append((edit, turn, given or role, text))
    present = {t for t, _, _ in rows if t is not None}
    gaps = max(present) - min(present) + 1 - len(present) if present else 0
    lines = "\n".join(f"{role}:{text}" for edit, _, role, text in turns if edit != "D")
    report = (gaps, *faults, illegal_pairs("".join(initials)), cost, "".join(edits))
    return (*report, sha256(lines.encode()).hexdigest()), turns


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields]
    )


def _conversations(batches):
    """(conv_id, rows) of sorted batches (key, conv_id, turn, role, text, dropped)."""
    key, conv, rows = None, None, []
    for batch in batches:
        for k, c, turn, role, text, dropped in zip(*(col.to_pylist() for col in batch.columns)):
            if k != key:
                if key is not None:
                    yield conv, rows
                key, conv, rows = k, c, []
            if not dropped:
                rows.append((turn, role, text))
    if key is not None:
        yield conv, rows


def _reports(batches):
    out = []
    for conv, rows in _conversations(batches):
        out.append((conv, *_solved(rows)[0]))
        if len(out) == 1000:
            yield _table(out, REPORT)
            out = []
    yield _table(out, REPORT)


def _turns(batches):
    out = []
    for conv, rows in _conversations(batches):
        out += [(conv, i, *turn) for i, turn in enumerate(_solved(rows)[1])]
        if len(out) >= 1000:
            yield _table(out, TURNS)
            out = []
    yield _table(out, TURNS)


def _prepared(df: DataFrame, dropped: str | None) -> DataFrame:
    have = set(df.columns)
    return df.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("key"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col("_copy") if "_copy" in have else F.lit(0)).alias("copy"),
        (F.col(dropped) if dropped else F.lit(False)).alias("dropped"),
    )


def _parted(rows: DataFrame, long_rows: int, long_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations of ordinary size, and those of long ones, if there are any."""
    sizes = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("role") + F.octet_length("text")).alias("b")
    )
    long = pinned(sizes.filter((F.col("n") > long_rows) | (F.col("b") > long_bytes)).select("key"))
    n = long.count()
    if n == 0:
        return rows, None
    return rows.join(long, "key", "left_anti"), with_keys(rows, long, "key", n)


def _in_tasks(rows: DataFrame, function, schema: str) -> DataFrame:
    order = [F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    dealt = rows.repartition("key").sortWithinPartitions("key", *order)
    return dealt.select("key", "conv_id", "turn", "role", "text", "dropped").mapInArrow(function, schema)


class _InBlocks:
    """Long conversations, block by block."""

    def __init__(self, rows: DataFrame, block_rows: int) -> None:
        order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
        self.keys = pinned(rows.groupBy("key", "conv_id").agg(F.count(F.lit(1)).alias("n")))
        present = rows.filter(~F.col("dropped"))
        self.rows = pinned(row_rank(present, ["key"], order, "position"))
        signature = F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256)
        signed = self.rows.withColumn("signature", signature)
        first = pinned(signed.groupBy("key", "signature").agg(F.min("position").alias("first")))
        blank = ~F.col("text").rlike(f"[^{_SPACES}]")
        whole = F.col("text").rlike(f"[.!?][{_SPACES}]*\\z")
        fault = (
            F.when(blank, 0).when(F.col("position") > F.col("first"), 1).when(~whole, 2).otherwise(3)
        )
        initial = F.substring("role", 1, 1)
        initial = F.when(initial.isin(*KEEP), initial).otherwise("x")
        coded = (
            signed.join(first, ["key", "signature"])
            .select("key", "position", fault.alias("fault"), initial.alias("initial"))
            .withColumn(
                "code",
                F.when(F.col("fault") < 2, GONE)
                .when(F.col("fault") == 2, F.upper("initial"))
                .otherwise(F.col("initial")),
            )
            .withColumn("block", F.floor((F.col("position") - 1) / block_rows).cast("long"))
        )
        ordered = F.array_sort(F.collect_list(F.struct("position", "code", "initial")))
        in_order = lambda name: F.array_join(F.transform("_own", lambda x: x[name]), "")
        count = lambda k: F.sum((F.col("fault") == k).cast("long"))
        blocks = coded.groupBy("key", "block").agg(
            ordered.alias("_own"), count(0).alias("blank"), count(1).alias("duplicate"), count(2).alias("truncated")
        )
        self.blocks = pinned(
            blocks.select(
                "key", "block", "blank", "duplicate", "truncated",
                F.col("_own")[0]["position"].alias("first"),
                in_order("code").alias("codes"), in_order("initial").alias("initials"),
            )
        )
        self._settle()

    def _settle(self) -> None:
        units = [tuple(0 if q == r else FAR for q in range(4)) for r in range(4)]

        def matrices(batches):
            for batch in batches:
                out = []
                for codes in batch.column(2).to_pylist():
                    columns = []
                    for costs in map(inserted, units):
                        for code in reversed(codes):
                            costs = back(costs, code)
                        columns.append(costs)
                    out.append([columns[r][q] for q in range(4) for r in range(4)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))],
                    names=["key", "block", "matrix"],
                )

        def borders(table: pa.Table) -> pa.Table:
            """The costs behind each block of a conversation: its checkpoints."""
            table = table.sort_by("block")
            costs, out = END, []
            for matrix in reversed(table["matrix"].to_pylist()):
                out.append(list(costs))
                costs = tuple(min(matrix[4 * q + r] + costs[r] for r in range(4)) for q in range(4))
            n = table.num_rows
            return pa.table(
                {
                    "key": table["key"],
                    "block": table["block"],
                    "after": pa.array(out[::-1], pa.list_(pa.int64())),
                    "last": pa.array([i == n - 1 for i in range(n)]),
                    "cost": pa.array([costs[0]] * n, pa.int64()),
                }
            )

        def walked(batches):
            for batch in batches:
                exits, edits = [], []
                columns = (batch.column(i).to_pylist() for i in range(2, 5))
                for codes, after, last in zip(*columns):
                    ways = [least_edits(codes, tuple(after), q, last) for q in range(4)]
                    exits.append([w[2] for w in ways])
                    edits.append(["".join(w[1]) for w in ways])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(exits, pa.list_(pa.int32())),
                        pa.array(edits, pa.list_(pa.string())),
                    ],
                    names=["key", "block", "exits", "edits"],
                )

        def entered(table: pa.Table) -> pa.Table:
            table = table.sort_by("block")
            state, out = 0, []
            for exits in table["exits"].to_pylist():
                out.append(state)
                state = exits[state]
            return pa.table({"key": table["key"], "block": table["block"], "entry": pa.array(out, pa.int32())})

        at = ["key", "block"]
        by_matrix = self.blocks.select(*at, "codes").mapInArrow(matrices, "key string, block long, matrix array<long>")
        self.ends = pinned(
            by_matrix.groupBy("key").applyInArrow(
                borders, "key string, block long, after array<long>, last boolean, cost long"
            )
        )
        given = self.blocks.join(self.ends, at).select(*at, "codes", "after", "last")
        ways = pinned(given.mapInArrow(walked, "key string, block long, exits array<int>, edits array<string>"))
        entries = ways.select(*at, "exits").groupBy("key").applyInArrow(entered, "key string, block long, entry int")
        chosen = F.element_at("edits", F.col("entry") + 1)
        self.audits = pinned(ways.join(entries, at).select(*at, "entry", chosen.alias("audit")))

    def lines(self) -> DataFrame:
        """key, position, sub, edit, turn, role, text: the edits, with the rows that they take."""
        at = ["key", "block"]
        blocks = self.blocks.select(*at, "first", "codes").join(self.audits, at)

        def replay(batches):
            names = "key string, position long, sub int, edit string, given string"
            for batch in batches:
                out = []
                for key, first, codes, state, audit in zip(*(c.to_pylist() for c in batch.columns)):
                    sub = 0
                    for edit, row, given in _replayed(audit, codes, state):
                        out.append((key, first + row, sub, edit, given))
                        sub = sub + 1 if edit == "I" else 0
                yield _table(out, names)

        edits = blocks.select("key", "first", "codes", "entry", "audit").mapInArrow(
            replay, "key string, position long, sub int, edit string, given string"
        )
        own = self.rows.select("key", "position", "turn", "role", "text")
        joined = edits.join(own, ["key", "position"], "left")
        inserted_turn = F.col("edit") == "I"
        return joined.select(
            "key",
            "position",
            "sub",
            "edit",
            F.when(~inserted_turn, F.col("turn")).alias("turn"),
            F.coalesce("given", "role").alias("role"),
            F.when(inserted_turn, "").otherwise(F.col("text")).alias("text"),
        )

    def digests(self) -> DataFrame:
        """key, repaired_sha256. A digest is a chain, so each conversation streams through one
        task, which holds one batch of it."""

        def digest(batches):
            key, state, empty = None, None, True
            for batch in batches:
                for k, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if k != key:
                        if key is not None:
                            yield _table([(key, state.hexdigest())], "key string, repaired_sha256 string")
                        key, state, empty = k, sha256(), True
                    state.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                    empty = False
            if key is not None:
                yield _table([(key, state.hexdigest())], "key string, repaired_sha256 string")

        kept = self.lines().filter("edit <> 'D'")
        dealt = kept.repartition("key").sortWithinPartitions("key", "position", "sub")
        return dealt.select("key", "role", "text").mapInArrow(digest, "key string, repaired_sha256 string")

    def reports(self) -> DataFrame:
        def pairs(table: pa.Table) -> pa.Table:
            """Illegal pairs of a conversation: within blocks, and across their borders."""
            table = table.sort_by("block")
            ends = table["ends"].to_pylist()
            across = sum(illegal_pairs(a[1] + b[0]) for a, b in zip(ends, ends[1:]))
            total = sum(table["illegal"].to_pylist()) + across
            return pa.table({"key": table["key"][:1], "illegal": pa.array([total], pa.int64())})

        def inside(batches):
            for batch in batches:
                runs = batch.column(2).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(map(illegal_pairs, runs), pa.int64()),
                        pa.array([r[0] + r[-1] for r in runs]),
                    ],
                    names=["key", "block", "illegal", "ends"],
                )

        own = self.blocks.select("key", "block", "initials").mapInArrow(
            inside, "key string, block long, illegal long, ends string"
        )
        illegal = own.groupBy("key").applyInArrow(pairs, "key string, illegal long")
        faults = self.blocks.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
        turns = self.rows.groupBy("key", "turn").agg(F.count(F.lit(1)).alias("_n")).groupBy("key")
        gaps = turns.agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
        )
        costs = self.ends.filter("last").select("key", "cost")
        in_order = F.array_sort(F.collect_list(F.struct("block", "audit")))
        audits = self.audits.groupBy("key").agg(
            F.array_join(F.transform(in_order, lambda x: x["audit"]), "").alias("audit")
        )
        found = self.keys.select("key", "conv_id")
        for part in (gaps, faults, illegal, costs, audits, self.digests()):
            found = found.join(part, "key", "left")
        counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        return found.select(
            "conv_id",
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )


def repair(
    df: DataFrame,
    dropped: str | None = None,
    long_rows: int = LONG_ROWS,
    long_bytes: int = LONG_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row for each conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and the
    SHA-256 of the repaired conversation.

    Rows are taken by turn, nulls first, then by role, text and ``_copy``, if there is such a
    column. A null role or text is one space; a null conv_id is a conversation of its own, null
    turns count in no gap. Rows whose column ``dropped`` is true are not there, but their
    conversation is: without any row it has zeros, an empty audit and the hash of nothing. A
    role without a first letter s, u or a can't be kept. Repeated rows are duplicates from the
    second on, equal but for turn included. Very long texts pass whole. Other columns are not
    read, an empty table gives an empty one.

    Conversations beyond ``long_rows`` rows or ``long_bytes`` bytes are repaired in blocks of
    ``block_rows`` rows, with the same results.
    """
    ordinary, long = _parted(_prepared(df, dropped), long_rows, long_bytes)
    found = _in_tasks(ordinary, _reports, REPORT)
    return found if long is None else found.unionByName(_InBlocks(long, block_rows).reports())


def repaired_turns(
    df: DataFrame,
    dropped: str | None = None,
    long_rows: int = LONG_ROWS,
    long_bytes: int = LONG_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """conv_id, position, edit, turn, role, text: one row for each edit, in order by position
    within its conversation. Deleted rows have the edit D; all others form the repaired
    conversation, inserted ones without a turn. For odd rows see ``repair``."""
    ordinary, long = _parted(_prepared(df, dropped), long_rows, long_bytes)
    found = _in_tasks(ordinary, _turns, TURNS)
    if long is None:
        return found
    blocks = _InBlocks(long, block_rows)
    ranked = row_rank(blocks.lines(), ["key"], [F.col("position"), F.col("sub")], "place")
    named = ranked.drop("position").join(blocks.keys.select("key", "conv_id"), "key")
    return found.unionByName(
        named.withColumn("position", F.col("place") - 1).select("conv_id", "position", "edit", "turn", "role", "text")
    )


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with planted faults, for trials: rows by crc32 of ``conv_id:turn`` modulo
    20: 0 is marked in ``_dropped``, 1 loses its text, 2 its full stops, exclamation and question
    marks, 3 comes twice, 4 becomes a user's."""
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    rows = df.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(name) % 20).alias("_fault"),
    )
    fault = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("_dropped"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
