"""Conversation structure repair: turns aligned to the grammar ``(s?(ua)+)?``.

The role initials of a conversation must be an optional system turn and then pairs of user
and assistant. Keeping a turn costs nothing, another role 2, leaving it out 3 (a must for
blank and repeated turns), an empty turn put in 2; a cut-off turn that stays adds 1. For each
length that a string of the grammar can have, the turns are aligned with that string
(Wagner and Fischer), in a band of diagonals that the cheapest alignment so far leaves open
(Ukkonen); lengths go outward from that of the conversation and end where inserts or
deletions alone would cost more. Equal costs are settled by the audits traced back: the
edits' initials D, I, K, R, least in ASCII.

A long conversation is cut into segments of ``SEGMENT`` turns. A segment is aligned with the
strings that lead from each state of the grammar to each other; inserts belong before a
turn, so an audit ends on one and two audits of a segment never continue each other.
Segments then combine by cost and audit, in any grouping, into what the whole would give. On
Spark, conversations of up to ``LONG_ROWS`` rows are worked on whole, where they lie after one
shuffle by conversation. Longer ones are dealt by range, aligned in segments, and combined
in a tree of groups of ``FANOUT``; only their repaired rows, which have an order, pass
through a task as a stream, beside an audit of one letter a turn.

Cases: a null role or text counts as one space; null turns come first, and a null conv_id is
a conversation. Rows of one turn are ordered by role, then text. Equal rows are repeats: all but
the first go. A role without letters fits nothing and gets another. Very long texts are
held one conversation at a time. Conversations without rows (``copies`` all 0) have zeros and an
empty audit; an empty table gives no rows. Other columns are not read.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from txrisk.llm.tables import SLICE_ROWS, read, settle

BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
REROLE, DELETE, INSERT = 2, 3, 2
SEGMENT = 64  # turns aligned at a time
LONG_ROWS = 4096  # rows of a conversation that a task works on whole
FANOUT = 64  # segments combined by a task at a time
MEMO = 100_000  # alignments a task remembers
# States of the grammar: nothing yet, after the system turn, after a user, after a pair.
STATES = "SPAU"
AFTER = {"s": "P", "u": "A", "a": "U"}
CLOSING = {"S": "", "P": "ua", "A": "a", "U": ""}  # what ends a string of the grammar
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")


# ------------------------------------------------------------------- aligning turns


def target(entry: str, leave: str, length: int) -> str | None:
    """The string of that length that leads from one state to another, if there is one."""
    if length == 0:
        return "" if entry == leave else None
    starts = {"S": ("ua", "sua"), "A": ("au",)}.get(entry, ("ua",))
    for start in starts:
        text = (start[:-2] + start[-2:] * length)[:length]
        if AFTER[text[-1]] == leave:
            return text
    return None


def banded(turns: str, goal: str, limit: int) -> tuple[int, str] | None:
    """Least cost, up to ``limit``, of turning ``turns`` into ``goal``, and the least audit.

    A turn is its initial, upper case when cut off; the 1 that such a turn costs at least is
    left out here. A path that leaves the diagonals between 0 and the difference in length
    must come back, so ``limit`` bounds how far it can go."""
    n, m = len(turns), len(goal)
    slack = (limit - 2 * abs(m - n)) // 4
    low, high = min(0, m - n) - slack, max(0, m - n) + slack
    width, far = high - low + 1, limit + 1
    table = [[far] * (width + 2) for _ in range(n + 1)]  # at i, j - i - low + 1
    table[n][m - n - low + 1] = 0
    for i in range(n - 1, -1, -1):
        here, below, turn = table[i], table[i + 1], turns[i]
        drop = DELETE - turn.isupper()
        own = turn.lower()
        for k in range(min(width, m - i - low + 1), max(0, -low - i), -1):
            j = i + k - 1 + low
            best = below[k - 1] + drop
            if j < m:
                want = goal[j]
                if want == own:
                    best = min(best, below[k])
                elif want != "s":
                    best = min(best, below[k] + REROLE)
                if want != "s":
                    best = min(best, here[k + 1] + INSERT)
            here[k] = min(best, far)
    cost = table[0][1 - low] if 1 <= 1 - low <= width else far
    if cost > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        k = j - i - low + 1
        left, turn = table[i][k], turns[i]
        if table[i + 1][k - 1] + DELETE - turn.isupper() == left:
            audit.append("D")
            i += 1
        elif j < m and goal[j] != "s" and table[i][k + 1] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if goal[j] == turn.lower() else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


@lru_cache(MEMO)
def align(pattern: str, entry: str) -> dict[str, tuple[int, str]]:
    """Cost and audit of the cheapest edits of a segment, from ``entry`` to each state.

    ``pattern`` has a letter a turn: its initial (o: none of the three), upper case when cut
    off, or x where the turn must go."""
    gone = [len(run) for run in "".join("." if c != "x" else c for c in pattern).split(".")]
    turns = pattern.replace("x", "")
    fixed = DELETE * sum(gone) + sum(map(str.isupper, turns))
    drops = sum(DELETE - t.isupper() for t in turns)
    found, n = {}, len(turns)
    for leave in STATES:
        best, limit, apart = None, None, 0
        while (limit is None and apart <= n + 2) or (limit is not None and 2 * apart <= limit):
            for length in sorted({n - apart, n + apart}):
                goal = target(entry, leave, length) if length >= 0 else None
                if goal is None or ("s" in goal and "s" not in turns.lower()) or (goal and not n):
                    continue
                # leaving out every turn, and putting in every other: always a way
                most = drops + INSERT * length
                limit = most if limit is None else min(limit, most)
                got = banded(turns, goal, limit)
                if got is not None and (best is None or got < best):
                    best, limit = got, got[0]
            apart += 1
        if best is None:
            continue
        # turns that must go are left out as soon as they are met: D is the least letter
        audit, at = ["D" * gone[0]], 0
        for c in best[1]:
            audit.append(c)
            if c != "I":
                at += 1
                audit.append("D" * gone[at])
        found[leave] = (best[0] + fixed, "".join(audit))
    return found


def follow(before: dict, after) -> dict:
    """Best cost and audit by end state, from those before a segment and ``after``: the
    table of the segment by entry."""
    out = {}
    for entry, (cost, audit) in before.items():
        for leave, (more, edits) in after(entry).items():
            made = (cost + more, audit + edits)
            if leave not in out or made < out[leave]:
                out[leave] = made
    return out


def closed(states: dict) -> tuple[int, str]:
    """The cheapest whole: each end state with the turns put in that its string lacks."""
    return min(
        (cost + INSERT * len(CLOSING[s]), audit + "I" * len(CLOSING[s]))
        for s, (cost, audit) in states.items()
    )


def cheapest(pattern: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    states = {"S": (0, "")}
    for a in range(0, len(pattern), SEGMENT):
        segment = pattern[a : a + SEGMENT]
        states = follow(states, lambda entry, own=segment: align(own, entry))
    return closed(states)


def letter(role: str, text: str, gone: bool) -> str:
    """A turn's letter in a pattern."""
    if gone:
        return "x"
    own = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return own if text.rstrip(BLANKS)[-1] in STOPS else own.upper()


def expected_role(audit: str) -> Iterator[str]:
    """For each edit, the initial that stands there after the repair ('' where it leaves a
    turn out). The number of turns left tells whether a system turn begins."""
    left = len(audit) - audit.count("D")
    at = -1 if left % 2 else 0
    for c in audit:
        if c == "D":
            yield ""
        else:
            yield "s" if at < 0 else "ua"[at % 2]
            at += 1


def repaired(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each turn that the repair leaves."""
    for edit, initial in zip(audit, expected_role(audit), strict=True):
        role, text = ("", "") if edit == "I" else next(rows)
        if edit != "D":
            yield edit, role if edit == "K" else NAMES[initial], text


COUNTS = ("blank", "duplicate", "truncated", "illegal")
RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
DIGEST = f"{RESULT}, repaired_sha256 string"
TURNS = "conv_id bigint, position bigint, edit string, role string, text string"


def report(turns: list, rows: list[tuple[str, str]]) -> dict:
    """What ails a conversation, and its cheapest repair; ``rows`` are role and text."""
    seen, pattern = set(), []
    out = dict.fromkeys(COUNTS, 0)
    for at, (role, text) in enumerate(rows):
        if not text.strip(BLANKS):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = None
        seen.add((role, text))
        pattern.append(letter(role, text, fault is not None))
        if pattern[-1].isupper():
            fault = "truncated"
        if fault:
            out[fault] += 1
        if at and rows[at - 1][0][:1] + role[:1] not in LEGAL:
            out["illegal"] += 1
    known = {t for t in turns if t is not None}
    out["gaps"] = max(known) - min(known) + 1 - len(known) if known else 0
    out["cost"], out["audit"] = cheapest("".join(pattern))
    return out


def line_hash(rows: Iterator[tuple[str, str, str]]) -> str:
    digest, between = hashlib.sha256(), ""
    for _, role, text in rows:
        digest.update(f"{between}{role}:{text}".encode())
        between = "\n"
    return digest.hexdigest()


# ------------------------------------------------------------------------ on Spark


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple]:
    """(key, columns, whether the key goes on) of sorted rows, a slice at a time."""
    last = None  # a slice is given once what follows it is known
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE_ROWS):
            columns = batch.slice(a, SLICE_ROWS).to_pydict()
            keys, start = columns[key], 0
            for end in range(1, len(keys) + 1):
                if end == len(keys) or keys[end] != keys[start]:
                    if last is not None:
                        yield (*last, last[0] == keys[start])
                    last = (keys[start], {c: v[start:end] for c, v in columns.items()})
                    start = end
    if last is not None:
        yield (*last, False)


def _whole(rows: DataFrame, schema: str, turns: bool) -> DataFrame:
    """Conversations of bounded length, each worked on whole."""
    sorted_ = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = StructType.fromDDL(schema)

    def run(batches):
        arrow, out, held = to_arrow_schema(kind), [], None
        for conv, columns, goes_on in runs(batches, "conv_id"):
            if held is None:
                held = ([], [])
            for turn, role, text, n in zip(*(columns[c] for c in ("turn", "role", "text", "copies"))):
                held[0].extend([turn] * n)
                held[1].extend([(role, text)] * n)
            if goes_on:
                continue
            found = report(*held)
            made = repaired(iter(held[1]), found["audit"])
            if turns:
                out += [
                    {"conv_id": conv, "position": i, "edit": e, "role": r, "text": t}
                    for i, (e, r, t) in enumerate(made)
                ]
            else:
                out.append({"conv_id": conv, **found, "repaired_sha256": line_hash(made)})
            held = None
            if len(out) >= SLICE_ROWS:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return sorted_.mapInArrow(run, kind)


SEGMENTS = (
    "conv_id bigint, part bigint, seg bigint, first string, last string, blank bigint, "
    "duplicate bigint, truncated bigint, illegal bigint, entries array<string>, "
    "leaves array<string>, costs array<bigint>, audits array<string>"
)
SEGMENT_NAMES = [column.split()[0] for column in SEGMENTS.split(", ")]


def _table(tables: dict[str, dict]) -> dict:
    flat = [(e, s, *found) for e, own in tables.items() for s, found in own.items()]
    return dict(zip(("entries", "leaves", "costs", "audits"), ([list(x)] for x in zip(*flat))))


def _segment(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One segment of a long conversation, aligned from every state."""
    rows = rows.sort_values("_at")
    pattern, initials = [], []
    for own, n, gone in zip(rows["letter"], rows["n"], rows["gone"]):
        pattern.append("x" * n if gone else own + "x" * (n - 1))
        # of equal rows, two tell all about the pairs they make
        initials.append((rows["initial"].iloc[len(initials)], n))
    illegal = sum((n - 1) * (i + i not in LEGAL) for i, n in initials)
    illegal += sum(a[0] + b[0] not in LEGAL for a, b in zip(initials, initials[1:]))
    whole = "".join(pattern)
    tables = {}
    for entry in STATES:
        states = {entry: (0, "")}
        for a in range(0, len(whole), SEGMENT):
            own = whole[a : a + SEGMENT]
            states = follow(states, lambda e, own=own: align(own, e))
        tables[entry] = states
    counts = {c: [int(rows[c].sum())] for c in ("blank", "duplicate", "truncated")}
    out = {"first": [initials[0][0]], "last": [initials[-1][0]], "illegal": [illegal]}
    return pd.DataFrame(
        {"conv_id": [rows["conv_id"].iloc[0]], "part": [key[1]], "seg": [key[2]], **out, **counts, **_table(tables)}
    )[SEGMENT_NAMES]


def _joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring segments as one."""
    rows = rows.sort_values(["part", "seg"])
    tables = []
    for r in rows.itertuples():
        own = {}
        for e, s, cost, audit in zip(r.entries, r.leaves, r.costs, r.audits):
            own.setdefault(e, {})[s] = (int(cost), audit)
        tables.append(own)
    made = {}
    for entry in STATES:
        states = {entry: (0, "")}
        for own in tables:
            states = follow(states, own.__getitem__)
        made[entry] = states
    counts = {c: [int(rows[c].sum())] for c in COUNTS}
    ends = zip(rows["last"].iloc[:-1], rows["first"].iloc[1:])
    counts["illegal"][0] += sum(a + b not in LEGAL for a, b in ends)
    out = {"first": [rows["first"].iloc[0]], "last": [rows["last"].iloc[-1]]}
    return pd.DataFrame(
        {"conv_id": [rows["conv_id"].iloc[0]], "part": [key[1]], "seg": [key[2]], **out, **counts, **_table(made)}
    )[SEGMENT_NAMES]


def _combined(segments: DataFrame) -> DataFrame:
    """Segments joined ``FANOUT`` at a time until each conversation is one row."""
    while True:
        segments = settle(segments, "segments")
        most_seg, most_part = segments.agg(F.max("seg"), F.max("part")).first()
        if not most_seg and not most_part:
            return segments
        if most_seg:
            keys = F.col("part").alias("_p"), F.expr(f"seg div {FANOUT}").alias("_s")
        else:
            keys = F.expr(f"part div {FANOUT}").alias("_p"), F.lit(0).cast("bigint").alias("_s")
        grouped = segments.groupBy("conv_id", *keys)
        segments = grouped.applyInPandas(_joined, SEGMENTS)


def _close(rows: DataFrame) -> DataFrame:
    """The cheapest whole of each conversation, from its one remaining segment."""
    kind = StructType.fromDDL(RESULT.replace("gaps bigint, ", ""))

    def run(batches):
        arrow = to_arrow_schema(kind)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                flat = zip(r["entries"], r["leaves"], r["costs"], r["audits"])
                cost, audit = closed({s: (c, a) for e, s, c, a in flat if e == "S"})
                counts = {c: r[c] for c in COUNTS}
                out.append({"conv_id": r["conv_id"], **counts, "cost": cost, "audit": audit})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, kind)


def _streamed(turns: DataFrame, audits: DataFrame, schema: str, as_turns: bool) -> DataFrame:
    """Long conversations again, as streams that each begin with their audit."""
    kind = StructType.fromDDL(schema)
    order = ["conv_id", "_head", "turn", "role", "text"]
    heads = audits.select("conv_id", F.lit(0).alias("_head"), F.col("audit"))
    body = turns.select("conv_id", F.lit(1).alias("_head"), "turn", "role", "text", "n")
    both = heads.unionByName(body, allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions(*order)

    def run(batches):
        arrow = to_arrow_schema(kind)

        def stream():
            for conv, columns, goes_on in runs(batches, "conv_id"):
                names = ("_head", "audit", "role", "text", "n")
                for row in zip(*(columns[c] for c in names)):
                    yield conv, row
                if not goes_on:
                    yield conv, None

        rows = stream()
        for conv, head in rows:
            audit, kept = head[1], []

            def turns_of():
                for _, row in rows:
                    if row is None:
                        return
                    for _ in range(row[4]):
                        yield row[2], row[3]

            source = turns_of()
            made = repaired(source, audit)
            if as_turns:
                for i, (e, r, t) in enumerate(made):
                    kept.append({"conv_id": conv, "position": i, "edit": e, "role": r, "text": t})
                    if len(kept) >= SLICE_ROWS:
                        yield pa.RecordBatch.from_pylist(kept, schema=arrow)
                        kept = []
            else:
                kept.append({"conv_id": conv, "repaired_sha256": line_hash(made)})
            for _ in source:  # to the end mark
                pass
            yield pa.RecordBatch.from_pylist(kept, schema=arrow)

    return both.mapInArrow(run, kind)


def _long(rows: DataFrame, as_turns: bool) -> DataFrame:
    """Conversations of any length, in segments."""
    present = rows.where("copies > 0")
    n = F.sum("copies").alias("n")
    equal = present.groupBy("conv_id", "turn", "role", "text").agg(n)
    equal = equal.withColumn("_said", F.sha2(F.concat_ws(":", "role", "text"), 256))
    equal = settle(equal, "turns")
    # the first turn of each thing said; nulls come first in a struct too
    first = equal.groupBy(F.col("conv_id").alias("_c"), F.col("_said").alias("_first_said")).agg(
        F.min(F.struct("turn")).alias("_first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_said") == F.col("_first_said"))
    repeated = ~F.col("turn").eqNullSafe(F.col("_first.turn"))
    bare = F.rtrim("text", F.lit(BLANKS))
    cut = ~F.right(bare, F.lit(1)).isin(*STOPS)
    initial = F.left("role", F.lit(1))
    own = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    blank = bare == ""
    gone = blank | F.col("repeated")
    parts = max(
        rows.sparkSession.sparkContext.defaultParallelism,
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    order = ["turn", "role", "text"]
    dealt = (
        equal.join(first, same)
        .withColumn("repeated", repeated)
        .select("conv_id", *order, "n", "repeated")
        .repartitionByRange(parts, "conv_id", *order)
        .withColumn("part", F.spark_partition_id().cast("bigint"))
    )
    dealt = settle(dealt, "dealt")
    thin = dealt.select(
        "conv_id",
        "part",
        *order,
        "n",
        initial.alias("initial"),
        gone.alias("gone"),
        F.when(cut, F.upper(own)).otherwise(own).alias("letter"),
        F.when(blank, F.col("n")).otherwise(0).alias("blank"),
        F.when(~blank, F.col("n") - F.when(F.col("repeated"), 0).otherwise(1)).otherwise(0).alias("duplicate"),
        F.when(~gone & cut, 1).otherwise(0).alias("truncated"),
    )
    within = Window.partitionBy("conv_id", "part").orderBy(*order)
    at = F.row_number().over(within).cast("bigint") - 1
    thin = thin.withColumn("_at", at).drop(*order).withColumn("seg", F.expr(f"_at div {SEGMENT}"))
    segments = thin.groupBy("conv_id", "part", "seg").applyInPandas(_segment, SEGMENTS)
    found = settle(_close(_combined(segments)), "audits")
    if as_turns:
        return _streamed(dealt, found, TURNS, True)
    hashes = _streamed(dealt, found, "conv_id bigint, repaired_sha256 string", False)
    hashes = hashes.withColumnRenamed("conv_id", "_h")
    once = equal.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy(F.col("conv_id").alias("_g"))
    low, high = F.min("turn").cast("decimal(20,0)"), F.max("turn").cast("decimal(20,0)")
    gaps = once.agg(F.coalesce((high - low + 1 - F.count("turn")).cast("bigint"), F.lit(0)).alias("gaps"))
    joined = found.join(hashes, F.col("conv_id").eqNullSafe(F.col("_h")))
    joined = joined.join(gaps, F.col("conv_id").eqNullSafe(F.col("_g")))
    return joined.select(*StructType.fromDDL(DIGEST).names)


def repair(
    rows: DataFrame, *, copies: Column | None = None, turns: bool = False, long_rows: int = LONG_ROWS
) -> DataFrame:
    """The faults and the cheapest repair of each conversation: one row each, with the
    audit and a hash of the repaired lines (``DIGEST``), or with ``turns`` the repaired turns
    themselves (``TURNS``).

    ``rows`` has conv_id, turn, role and text. ``copies`` is how often a row counts; rows that
    count 0 times only name their conversation.
    """
    one = F.lit(1) if copies is None else copies
    table = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        one.cast("bigint").alias("copies"),
    )
    schema = TURNS if turns else DIGEST
    sizes = table.groupBy(F.col("conv_id").alias("_long")).agg(F.sum("copies").alias("n"))
    long_ids = settle(sizes.where(F.col("n") > long_rows).select("_long"), "long")
    if long_ids.isEmpty():
        return _whole(table, schema, turns)
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    short = _whole(table.join(long_ids, same, "left_anti"), schema, turns)
    return short.unionByName(_long(table.join(long_ids, same, "left_semi"), turns))


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` with some turns dropped, emptied, cut, repeated or given to the user, picked
    by their ids, and the column that says how often each counts."""
    space = F.lit(" ")
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    )
    table = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("damage"),
    )
    kind = F.col("damage")
    cut = F.regexp_replace("text", "[.!?]", "")
    table = table.withColumns(
        {
            "role": F.when(kind == 4, "user").otherwise(F.col("role")),
            "text": F.when(kind == 1, "").when(kind == 2, cut).otherwise(F.col("text")),
        }
    )
    return table, F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)


def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = damaged(read(spark, sf_dir, "conversations"))
    return repair(rows, copies=copies)
