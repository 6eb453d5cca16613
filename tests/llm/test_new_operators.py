"""Conversation repair, source mixing and vector codes, against plain versions and on odd
tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.llm import conversations, dual_tree, mixing
from txrisk.llm.tables import read

WS = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------------ conversation repair


def plain_repair(rows):
    """(cost, audit, repaired lines) by trying every edit, state by state."""
    memo = {}

    def best(i, state, forced):
        # the states of the grammar; the cheapest (cost, audit, lines) from here on
        key = (i, state)
        if key in memo:
            return memo[key]
        after = {"s": {"S": "P"}, "u": {"S": "A", "P": "A", "U": "A"}, "a": {"A": "U"}}
        options = []
        if i == len(rows) and state in "SU":
            options.append((0, "", []))
        if i < len(rows):
            role, text = rows[i]
            cost, audit, lines = best(i + 1, state, forced)
            options.append((cost + 3, "D" + audit, lines))
            if not forced[i]:
                late = text.rstrip(WS)[-1] not in ".!?"
                for name, edit, price in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    to = after.get(name[:1], {}).get(state)
                    if to:
                        cost, audit, lines = best(i + 1, to, forced)
                        options.append((cost + price + late, edit + audit, [f"{name}:{text}", *lines]))
        # at most two turns put in between two others can help
        for puts in (["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]):
            at = state
            for p in puts:
                at = after[p[0]].get(at) if at else None
            if at and (i, at) != key:
                if i < len(rows):
                    base = take_turn(i, at, forced)
                else:
                    base = [(0, "", [])] if at in "SU" else []
                for cost, audit, lines in base:
                    options.append((cost + 2 * len(puts), "I" * len(puts) + audit, [p + ":" for p in puts] + lines))
        if i < len(rows):
            # an even number put in leads back to the same state
            pair = {"U": ["user", "assistant"], "A": ["assistant", "user"]}.get(state)
            if pair:
                for cost, audit, lines in take_turn(i, state, forced):
                    options.append((cost + 4, "II" + audit, [p + ":" for p in pair] + lines))
        found = min(options, key=lambda o: o[:2]) if options else (10**9, "", [])
        memo[key] = found
        return found

    def take_turn(i, state, forced):
        """The ways on from here that use the next turn."""
        after = {"s": {"S": "P"}, "u": {"S": "A", "P": "A", "U": "A"}, "a": {"A": "U"}}
        role, text = rows[i]
        cost, audit, lines = best(i + 1, state, forced)
        out = [(cost + 3, "D" + audit, lines)]
        if not forced[i]:
            late = text.rstrip(WS)[-1] not in ".!?"
            for name, edit, price in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                to = after.get(name[:1], {}).get(state)
                if to:
                    cost, audit, lines = best(i + 1, to, forced)
                    out.append((cost + price + late, edit + audit, [f"{name}:{text}", *lines]))
        return out

    seen, forced, faults = set(), [], Counter()
    for role, text in rows:
        bare = text.strip(WS)
        if not bare:
            faults["blank"] += 1
        elif (role, text) in seen:
            faults["duplicate"] += 1
        elif bare[-1] not in ".!?":
            faults["truncated"] += 1
        forced.append(not bare or (role, text) in seen)
        seen.add((role, text))
    cost, audit, lines = best(0, "S", forced)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = (faults["blank"], faults["duplicate"], faults["truncated"], illegal)
    return (*counts, cost, audit, digest), lines


def plain_gaps(turns):
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def plain_conversations(rows):
    """The registered query over (conv_id, turn, role, text), row by row."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        own = held[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        damage = zlib.crc32(key.encode()) % 20
        if damage == 1:
            text = ""
        if damage == 2:
            text = re.sub("[.!?]", "", text)
        if damage == 4:
            role = "user"
        own.extend([(turn, role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1))
    out = {}
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        found, _ = plain_repair([r[1:] for r in own])
        out[conv] = (plain_gaps([r[0] for r in own]), *found)
    return out


def as_result(df):
    names = ["gaps", *conversations.COUNTS, "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    found = {r["conv_id"]: tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


SAID = ["Yes.", "No!", "cut off", "", " \n", "Yes.", "why?", "x. \t", "é", " "]
ROLES = ["user", "assistant", "user", "assistant", "system", "tool", " ", ""]


def random_turns(pick, most):
    return [(pick.choice(ROLES), pick.choice(SAID) + str(pick.choice(["", "", i])) + pick.choice(["", "."]))
            for i in range(pick.randint(0, most))]


def test_cheapest_repair_equals_trying_all():
    pick = random.Random(3)
    for _ in range(1500):
        rows = random_turns(pick, 9)
        found = conversations.report([None] * len(rows), rows)
        expected, lines = plain_repair(rows)
        assert tuple(found[c] for c in (*conversations.COUNTS, "cost", "audit")) == expected[:6]
        made = list(conversations.repaired(iter(rows), found["audit"]))
        assert [f"{r}:{t}" for _, r, t in made] == lines
        assert conversations.line_hash(iter(made)) == expected[6]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _ in made))


@pytest.mark.parametrize("segment", [1, 2, 3, 7])
def test_segments_give_the_whole(monkeypatch, segment):
    pick = random.Random(segment)
    for _ in range(400):
        pattern = "".join(pick.choice("suaoSUAxxua") for _ in range(pick.randint(0, 14)))
        monkeypatch.setattr(conversations, "SEGMENT", 64)
        expected = conversations.cheapest(pattern)
        monkeypatch.setattr(conversations, "SEGMENT", segment)
        assert conversations.cheapest(pattern) == expected


def conversation_frame(spark, rows):
    schema = "conv_id bigint, turn bigint, role string, text string, copies int, letter string"
    return spark.createDataFrame([(*r, 7, "n") for r in rows], schema)


def odd_conversations():
    pick = random.Random(11)
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, 3, "user", "Hi."), (2**60, 2**60, "user", "End.")]
    for conv in range(60):
        turn = 0
        for role, text in random_turns(pick, 12):
            turn += pick.choice([1, 1, 1, 2, 0])
            rows.append((conv, pick.choice([turn, turn, turn, None]), role, pick.choice([text, text, text, None])))
    rows += [(100, i, "ua"[i % 2] + "x", "w" * 30_000 + f" {i}.") for i in range(6)]
    rows += [(200, i % 150, pick.choice(ROLES[:5]), f"{pick.choice(SAID)} {i % 90}.") for i in range(400)]
    rows += [(201, 4, "user", "the same.")] * 300 + [(201, None, "assistant", "")] * 200
    return rows


@pytest.mark.parametrize("long_rows", [4096, 40, 3])
def test_conversations(spark, long_rows, monkeypatch):
    monkeypatch.setattr(conversations, "FANOUT", 3)
    rows = odd_conversations()
    table, copies = conversations.damaged(conversation_frame(spark, rows))
    found = as_result(conversations.repair(table, copies=copies, long_rows=long_rows))
    assert found == plain_conversations(rows)


@pytest.mark.parametrize("long_rows", [4096, 5])
def test_repaired_turns(spark, long_rows):
    rows = [r for r in odd_conversations() if r[0] is not None and r[0] < 60]
    df = conversation_frame(spark, rows)
    turns = conversations.repair(df, turns=True, long_rows=long_rows).collect()
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        got = sorted((r for r in turns if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in got] == list(range(len(got)))
        assert [f"{r.role}:{r.text}" for r in got] == plain_repair([r[1:] for r in own])[1]


def test_conversation_query(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()
    got = as_result(conversations.repaired_conversations(spark, sf_dir))
    assert got == plain_conversations([tuple(r) for r in rows])


def test_no_conversations(spark):
    empty = conversation_frame(spark, [])
    assert conversations.repair(empty).count() == 0
    gone = conversations.repair(conversation_frame(spark, [(1, 1, "user", "a.")]), copies=F.lit(0))
    assert as_result(gone) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# ----------------------------------------------------------------------- source mixing


def plain_targets(sizes, weights, most=3):
    """Shares by weight, the excess of full sources reshared until none is above."""
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        if not open_:
            return {s: float(most * sizes[s]) for s in sizes}
        shares = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = {s for s in open_ if shares[s] > most * sizes[s]}
        if not over:
            return {**{s: float(most * sizes[s]) for s in full}, **shares}
        full |= over


DOC_SCHEMA = "doc_id bigint, text string, source string, size string, copies string, _row int"


def mixing_docs(spark):
    pick = random.Random(2)
    rows = [(i, "w " * pick.choice([1, 2, 5, 40, 300]), f"s{i % 4}") for i in range(800)]
    rows += [(i, "a", "s1") for i in range(3000, 5000)]
    rows += [(9000, "hot hot hot", None)] * 500 + [(None, None, "s2"), (None, "", "s2"), (7, "w" * 200_000, "s2")]
    rows += [(i, "", "no words") for i in range(8000, 8020)] + [(8100, "a b\x85c\x1f d", "s3"), (8101, " \t\n ", "")]
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DOC_SCHEMA), rows


@pytest.mark.parametrize("part_rows", [2_000_000, 100])
def test_mixing(spark, part_rows):
    docs, rows = mixing_docs(spark)
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    table = mixing.repeating_weights(mixing.sized(docs))
    assert {r.source: r.weight for r in table.collect()} == weights
    got = mixing.mix(docs, table, part_rows=part_rows).collect()
    words = [len((t or "").encode().split()) for _, t, _ in rows]
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (d, s, n) for (d, _, s), n in zip(rows, words)
    )
    sizes, longest, taken = Counter(dict.fromkeys(names, 0)), Counter(), Counter()
    for (_, _, s), n in zip(rows, words):
        sizes[s] += n
        longest[s] = max(longest[s], n)
    expected = plain_targets(sizes, weights)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source], rel=1e-12)
        rate = expected[r.source] / max(sizes[r.source], 1)
        assert int(rate) <= r.copies <= min(int(rate) + 1, 3)
        taken[r.source] += r.copies * r.size
    assert taken.total() > 0
    for s in names:
        assert abs(taken[s] - expected[s]) <= 2 * longest[s] + 1e-6 * expected[s]


def test_mixing_repeats(spark):
    docs, _ = mixing_docs(spark)
    table = mixing.repeating_weights(mixing.sized(docs))
    columns = ["doc_id", "size", "source_size", "target", "copies"]
    first = mixing.mix(docs, table).select(columns).collect()
    again = mixing.mix(docs.repartition(13, "text"), table, part_rows=70).select(columns).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))
    taken = mixing.take(docs, table)
    assert taken.columns == docs.columns
    kept = Counter()
    for r in first:
        kept[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in taken.collect()) == +kept


def test_no_documents_to_mix(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert mixing.mix(empty, mixing.repeating_weights(mixing.sized(empty))).count() == 0
    bare = spark.createDataFrame([(1, None, None, "", "", 1)], DOC_SCHEMA)
    row = mixing.mix(bare, mixing.repeating_weights(mixing.sized(bare))).first()
    assert (row.source_size, row.target, row.copies) == (0, 0.0, 0)


# ------------------------------------------------------------------------ vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(codes and errors by row, codebooks) of kept rows, every entry compared."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dims]
    ints = np.array([[int(np.floor(4096 * float(x))) for x in r[1]] for r in kept], np.int64).reshape(len(kept), dims)
    pieces = np.array_split(np.arange(dims), parts)
    codes, error, books = [], np.zeros(len(kept), np.int64), []
    for piece in pieces:
        p = ints[:, piece]
        c = p[:entries].copy()
        for r in range(rounds + 1):
            d = ((p[:, None, :] - c[None]) ** 2).sum(axis=2)
            near = d.argmin(axis=1)
            if r < rounds:
                for e in range(len(c)):
                    if (near == e).any():
                        own = p[near == e]
                        c[e] = [int(x) // len(own) for x in own.sum(axis=0)]
        codes.append(near)
        error += d.min(axis=1)
        books.append(c)
    by_label = Counter()
    for r, e in zip(kept, error):
        by_label[r[2]] += int(e)
    out = Counter(
        (r[0], "".join(f"{c[i]:02x}" for c in codes), int(error[i]), by_label[r[2]]) for i, r in enumerate(kept)
    )
    return out, hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()


VECTORS = "vec_id bigint, embedding array<float>, label int, codes string, error double"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 0.5) for r in rows], VECTORS)


def coded(spark, rows, monkeypatch=None):
    class Reader:
        parquet = staticmethod(lambda path: vector_frame(spark, rows).repartition(3))

    class Session:
        read = Reader

    got = dual_tree.vector_codes(Session, "").collect()
    hashes = {r.codebooks_sha256 for r in got}
    return Counter((r.vec_id, r.code, r.error, r.label_error) for r in got), hashes


def clustered(seed, n, dims, spread=0.02):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 1, (12, dims))
    x = centers[rng.integers(0, 12, n)] + rng.normal(0, spread, (n, dims))
    return [(int(i), [float(np.float32(v)) for v in row], int(i % 5) or None) for i, row in enumerate(x)]


@pytest.mark.parametrize("rows", [
    clustered(1, 700, 24),
    clustered(2, 300, 64, 1.0),
    clustered(3, 9, 16),
    clustered(4, 50, 5),
    [*clustered(5, 100, 8), *clustered(5, 100, 8), *[(-3, [0.25] * 8, 9)] * 40, (None, [1.0] * 8, None),
     (500, None, 1), (501, [float("nan")] * 8, 1), (502, [None, *[1.0] * 7], 1),
     (503, [float("inf"), *[1.0] * 7], 1), (504, [1.0] * 7, 1), (505, [], 1)],
], ids=["tight", "loose", "few", "uneven", "odd"])
@pytest.mark.parametrize("cells", [1 << 18, 600])
def test_vector_codes(spark, rows, cells, monkeypatch):
    monkeypatch.setattr(dual_tree, "BLOCK_CELLS", cells)
    expected, digest = plain_codes(rows)
    assert coded(spark, rows) == (expected, {digest})


def test_no_vectors(spark):
    assert dual_tree.compress(vector_frame(spark, []))[0].count() == 0
    assert dual_tree.compress(vector_frame(spark, [(1, None, 2)]))[0].count() == 0
    with pytest.raises(Exception, match="too large"):
        dual_tree.compress(vector_frame(spark, [(1, [4096.0] * 8, 2)]))


def test_bounds_settle_whole_nodes():
    points = np.array([r[1] for r in clustered(6, 2000, 4)]) * 4096 // 1
    tree = dual_tree.build(points.astype(np.int64), dual_tree.LEAF)
    assert sorted(tree.order.tolist()) == list(range(2000))
    entries = points[:16].astype(np.int64)
    codes, counts, sums, whole = dual_tree.assign(tree, entries, dual_tree.build(entries, 1))
    d = ((tree.points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (codes == d.argmin(axis=1)).all() and whole > 500
    assert (counts == np.bincount(codes, minlength=16)).all()
    assert all((sums[e] == tree.points[codes == e].sum(axis=0)).all() for e in range(16))
