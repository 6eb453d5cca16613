"""N-gram Jaccard join: groups of documents whose sets of five-word shingles overlap by 0.75.

Equal texts (after lower-casing and with white space evened out) are one class, compared
once. The signatures of ``signatures`` say which classes to compare. Groups of texts learn
from buckets which of their signatures another text shares (``codes``), so signatures
nobody shares, nearly all, are never turned into rows.

Classes that share a signature are compared in two rounds. First each is compared with one
member of the signature's group, picked by hash: that links most near copies with few
comparisons. Then, in groups that still hold several components, all pairs across
components are weighed once, where they meet, by sketches (how many shingles fall in each of two to
four times as many cells as the sets have, which bounds the overlap from above, so no linked
pair is lost), and what is left is compared in full. Every pair that shares a signature is
thus compared, already in one component, or proven not to be linked.

Cases: a missing or empty text has no shingles and is linked with nothing; under five words,
all words make one shingle; rows without doc_id take no part and are not returned; rows
with the same doc_id are one document, linked by either text, whose rows have the number of
shingles of their own text; repeated rows are returned each; an empty table gives no rows; other columns are not read (``drop_near_copies`` hands
them on).
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import codes as C
from txrisk.llm import signatures as S
from txrisk.llm import tables
from txrisk.sources.stages import materialize

STRETCH, FREQUENT_IN, FREQUENT_MOST = 4_000_000, 4, 500_000
CELLS = 128
BLOCK = 1024
BUCKET_ROWS, CELL_ROWS, AT_ONCE = 20_000, 50_000, 500
CHARS_AT_ONCE = 100_000  # texts whose sets are made together; a longer one by itself
TURNS = 2  # in which pairs are compared in full
NONE = xxhash.xxh3_128_digest(b"")


def digest_of(text: str) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(text.encode().lower().split()))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, text digest (of lower-cased words) and group of every document."""

    def rows(some: dict) -> dict:
        return {**some, "digest": [digest_of(t) for t in some.pop("text")]}

    return tables.map_slices(docs, lambda: rows, "doc_id bigint, grp bigint, digest binary")


def text_runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Where runs of texts begin and end whose sets are made together."""
    first = chars = 0
    for i, text in enumerate(texts):
        if i > first and chars + len(text) > CHARS_AT_ONCE:
            yield first, i
            first, chars = i, 0
        chars += len(text)
    if len(texts) > first:
        yield first, len(texts)


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of many documents, ascending: all documents are counted, in stretches of
    about ``STRETCH`` shingles as they lie, and those that ``FREQUENT_IN`` documents of a
    stretch hold are frequent; of more than ``FREQUENT_MOST``, those most often held. Any list
    gives the same links; this one keeps passages that many documents share from making them
    all look alike."""

    def often(parts: list[np.ndarray]) -> pd.DataFrame:
        items = np.sort(np.concatenate(parts))
        starts = np.flatnonzero(np.r_[True, items[1:] != items[:-1]])
        held = np.diff(starts, append=len(items))
        most = held >= FREQUENT_IN
        return pd.DataFrame({"shingle": items[starts[most]].view(np.int64), "held": held[most]})

    def rows(batches):
        parts, size = [], 0
        for batch in batches:
            texts = batch["text"].tolist()
            for a, z in text_runs(texts):
                parts.append(S.shingle_sets(texts[a:z])[0])
                size += len(parts[-1])
                if size >= STRETCH:
                    yield often(parts)
                    parts, size = [], 0
        if size:
            yield often(parts)

    counted = tables.spread(docs).select("text").mapInPandas(rows, "shingle bigint, held bigint")
    summed = counted.groupBy("shingle").agg(F.sum("held").alias("held"))
    top = summed.orderBy(F.col("held").desc(), "shingle").limit(FREQUENT_MOST)
    found = top.select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def sketch(items: np.ndarray) -> np.ndarray:
    cell = (items >> np.uint64(40)).astype(np.int64) % CELLS
    return np.minimum(np.bincount(cell, minlength=CELLS), 255).astype(np.uint8)


def may_link(size_a, sketch_a, size_b, sketch_b) -> np.ndarray:
    """Whether pairs (rows) can be linked: sketches differ by no more than linked sets may."""
    apart = np.abs(sketch_a.astype(np.int16) - sketch_b.astype(np.int16)).sum(axis=1, dtype=np.int64)
    return 7 * apart <= size_a + size_b


def _sketches(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, CELLS)


HELD = "doc_id bigint, digest binary, n bigint, sketch binary, fine binary, shared binary"


def candidates(docs: DataFrame, reps: DataFrame, layout: tuple, frequent) -> DataFrame:
    """Of each representative: its size and, if it shares a signature, its sketches and the
    signatures it shares. ``docs`` come with their groups."""
    _, buckets, bits = layout
    spare = np.uint64(64 - bits)
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def mine(texts: pd.DataFrame, ids):
        """The representatives among a group's texts, each once, as names, digests, sets one
        behind the other and their sizes, for some texts at a time."""
        wanted, rows = defaultdict(set), Counter(texts["doc_id"])
        for key in ids:
            wanted[int(key[16:])].add(key[:16])
        some = []
        for name, text in zip(texts["doc_id"], texts["text"], strict=True):
            own = wanted.get(name)
            if not own:
                continue
            digest = digest_of(text) if rows[name] > 1 else min(own)
            if digest in own:
                own.discard(digest)
                some.append((int(name), digest, text))
        for a, z in text_runs([text for _, _, text in some]):
            names, digests, texts = zip(*some[a:z], strict=True)
            yield names, digests, *S.shingle_sets(texts)

    def tell(key: tuple, texts: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(texts):
            return pd.DataFrame(columns=["bucket", "grp", "codes", "extra"])
        found = [S.signatures_of(*sets, held.value)[0] for _, _, *sets in mine(texts, own["ids"].iloc[0])]
        codes = np.concatenate(found) >> spare
        flags = np.full(len(codes), C.INDEXED, np.uint64)
        return C.send(key[0], codes, flags, None, bits, buckets)

    def shared(key: tuple, texts: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        # a reply with ids names the representatives; the others bring signatures
        ids = [key for some in replies["ids"].dropna() for key in some]
        met, out = C.Met(replies[replies["ids"].isna()]), []
        for names, digests, items, sizes in mine(texts, ids) if len(texts) else ():
            codes, owner = S.signatures_of(items, sizes, held.value)
            codes >>= spare
            hit = met.holds(codes)
            codes, owner = codes[hit], owner[hit]
            order = np.lexsort((codes, owner))
            bounds = np.searchsorted(owner[order], np.arange(len(sizes) + 1))
            ends = np.cumsum(sizes)
            for i, (a, z) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                own, row = np.unique(codes[order[a:z]]), (b"", b"")
                if len(own):
                    set_ = items[ends[i] - sizes[i] : ends[i]]
                    row = (sketch(set_).tobytes(), fine_sketch(set_))
                out.append((names[i], digests[i], int(sizes[i]), *row, C.pack_sorted(own)))
        return pd.DataFrame(out, columns=["doc_id", "digest", "n", "sketch", "fine", "shared"])

    # a document with several texts can represent several classes: its id alone is no name
    key = F.concat("digest", F.col("doc_id").cast("string").cast("binary"))
    by_group, listed = docs.groupBy("grp"), reps.groupBy("grp").agg(F.collect_set(key).alias("ids"))
    sent = by_group.cogroup(listed.groupBy("grp")).applyInPandas(tell, C.SENT)
    none = F.lit(None).cast("array<binary>").alias("ids")
    blank = F.lit(None).cast("binary")
    replies = C.met(sent).select("grp", "codes", "extra", none)
    named = listed.select("grp", blank.alias("codes"), blank.alias("extra"), "ids")
    both = replies.unionByName(named)
    return by_group.cogroup(both.groupBy("grp")).applyInPandas(shared, HELD)


def shared_rows(full: DataFrame) -> DataFrame:
    """sig and doc_id: a row for each signature a representative shares."""

    def rows(batches):
        for batch in batches:
            own = [C.unpack_sorted(raw).view(np.int64) for raw in batch["shared"]]
            ids = np.repeat(batch["doc_id"].to_numpy(), list(map(len, own)))
            yield pd.DataFrame({"sig": np.concatenate(own), "doc_id": ids})

    return full.select("doc_id", "shared").mapInPandas(rows, "sig bigint, doc_id bigint")


def sets_of_pairs(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and items, the sets of the documents in ``pairs`` (a, b), made from their texts
    anew: few of the documents that share a signature come this far."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    some = tables.spread(docs).join(tables.settle(ids, "ids"), "doc_id", "left_semi")

    def rows(some: dict) -> dict:
        texts, sets = some.pop("text"), []
        for a, z in text_runs(texts):
            items, sizes = S.shingle_sets(texts[a:z])
            sets += map(C.pack_sorted, np.split(items, np.cumsum(sizes)[:-1]))
        return {**some, "items": sets}

    made = tables.map_slices(some.select("doc_id", "text"), lambda: rows, "doc_id bigint, items binary")
    return tables.settle(made.distinct(), "sets")


def linked_pairs(pairs: DataFrame, held: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are linked. First sizes and sketches, then whole sets."""

    def with_both(rows, held, *columns):
        for side in ("a", "b"):
            own = [F.col(c).alias(f"{c}_{side}") for c in columns]
            rows = rows.join(held.select(F.col("doc_id").alias(side), *own), side)
        return rows

    near = with_both(pairs, held, "n", "sketch", "fine")
    near = near.filter(4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b"))

    def weigh(batches):
        for x in batches:
            sides = (x["n_a"].to_numpy(), _sketches(x["sketch_a"]), x["n_b"].to_numpy())
            x = x[may_link(*sides, _sketches(x["sketch_b"]))]
            apart = [fine_apart(p, q) for p, q in zip(x["fine_a"], x["fine_b"], strict=True)]
            yield x.loc[7 * np.array(apart, np.int64) <= x["n_a"] + x["n_b"], ["a", "b"]]

    def compare(batches):
        for x in batches:
            good = [
                S.linked(C.unpack_sorted(p), C.unpack_sorted(q))
                for p, q in zip(x["items_a"], x["items_b"], strict=True)
            ]
            yield x.loc[good, ["a", "b"]]

    pair = "a bigint, b bigint"
    close = tables.settle(near.mapInPandas(weigh, pair).distinct(), "close")
    sets = sets_of_pairs(close, docs)
    # in turns, so that not all sets lie beside a pair at one time
    turn, found = F.pmod(F.xxhash64("a", "b"), F.lit(TURNS)), None
    for i in range(TURNS):
        some = with_both(close.filter(turn == i), sets, "items").mapInPandas(compare, pair)
        some = tables.settle(some.distinct(), "linked")
        found = some if found is None else found.unionByName(some)
    return found


def components(links: DataFrame) -> DataFrame:
    """node and label (the least node it is connected with) of every node of ``links`` (a, b),
    by large-star and small-star steps, until they change nothing."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(edges.filter("u > v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u > v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = materialize(small.filter("u > v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label"))
    )


def _first_round(groups: DataFrame) -> DataFrame:
    """Each member of a signature's group with one picked by hash."""
    order = F.xxhash64("doc_id", F.pmod("sig", F.lit(4)))
    picked = groups.groupBy("sig").agg(F.min(F.struct(order, "doc_id")).getField("doc_id").alias("pick"))
    pairs = groups.join(picked, "sig").filter("doc_id != pick")
    return pairs.select(F.least("doc_id", "pick").alias("a"), F.greatest("doc_id", "pick").alias("b")).distinct()


CELL = ["fam", "blocks", "low", "high", "part"]


def _second_round(groups: DataFrame, labels: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs (a, b) across components within the groups, if their sketches (in ``held``, with
    doc_id) allow a link.

    Groups that hang together by their components make a cell, so a pair that shares many
    signatures meets in one cell, where it is weighed once. A group beyond ``BLOCK`` members is cut into blocks, each pair of blocks a cell, and a cell
    beyond ``CELL_ROWS`` rows into parts by the groups' least components."""
    named = groups.join(labels, groups["doc_id"] == labels["node"], "left")
    named = named.select("sig", "doc_id", F.coalesce("label", "doc_id").alias("label"))
    open_ = named.groupBy("sig").agg(
        F.min("label").alias("least"), F.max("label").alias("last"), F.count("*").alias("members")
    )
    blocks = F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")
    open_ = open_.filter("least < last").select("sig", "least", "members", blocks)
    open_ = tables.settle(open_, "open")
    stars = named.join(open_.select("sig", "least"), "sig").select("label", "least").distinct()
    top = components(stars.toDF("a", "b")).select(F.col("node").alias("least"), F.col("label").alias("fam"))
    open_ = open_.join(top, "least")
    copies = F.sum(F.col("members") * F.col("blocks")) / F.expr("blocks * (blocks + 1) div 2")
    parts = open_.groupBy("fam", "blocks").agg(F.ceil(copies / CELL_ROWS).cast("int").alias("parts"))
    placed = open_.join(parts, ["fam", "blocks"])
    part = F.pmod(F.xxhash64("least"), F.col("parts")).cast("int").alias("part")
    rows = named.join(placed.select("sig", "fam", "blocks", part), "sig")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = (F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = rows.select("fam", "blocks", *pair, "part", "own", "sig", "doc_id", "label")
    rows = tables.settle(rows, "cells")
    buckets = max(1, rows.count() // BUCKET_ROWS)  # most cells are small: many a bucket
    bucket = F.pmod(F.xxhash64(*CELL), F.lit(buckets)).alias("bucket")
    sets = rows.toDF(*rows.columns).select(*CELL, "own", "doc_id", "label").distinct()
    sets = sets.join(held, "doc_id")
    members = rows.select(bucket, *CELL, "sig", "doc_id").groupBy("bucket")
    sets = sets.select(bucket, *CELL, "own", "label", *held.columns).groupBy("bucket")
    return members.cogroup(sets).applyInPandas(_weigh_cells, "a bigint, b bigint").distinct()


def fine_sketch(items: np.ndarray) -> bytes:
    """How many of a set's shingles fall in each of two to four times as many cells as it has,
    up to three, two bits a cell. Fewer cells would let through pairs far from linked."""
    cells = max(2 << len(items).bit_length(), 4)
    cell = ((items >> np.uint64(20)) & np.uint64(cells - 1)).astype(np.int64)
    held = np.minimum(np.bincount(cell, minlength=cells), 3).astype(np.uint8).reshape(-1, 4)
    return (held[:, 0] | held[:, 1] << 2 | held[:, 2] << 4 | held[:, 3] << 6).tobytes()


def fine_cells(sketches: list[bytes], cells: int) -> np.ndarray:
    """Sketches side by side, on ``cells`` cells; on more, those with the same last bits are
    one, as these bits of a shingle name its cell, which then holds up to three, too."""
    out = np.zeros((len(sketches), cells), np.int8)
    sizes = np.fromiter(map(len, sketches), np.int64, len(sketches))
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        packed = np.frombuffer(b"".join(sketches[i] for i in at), np.uint8).reshape(len(at), -1, 1)
        held = (packed >> np.array([0, 2, 4, 6], np.uint8) & np.uint8(3)).astype(np.int8)
        held = held.reshape(len(at), -1, cells).sum(axis=1, dtype=np.int64)
        out[at] = np.minimum(held, 3)
    return out


def fine_apart(a: bytes, b: bytes) -> int:
    """In how many shingles two sets differ at least."""
    one, other = fine_cells([a, b], 4 * min(len(a), len(b)))
    return int(np.abs(one - other).sum(dtype=np.int64))


def _weigh_cells(members: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """The pairs of the cells of a bucket that may be linked."""
    out = [np.zeros((0, 2), np.int64)]
    by_cell = members.groupby(CELL, sort=False).indices
    for cell, at in sets.groupby(CELL, sort=False).indices.items():
        some = members.iloc[by_cell[cell]]
        two = cell[2] != cell[3]
        out += _weigh_cell(some["sig"].to_numpy(), some["doc_id"].to_numpy(), sets.iloc[at], two)
    return pd.DataFrame(np.concatenate(out), columns=["a", "b"])


def _weigh_cell(sig: np.ndarray, doc: np.ndarray, sets: pd.DataFrame, two: bool) -> list[np.ndarray]:
    """Pairs of a cell that may be linked, each once, of all documents that share a signature
    and have different labels. ``two``: only pairs across two blocks."""
    sets = sets.sort_values(["n", "doc_id"], kind="stable")
    ids, label, n, own = (sets[c].to_numpy() for c in ("doc_id", "label", "n", "own"))
    fine = sets["fine"].tolist()  # read where they are compared
    order = np.argsort(ids)
    who = order[np.searchsorted(ids, doc, sorter=order)]
    # members of each signature, and signatures of each member
    by_sig = np.lexsort((who, sig))
    member, cuts = who[by_sig], np.flatnonzero(np.diff(sig[by_sig])) + 1
    starts, ends = np.r_[0, cuts], np.r_[cuts, len(by_sig)]
    group = np.repeat(np.arange(len(starts)), ends - starts)
    by_doc = np.argsort(member, kind="stable")
    bounds = np.searchsorted(member[by_doc], np.arange(len(ids) + 1))
    out = []
    for p in range(len(ids)):
        seen = np.zeros(len(ids), bool)
        for g in group[by_doc[bounds[p] : bounds[p + 1]]]:
            seen[member[starts[g] : ends[g]]] = True
        # sizes ascend: the partners that follow, up to the largest that can be linked
        seen[: p + 1] = False
        seen[np.searchsorted(3 * n, 4 * n[p], side="right") :] = False
        seen &= label != label[p]
        if two:
            seen &= own != own[p]
        q = np.flatnonzero(seen)
        cells = 4 * len(fine[p])
        mine = fine_cells([fine[p]], cells)[0] if len(q) else None
        for start in range(0, len(q), AT_ONCE):
            some = q[start : start + AT_ONCE]
            theirs = fine_cells([fine[j] for j in some], cells)
            apart = np.abs(theirs - mine).sum(axis=1, dtype=np.int64)
            near = some[7 * apart <= n[some] + n[p]]
            if len(near):
                other = ids[near]
                out.append(np.stack([np.minimum(other, ids[p]), np.maximum(other, ids[p])], axis=1))
    return out


def _several_texts(digests: DataFrame) -> DataFrame:
    """doc_id of the documents with several texts that are not empty."""
    span = digests.filter(F.col("digest") != F.lit(NONE)).groupBy("doc_id")
    span = span.agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    return span.filter("low < high").select("doc_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id it is connected with) of every
    document."""
    rows = tables.texts(docs).filter("doc_id IS NOT NULL")
    layout = C.layout(rows)
    dealt = C.grouped(rows, layout[0])
    digests = tables.settle(classes(tables.spread(dealt)), "digests")
    rep = digests.groupBy("digest").agg(F.min(F.struct("doc_id", "grp")).alias("r"))
    reps = rep.select("digest", "r.doc_id", "r.grp")
    held = tables.settle(candidates(dealt, reps, layout, frequent_shingles(rows)), "held")
    full = held.filter(F.length("shared") > 0)
    members = shared_rows(full)
    several = tables.settle(_several_texts(digests), "several")
    repeated = several.limit(1).count() > 0
    if repeated:  # two texts of one document may share a signature
        members = members.distinct()
    # groups with the same members are compared once
    same = members.groupBy("sig").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("doc_id")).alias("x"),
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
    )
    same = same.filter("low < high").groupBy("n", "x", "low", "high")
    kept = same.agg(F.min("sig").alias("sig")).select("sig")
    groups = tables.settle(members.join(kept, "sig"), "groups")
    first = linked_pairs(_first_round(groups), full, rows)
    if repeated:  # a document links the classes of its texts
        theirs = digests.join(several, "doc_id").filter(F.col("digest") != F.lit(NONE))
        theirs = theirs.select(F.col("doc_id").alias("a"), "digest").join(rep, "digest")
        first = first.unionByName(theirs.select("a", F.col("r.doc_id").alias("b")).filter("a != b"))
    first = tables.settle(first, "links")
    labels = tables.settle(components(first), "labels")
    # what the second round links are components of the first
    second = _second_round(groups, labels, full.select("doc_id", "n", "fine"))
    second = tables.settle(linked_pairs(second, full, rows), "links")
    renamed = second
    for side in ("a", "b"):
        to = labels.select(F.col("node").alias(side), F.col("label").alias("to"))
        renamed = renamed.join(to, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    merged = components(renamed).select(F.col("node").alias("label"), F.col("label").alias("top"))
    ends = labels.unionByName(
        merged.select(F.col("label").alias("node"), "label").join(labels, "node", "left_anti").select("node", "label")
    )
    ends = ends.join(merged, "label", "left").select(
        F.col("node").alias("doc_id"), F.coalesce("top", "label").alias("top")
    )
    known = reps.join(held.select("digest", "n"), "digest", "left").join(ends, "doc_id", "left")
    known = known.select("digest", F.col("n"), F.coalesce("top", "doc_id").alias("top"))
    out = digests.select("doc_id", "digest").join(known, "digest")
    empty = F.col("digest") == F.lit(NONE)
    return out.select(
        "doc_id",
        F.when(empty, 0).otherwise(F.col("n")).cast("bigint").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("top")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the row of the least doc_id, and of rows with
    that doc_id the least by text, then by the other columns. Rows without doc_id stay."""
    found = near_duplicates(docs)
    key = docs["doc_id"].cast("bigint")
    gone = found.filter("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, key == gone["_gone"], "left_anti")
    often = found.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_more"))
    often = tables.settle(often, "often")
    if often.isEmpty():
        return kept
    # pre-aggregated where the rows lie, however often one is repeated
    same = kept["doc_id"].cast("bigint") == often["_more"]
    others = [kept[c] for c in docs.columns if c not in ("doc_id", "text")]
    least = F.min(F.struct(kept["text"], kept["doc_id"], *others)).alias("row")
    one = kept.join(often, same).groupBy(often["_more"]).agg(least).select("row.*")
    return kept.join(often, same, "left_anti").unionByName(one.select(*docs.columns))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(tables.read(spark, sf_dir, "documents"))
