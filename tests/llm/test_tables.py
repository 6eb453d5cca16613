"""Operators over whole tables, against plain versions and on odd tables."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from txrisk.llm import near_duplicates, quality_gam, rotated_codes, signatures, substrings, url_filter

BIG = 2**60 + 1


# ------------------------------------------------------------------------ near duplicates


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_components(rows):
    sets, where = {d: shingle_set(t) for d, t in rows}, defaultdict(list)
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for d, s in sets.items():
        shared = Counter(e for q in s for e in where[q])
        for e, both in shared.items():
            if 100 * both >= 75 * (len(s) + len(sets[e]) - both):
                a, b = find(d), find(e)
                top[max(a, b)] = min(a, b)
        for q in s:
            where[q].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def edited(pick, words, share):
    return [pick.choice(VOCABULARY) if pick.random() < share else w for w in words]


VOCABULARY = [a + b for a in "klmnprst" for b in "aeiouy"]


def test_near_duplicates(spark):
    pick = random.Random(5)
    texts = [None, "", " \n", "one", "One", "two words", "four little words here", "a b c d e"]
    passage = pick.choices(VOCABULARY, k=40)
    for n in (6, 12, 30, 80, 300):
        base = pick.choices(VOCABULARY, k=n)
        for share in (0, 0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.2):
            texts.append(" ".join(edited(pick, base, share)))
            texts.append(" ".join(edited(pick, base, share)).upper())
    texts += [" ".join(passage + pick.choices(VOCABULARY, k=pick.randint(5, 30))) for _ in range(60)]
    rows = [(i + 3, t, "x", "y") for i, t in enumerate(texts)]
    rows += [(BIG, texts[20], "x", "y"), (None, texts[21], "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest string, label string")
    out = near_duplicates.near_duplicates(docs).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    expected = plain_components([r[:2] for r in rows if r[0] is not None])
    assert got == expected and len(out) == len(expected)
    kept = near_duplicates.drop_near_copies(docs)
    assert kept.schema == docs.schema
    firsts = {d for d, (_, c) in expected.items() if d == c}
    assert {r.doc_id for r in kept.collect()} == firsts | {None}


def test_near_duplicates_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates.near_duplicates(none).count() == 0


def test_linked_sets_share_a_signature():
    pick = np.random.default_rng(4)
    domain = np.unique(pick.integers(0, 2**63, 60_000, dtype=np.uint64))
    frequent = np.sort(domain[:20_000])
    for size in [*range(1, 60), 100, 250, 700, 2000] * 3:
        a = pick.choice(domain, size, replace=False)
        most = size // 3
        out, into = pick.integers(0, most + 1, 2)
        b = np.union1d(a[out:], pick.choice(domain, into, replace=False))
        a = np.sort(a)
        if len(b) and signatures.linked(a, b) and not np.array_equal(a, b):
            for often in (None, frequent):
                both = [signatures.signatures(s, often) for s in (a, b)]
                assert len(np.intersect1d(*both)), (size, len(b), often is None)


@pytest.mark.parametrize("groups", [1, 7, 64])
def test_documents_with_several_texts(spark, monkeypatch, groups):
    layout = near_duplicates.C.layout
    monkeypatch.setattr(near_duplicates.C, "layout", lambda docs: (groups, *layout(docs)[1:]))
    pick = random.Random(11)
    one, two, three, four = (pick.choices(VOCABULARY, k=n) for n in (60, 80, 100, 120))
    near = lambda words: " ".join([*words, "end"])
    rows = [
        (5, " ".join(one)), (5, " ".join(two)), (8, near(one)), (9, near(two)),  # links by either text
        (20, " ".join(three)), (21, " ".join(four)), (22, " ".join(three)), (22, " ".join(four)),
        (23, near(four)), (30, "alone in a class of its own"), (30, ""), (31, " "),
        (40, "same class"), (40, "SAME  class"), (40, "same class"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near_duplicates.near_duplicates(docs).collect()
    top = {5: 5, 8: 5, 9: 5, 20: 20, 21: 20, 22: 20, 23: 20, 30: 30, 31: 31, 40: 40}
    expected = Counter((d, len(shingle_set(t)), top[d]) for d, t in rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == expected


def test_texts_of_repeated_words(spark):
    texts = [" ".join(["na"] * n) for n in (4, 5, 6, 40)] + ["- " * 5, "-\n" * 9, "na " * 39 + "no"]
    texts += ["tick tock " * 3, "tick tock " * 20, "a b c " * 3, "a b c " * 9]
    rows = list(enumerate(texts))
    out = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}
    assert got == plain_components(rows)
    assert [got[d][1] for d in range(1, 6)] == [1, 1, 1, 4, 4]


def test_equal_sets_share_a_signature():
    pick = np.random.default_rng(6)
    for size in range(1, 40):
        a = np.unique(pick.integers(0, 2**63, size, dtype=np.uint64))
        for often in (None, a):
            both = [signatures.signatures(a.copy(), often) for _ in range(2)]
            assert len(np.intersect1d(*both)), (size, often is None)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    pick = random.Random(9)
    base = pick.choices(VOCABULARY, k=40)
    rows = [(i, " ".join(edited(pick, base, 0.04))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near_duplicates.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == plain_components(rows)


def test_buckets_of_blocks_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    monkeypatch.setattr(near_duplicates, "BUCKET_ROWS", 200)

    def rows_of(members, sets):
        return pd.DataFrame({"a": [len(sets)], "b": [len(members)]})

    monkeypatch.setattr(near_duplicates, "_weigh_cells", rows_of)
    groups = spark.range(400).selectExpr("7L AS sig", "id AS doc_id")
    labels = spark.createDataFrame([], "node bigint, label bigint")
    held = groups.selectExpr("doc_id", "40L AS n", "cast('' AS binary) AS items")
    out = near_duplicates._second_round(groups, labels, held).collect()
    assert 0 < max(r.b for r in out) < 1000  # of 40,000 rows
    assert max(r.a for r in out) < 1000
    # groups that hang together share a cell, where a set is sent once
    groups = spark.range(400).selectExpr("id div 4 AS sig", "id % 40 AS doc_id").distinct()
    out = near_duplicates._second_round(groups, labels, held).collect()
    assert sum(r.a for r in out) == 40 and sum(r.b for r in out) == 400


@pytest.mark.parametrize("two", [False, True])
def test_a_cell_weighs_each_pair_once(monkeypatch, two):
    monkeypatch.setattr(near_duplicates, "AT_ONCE", 7)
    pick = np.random.default_rng(8)
    for _ in range(60):
        base = np.unique(pick.integers(0, 2**63, int(pick.choice([12, 90, 400])), dtype=np.uint64))
        sets = [np.sort(pick.choice(base, max(1, int(len(base) * pick.uniform(0.6, 1))), replace=False)) for _ in range(24)]
        label = np.minimum(pick.integers(100, 124, 24), np.arange(100, 124))
        own = pick.integers(0, 2, 24) if two else np.zeros(24, int)
        groups = [(g, int(d)) for g in range(9) for d in pick.choice(24, int(pick.integers(1, 9)), replace=False)]
        frame = pd.DataFrame({"doc_id": range(24), "label": label, "own": own, "n": list(map(len, sets))})
        frame["fine"] = list(map(near_duplicates.fine_sketch, sets))
        sig, doc = (np.array(c) for c in zip(*groups))
        got = near_duplicates._weigh_cell(sig, doc, frame.sample(frac=1, random_state=1), two)
        got = [tuple(r) for some in got for r in some.tolist()]
        assert len(got) == len(set(got))
        pairs = {(a, b) for g, a in groups for h, b in groups if g == h and a < b and (own[a] != own[b] or not two)}
        pairs = {(a, b) for a, b in pairs if label[a] != label[b]}
        assert {(a, b) for a, b in pairs if signatures.linked(sets[a], sets[b])} <= set(got) <= pairs
        alike = [len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a, b in got]
        assert min(alike, default=1) > (0.6 if len(base) > 80 else 0)


@pytest.mark.parametrize("size", [400, 1500])
def test_long_texts_that_are_alike_but_not_linked(spark, monkeypatch, size):
    monkeypatch.setattr(near_duplicates, "CELL_ROWS", 500)
    pick = random.Random(size)
    base = [f"w{i}" for i in range(size + 4)]
    rows = []
    for i in range(40):  # similarity to each other about 0.55 to 0.8
        words = list(base)
        for at in pick.sample(range(size), int(size * pick.uniform(0.015, 0.035))):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    out = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    expected = plain_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == expected
    assert 1 < len({c for _, c in expected.values()}) < 40


def test_all_documents_count_for_frequent_shingles(spark):
    # 15,000 passages of four documents each: a sample of the 60,000 documents misses most
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('a passage of four ', id div 4) AS text")
    found = near_duplicates.frequent_shingles(docs)
    passages = [signatures.shingles(f"a passage of four {i}") for i in range(15_000)]
    assert len(found) > 14_900 and np.isin(found, np.concatenate(passages)).all()
    assert (np.diff(found.view(np.int64).astype(object)) != 0).all()


def test_sets_are_made_of_the_documents_in_pairs_only(spark):
    texts = [f"words that stand for document {i % 7}" for i in range(40)]
    rows = [*enumerate(texts), (3, texts[3]), (4, "another text of document four"), (4, None)]
    docs = near_duplicates.tables.texts(spark.createDataFrame(rows, "doc_id bigint, text string"))
    pairs = spark.createDataFrame([(3, 4), (4, 30)], "a bigint, b bigint")
    out = near_duplicates.sets_of_pairs(pairs, docs).collect()
    got = Counter((r.doc_id, tuple(near_duplicates.C.unpack_sorted(r["items"]).tolist())) for r in out)
    ends = [(3, texts[3]), (4, texts[4]), (4, rows[-2][1]), (4, ""), (30, texts[30])]
    assert got == Counter((d, tuple(signatures.shingles(t).tolist())) for d, t in ends)
    assert "items" not in near_duplicates.HELD  # the others' sets are not kept


def test_fine_sketches_differ_no_more_than_sets():
    pick = np.random.default_rng(3)
    for size in [*range(120, 136), *range(1020, 1030)] * 4:  # the number of cells doubles at 128, 1024
        b = np.unique(pick.integers(0, 2**63, size, dtype=np.uint64))
        a = b[int(pick.integers(0, 6)) :]
        one, other = map(near_duplicates.fine_sketch, (a, b))
        cells = near_duplicates.fine_cells([one, other], 4 * min(len(one), len(other)))
        apart = np.abs(cells[0].astype(int) - cells[1]).sum()
        assert apart <= len(b) - len(a) and near_duplicates.fine_apart(one, other) == apart


def exchanged(n=10):
    """The Thue-Morse word of 2^n letters, and the same with letters exchanged."""
    swap = str.maketrans("ab", "ba")
    word = "a"
    for _ in range(n):
        word += word.translate(swap)
    return word, word.translate(swap)


def test_words_that_exchange_letters_are_different(spark):
    one, two = exchanged()
    hashes = [near_duplicates.C.word_hashes(f"{one} {two}", family=f).tolist() for f in (0, 1)]
    assert len({h for pair in hashes for h in pair}) == 4
    rows = [(1, f"p q {one} r s"), (2, f"p q {two} r s"), (3, f"P Q {one} R S")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    around = [f"u{i}" for i in range(34)]
    rows = [(i, " ".join([*around[:17], w, *around[17:]])) for i, w in ((1, one), (2, two))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r.n_removed for r in substrings.remove_repeats(docs).collect()] == [0, 0]


def test_one_row_of_each_component_stays(spark):
    same = "a b c d e f g h"
    rows = [(7, same, "x"), (7, same, "x"), (7, same, None), (8, same, "y"), (9, "other words", "z"),
            (10, "first text of it", "k"), (10, "a second text", "j"), (11, "", "e"), (11, "", "e"),
            (12, None, "n"), (12, None, "n"), (None, same, "no id"), (None, same, "no id")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, _often string")
    out = near_duplicates.drop_near_copies(docs)
    assert out.schema == docs.schema
    expected = [(7, same, None), (9, "other words", "z"), (10, "a second text", "j"), (11, "", "e"),
                (12, None, "n"), (None, same, "no id"), (None, same, "no id")]
    assert Counter(map(tuple, out.collect())) == Counter(expected)


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)]
    out = near_duplicates.components(spark.createDataFrame(links, "a bigint, b bigint"))
    got = {r.node: r.label for r in out.collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


# ------------------------------------------------------------------------ nearest vectors


def test_nearest_vectors(spark):
    pick = np.random.default_rng(0)
    x = pick.normal(size=(400, 16)).astype(np.float32)
    x[100:160] = x[0]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [
        (1000, None, "x"), (1001, [0.0] * 16, "x"), (1002, [float("nan")] + [1.0] * 15, "x"),
        (1003, [float("inf")] + [1.0] * 15, "x"), (1004, [None] + [1.0] * 15, "x"),
        (1005, [], "x"), (1050, [1.0, 2.0], "x"), (1051, [2.0, 1.0], "x"), (None, [1.0] * 16, "x"),
        (7, x[7].tolist(), "x"),
    ]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, code string")
    queries = vectors.filter("vec_id % 50 = 0")
    full = x.astype(float)
    for blocks in (8192, 64):
        out = rotated_codes.nearest(vectors, queries, base_block=blocks, query_block=3).collect()
        got = defaultdict(list)
        for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
            got[r.query_id].append((r.rank, r.vec_id, r.score))
        assert set(got) == {*range(0, 400, 50), 1050}
        for q in range(0, 400, 50):
            score = rotated_codes.cosines(full, full[q])
            best = [i for i in np.lexsort((np.arange(400), -score)) if i != q][:5]
            assert [v for _, v, _ in got[q]] == best
            assert np.allclose([s for _, _, s in got[q]], score[best], rtol=0, atol=1e-15)
            assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        assert [(r, v) for r, v, _ in got[1050]] == [(1, 1051)]
    assert rotated_codes.nearest(vectors.limit(0), queries).count() == 0


def test_recall_on_the_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    table = vectors.toPandas()
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"].tolist()).astype(float)
    out = rotated_codes.rotated_codes(spark, sf_dir).toPandas()
    found = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        score = rotated_codes.cosines(x, x[i])
        best = [j for j in np.lexsort((ids, -score)) if j != i][:5]
        found += len(set(ids[best]) & set(out[out["query_id"] == ids[i]]["vec_id"]))
        total += 5
    assert found / total >= 0.9


def test_estimates_keep_their_bound():
    pick = np.random.default_rng(1)
    x, q = pick.normal(size=(2000, 32)), pick.normal(size=32)
    codes, factor = rotated_codes.encode(x, 128)
    signs = np.unpackbits(codes, axis=1) * 2.0 - 1
    turned = rotated_codes.unit(q[None])[0] @ rotated_codes.rotation(32, 128).T
    estimate = signs @ turned / np.sqrt(128) / factor
    error = rotated_codes.BOUND * np.sqrt(1 - factor**2) / factor / np.sqrt(127)
    assert np.mean(np.abs(estimate - rotated_codes.cosines(x, q)) <= error) > 0.99


# ---------------------------------------------------------------------------- url filter


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/a?b", "http://example.org",
    "http://example.org/en/1x", "http://notexample.org/es/", "https://a.com/fr/#x", "x://a.com/de/?q://b",
    "http://É.com/de/", "http://spam-farm.example.net/a", "http://b.net/?utm_source=feed", "http://b.net/",
    "http://b.net/p?utm_source=x", "http://b.net/p", "http://b.net/q", "http://b.net/q",
]


@pytest.mark.parametrize("shard_keys", [1_000_000, 2])
def test_url_filter(spark, shard_keys):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(BIG, "http://b.net/p", "h"), (None, URLS[4], "h")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, listed string")
    listed = url_filter.listed_keys(pages)
    out = url_filter.judge_urls(pages, listed, shard_keys=shard_keys)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    sql = "SELECT page_id, host, path, rule, verdict FROM (" + url_filter.SQL + ")"
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted(con.execute(sql).fetchall(), key=repr)
    assert url_filter.judge_urls(pages.limit(0), listed).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, listed.limit(0), rules=[]).collect()} == {"allow"}


def test_cascade_is_exact():
    pick = np.random.default_rng(0)
    for n, listed in ((1, 0), (1, 1), (2, 1), (5000, 100), (5000, 4900), (5000, 0)):
        h1, h2 = pick.integers(0, 2**63, (2, n), dtype=np.uint64)
        mark = np.arange(n) < listed
        cascade = url_filter.build_cascade(h1, h2, mark)
        assert (url_filter.ask_cascade(cascade, h1, h2) == mark).all()


def test_cascades_too_large_for_one_broadcast(spark):
    keys = spark.range(2000).selectExpr("cast(id as string) key", "id % 7 = 0 listed")
    made, shards = url_filter.cascades(keys, 100)
    out = url_filter.in_list(keys.select("key"), made, shards, limit=500).collect()
    assert len(out) == 2000 and all(r.listed == (int(r.key) % 7 == 0) for r in out)


# ----------------------------------------------------------------------- quality classifier


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality_gam.quality_gam(spark, sf_dir)
    rows = out.filter("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_and_other_columns_are_not_used(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    score = lambda d, m: {r.doc_id: r.score for r in quality_gam.score_quality(d, m).collect()}
    held = quality_gam.held_out(labels["doc_id"])
    flipped = labels.selectExpr("*").withColumn(
        "quality", (1 - labels["quality"]) * held.cast("int") + labels["quality"] * (~held).cast("int")
    )
    other = docs.selectExpr("doc_id", "text", "'xx' lang", "'s' source", "0 features", "1.0 score")
    assert score(docs, labels) == score(other, flipped)


def test_quality_of_odd_tables(spark):
    rows = [(None, "no id", 1), (BIG, "big id", 2), (1, None, 3), (2, "", 4), (2, "x " * 9000, 5), (3, "a b", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, y int")
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id bigint, quality int"
    )
    out = quality_gam.score_quality(docs, labels).collect()
    assert len(out) == 6 and {r.doc_id for r in out} == {None, BIG, 1, 2, 3}
    nothing = quality_gam.score_quality(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in nothing} == {(1.0, 1)}
    assert quality_gam.score_quality(docs.limit(0), labels).count() == 0
    kept = quality_gam.keep_accepted(docs, labels.limit(0))
    assert kept.schema == docs.schema and kept.count() == 6


def test_labels_of_absent_documents_take_no_place(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id bigint, text string")
    labels = spark.range(20_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    there = quality_gam.label_sample(labels, docs, fit_rows=500).count()
    usable = quality_gam.usable_labels(labels).where("doc_id < 200").count()
    assert there == usable > 100
    assert quality_gam.label_sample(labels, docs, fit_rows=50).count() == 50
