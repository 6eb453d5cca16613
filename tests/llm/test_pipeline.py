"""The pipeline, stage by stage, against plain versions on the whole table."""

import corpus_pipeline
import pytest
from test_tables import plain_components
from txrisk.llm import decontamination, packing, quality_gam, secrets
from txrisk.llm.tables import read
from txrisk.llm.tokens import encoder, vocabulary_path


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage got and gave."""
    out, docs = {}, read(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        out[name] = ({r.doc_id: r for r in docs.collect()}, made.collect(), docs.schema, made.schema)
        docs = made
    return out


def test_documents_keep_their_columns(stages):
    for name, (_, _, before, after) in list(stages.items())[:-1]:
        assert before == after, name


def test_quality_stage(spark, sf_dir, stages):
    docs, kept, _, _ = stages["quality_classifier"]
    labels = read(spark, sf_dir, "labels")
    scored = quality_gam.score_quality(read(spark, sf_dir, "documents"), labels).collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in scored if r.predicted}
    assert len(kept) < len(docs)


def test_near_duplicate_stage(stages):
    docs, kept, _, _ = stages["near_duplicates"]
    expected = plain_components([(d, r.text) for d, r in docs.items()])
    assert {r.doc_id for r in kept} == {d for d, (_, c) in expected.items() if c == d}


def test_decontamination_stage(spark, sf_dir, stages):
    docs, kept, _, _ = stages["decontamination"]
    items = [decontamination.words_of(r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    lines = {f" {' '.join(w)} " for w in items}
    texts = {d: f" {' '.join(decontamination.words_of(r.text))} " for d, r in docs.items()}
    exact = {d for d, t in texts.items() if any(x in t for x in lines)}
    left = {r.doc_id for r in kept}
    assert not exact & left
    matcher = decontamination.Matcher([(1, " ".join(w)) for w in items])
    assert left == {d for d, r in docs.items() if not matcher.matches(r.text)}


def test_secret_stage(stages):
    docs, kept, _, _ = stages["secret_scan"]
    assert {r.doc_id for r in kept} == set(docs)
    for r in kept:
        before = docs[r.doc_id].text
        assert r.text == secrets.redact(before, secrets.all_spans(before))
        assert r.n_chars == len(r.text) and not secrets.base_spans(r.text)


def test_packing_stage(stages):
    docs, pieces, _, _ = stages["packing"]
    held = {}
    for p in sorted(pieces, key=lambda p: p.start):
        held.setdefault(p.doc_id, []).extend(p.ids)
    names = list(docs)
    ids = encoder(vocabulary_path()).encode([docs[d].text for d in names])
    assert held == {d: [*x.tolist(), 1] for d, x in zip(names, ids, strict=True)}
    assert packing.piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]


def test_stages_take_odd_documents(spark, sf_dir):
    rows = [(None, None, "a"), (1, "", "b"), (1, "", "b"), (2**60 + 1, "token = 'abcdefghijklmnop'", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, grp string")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, sf_dir)
    # of the repeated row one stays
    assert sorted(map(str, docs.collect())) == sorted(
        map(str, spark.createDataFrame([(None, None, "a"), (1, "", "b"), (2**60 + 1, "[SECRET]'", None)], docs.schema).collect())
    )
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0
