"""The pipeline's stages, each against a plain version on its own input."""

import collections

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as P
from shoplens.llm import catalog, mixing, pii, quality, segment
from shoplens.llm.common import materialize
from tests.conftest import SF_SMALL

from .conftest import edge_pairs, make_docs
from .test_joins import brute
from .test_native import base_spans


@pytest.fixture(scope="module")
def stages(spark, docs):
    out = [docs]
    for name, stage in P.STAGES:
        out.append(materialize(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def test_names_and_order():
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "ngram_jaccard_join", "pii", "mixing", "sentencepiece"]
    assert P.ORACLE_SQL is None


def test_columns_stay_until_the_last_stage(stages, docs):
    for table in stages[:-1]:
        assert table.columns == docs.columns and table.dtypes == docs.dtypes


def test_quality_stage_keeps_what_the_scores_keep(spark, stages):
    model = quality.fit_on(stages[0], spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    good = {r.doc_id for r in quality.quality_scores(stages[0], model).collect() if r.predicted == 1}
    assert {r.doc_id for r in stages[1].collect()} == good


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before = sorted((r.doc_id, r.text) for r in stages[1].collect())
    want, _, sets = brute(before, 5, 80)
    assert sorted(r.doc_id for r in stages[2].collect()) == [i for i, _, least in want if i == least]


def test_personal_data_stage(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r.text for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, text in before.items():
        spans = base_spans(text)
        if not spans and "token" not in text.lower():
            assert after[i] == text
        for _, a, b in spans:
            assert text[a:b] not in after[i]


def test_mixing_stage_repeats_rows_by_rate(spark, stages):
    domains = mixing.fit_domains(stages[3], catalog.domain_labels(spark, SF_SMALL))
    mix = mixing.fit_mix(mixing._posterior_table(stages[3], domains, "doc_id", "text"), domains, catalog.PIPELINE_WEIGHTS)
    count = collections.Counter(r.doc_id for r in stages[4].collect())
    for r in stages[3].collect():
        _, p = domains.posteriors([r.text.encode()])
        rate = mix.rate(p)[0]
        assert int(np.floor(rate)) <= count[r.doc_id] <= int(np.floor(rate)) + 1


def test_pieces_stage_spells_its_input(stages):
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    out = segment.decode_ids(stages[5]).collect()
    assert len(out) == stages[4].count() and all(r.decoded == texts[r.doc_id] and r.round_trip for r in out)


def test_pieces_stage_keeps_both_samples(spark, stages):
    fields = ("sample", "ids", "n_pieces", "log_prob", "perturbed", "inclusion", "round_trip")
    flat = lambda i, r: (i, *[str(r[f]) for f in fields])
    want = sorted(flat(r.doc_id, r) for r in segment.sample_segmentations(stages[4], k=2).collect())
    got = stages[5].collect()
    assert sorted([flat(r.doc_id, r) for r in got] + [flat(r.doc_id, o) for r in got for o in r.others]) == want
    assert all([o.sample for o in r.others] == [1] and r.others[0].ids != r.ids for r in got if r.n_pieces > 1)


def test_python_stages_get_small_batches(spark, docs):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["size", "rows"])

    wide = make_docs(spark, [(n, "word " * 50_000) for n in range(40)]).coalesce(1)
    limit = spark.conf.get(P.BATCH_SETTING)
    for name, stage in P.STAGES:
        spark.conf.set(P.BATCH_SETTING, str(64 << 20))
        stage(spark, docs, SF_SMALL)
        if name != "pii":  # its redaction runs without Python workers
            got = wide.mapInArrow(sizes, "size long, rows long").collect()
            assert sum(r["rows"] for r in got) == 40 and max(r["size"] for r in got) < 3 << 20, name
    spark.conf.set(P.BATCH_SETTING, limit)


def test_run_writes_every_stage(spark, stages):
    got = P.run(spark, SF_SMALL)
    key = lambda r: (r.doc_id, r.sample, r.n_pieces, str(r.ids))
    assert sorted(map(key, got.collect())) == sorted(map(key, stages[-1].collect()))


@pytest.mark.parametrize("case", ["edge", "empty"])
def test_every_stage_takes_odd_tables(spark, docs, case):
    table = make_docs(spark, edge_pairs() if case == "edge" else [])
    for _, stage in P.STAGES:
        table = materialize(stage(spark, table, SF_SMALL), "odd")
    assert case == "edge" or table.count() == 0
    assert {"doc_id", "ids"} <= set(table.columns)


def test_redaction_keeps_other_columns(spark):
    table = make_docs(spark, edge_pairs())
    assert pii.redact(table).columns == table.columns
