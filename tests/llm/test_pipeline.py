import corpus_pipeline as C

from tallyline.llm import decontaminate, mixing, pii, simhash, toxicity
from tallyline.llm.base import QUERIES, table

from . import cases

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "mixing"]


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    marks, bench = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    step = C.without_toxic(spark, docs, SF)
    model = toxicity.fit(docs, marks)
    assert ids(step) == ids(toxicity.tag(docs, model).where("predicted = 0")) and step.columns == docs.columns
    one = C.without_near_copies(spark, step, SF)
    assert ids(one) == ids(simhash.near_copies(step).where("doc_id = component_id")) and one.columns == docs.columns
    clean = C.without_leaks(spark, one, SF)
    bad = {r["doc_id"] for r in decontaminate.leaks(one, bench).collect()}
    assert ids(clean) == [k for k in ids(one) if k not in bad] and clean.columns == docs.columns
    private = C.without_personal_data(spark, clean, SF)
    assert ids(private) == ids(clean) and private.columns == docs.columns
    assert not pii.find(private).where("n_email + n_card > 0").count()
    last = C.mixed(spark, private, SF)
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(private).where("size > 0").collect()}
    got = {}
    for r in last.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert all(got.get(k, 0) == n for k, n in want.items())


def test_run_chains_the_stages(spark, monkeypatch):
    monkeypatch.setattr(C, "STAGES", [(str(k), lambda s, docs, d, k=k: docs.where(docs.doc_id % 5 != k)) for k in range(4)])
    assert {r["doc_id"] % 5 for r in C.run(spark, SF).select("doc_id").collect()} == {4}


def test_stages_take_awkward_rows(spark):
    df = cases.table(spark, cases.edges()[:9])
    for name, stage in C.STAGES:
        out = stage(spark, df, SF)
        assert out.columns[: len(df.columns)] == df.columns, name
        df = out.select(*df.columns)
    assert df.count()
