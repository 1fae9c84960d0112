"""Toxicity, language and quality: brute force for what is defined, held-out accuracy for what is learned."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import language as L
from tallyline.llm import quality as Q
from tallyline.llm import toxicity as X

from . import cases

SF = "/root/testdata/sf0.01"


def out_of_training(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 == 2


def labels(spark, rows, column):
    return spark.createDataFrame(rows, f"doc_id long, {column} int")


def toxic_rows(n=600):
    bad = ["zorkish", "blarghed", "zorkly"]
    rows, marks = [], []
    for k in range(n):
        own = cases.words(60, k)
        if k % 5 == 0:
            own[k % 60] = bad[k % 3].upper() if k % 2 else bad[k % 3] + ","
        rows.append((k, " ".join(own), "en", "a"))
        marks.append((k, int(k % 5 == 0)))
    return rows, marks


def test_toxicity_learns_words_and_beginnings(spark):
    rows, marks = toxic_rows()
    extra = cases.edges()[:7] + cases.edges()[8:]
    # an ending never seen in training
    df = cases.table(spark, rows + [(10_000, cases.prose(30, 1) + " é zorkoid " + cases.prose(30, 2), "en", "a")] + [(None if r[0] is None else r[0] + 20_000, *r[1:]) for r in extra[:-1]])
    model = X.fit(df, labels(spark, marks + [(5, None), (None, 1)], "toxic"))
    got = {r["doc_id"]: r for r in X.tag(df, model).collect()}
    held = [k for k, _ in marks if out_of_training(k)]
    assert sum(got[k]["predicted"] == dict(marks)[k] for k in held) >= 0.98 * len(held)
    assert all(r["held_out"] == out_of_training(k) for k, r in got.items())
    text, spans = df.where("doc_id = 10000").head()["text"], got[10_000]["spans"]
    assert got[10_000]["predicted"] == 1 and "zorkoid" in [text[s["start"] : s["end"]] for s in spans]
    assert got[20_001]["score"] == got[20_002]["score"] < 0.3 and got[20_009]["predicted"] == 0
    kept = X.drop_toxic(df, model)
    assert kept.columns == df.columns and kept.where("doc_id < 600").count() == sum(got[k]["predicted"] == 0 for k, _ in marks)


def test_toxicity_without_labels(spark):
    df = cases.table(spark, cases.edges())
    model = X.fit(df, labels(spark, [], "toxic"))
    assert {r["predicted"] for r in X.tag(df, model).collect()} == {0} and X.drop_toxic(df, model).count() == df.count()
    assert X.tag(cases.empty(spark), model).count() == 0


def test_field_matches_enumeration():
    rng = np.random.default_rng(3)
    emission, trans = rng.normal(size=5), rng.normal(size=(2, 2))
    total, ones = 0.0, np.zeros(5)
    for code in range(32):
        y = [code >> t & 1 for t in range(5)]
        weight = np.exp(sum(emission[t] for t in range(5) if y[t]) + sum(trans[y[t], y[t + 1]] for t in range(4)))
        total += weight
        ones += weight * np.array(y)
    padded, mask = np.append(emission, [9.0, 9.0])[None], np.array([[True] * 5 + [False] * 2])
    marginal, pair, log_z = X.forward_backward(padded, trans, mask)
    assert np.allclose(marginal[0, :5], ones / total) and np.isclose(log_z[0], np.log(total)) and np.isclose(pair.sum(), 4)


def test_offsets_survive_lower_case():
    model = X.Model(odds={"zorkish": 5.0, "zork-": 5.0, "zorki-": 5.0}, begins={"zork"}, weights=np.array([-2.0, 1, 1, 0, 0, 0, 0, 0]), slope=1.0, bias=0.0)
    text = "İİ ok Zorkish ß"
    assert [text[s:e] for s, e in X.mark([text], model)[1][0]] == ["Zorkish"]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = L.learn(docs)
    pred = L.predict(docs, made).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert pred.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).head()[0] >= 0.97
    once, again = (sorted(L.predict(docs, m).collect()) for m in (made, L.learn(docs.repartition(3))))
    assert once == again


def test_language_edges(spark):
    df = cases.table(spark, cases.edges())
    got = {r["doc_id"]: r for r in L.predict(df, L.learn(df)).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == got[3]["lang_pred"] == got[8]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 and r["held_out"] == out_of_training(k) for k, r in got.items())
    assert got[9]["lang_pred"] in {"en", "fr", "de"}
    assert {r["lang_pred"] for r in L.predict(df, {}).collect()} == {"und"} and L.learn(cases.empty(spark)) == {}


def brute_counts(text):
    text = text or ""
    words = [x.decode() for x in text.encode().split()]
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {k for i, t in enumerate(threes) if threes.count(t) > 1 for k in (i, i + 1, i + 2)} if len(threes) < 3000 else None
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again) if again is not None else None


def test_quality_counts_match_brute_force(spark):
    texts = ["a b c a b c d", "x x x x x", "line one\nline one\n\n \nline one \nline two", "#a *b $c%& | <> é\U0001f600", "1 2 3\n1 2 3", "\n\n\n", "w\x1fw w\x85w w\x1fw w\x85w q"]
    rows = [r for r in cases.edges() if r[0] != 9] + [(50 + k, t, "en", "a") for k, t in enumerate(texts)]
    got = Q.judge(cases.table(spark, rows), labels(spark, [], "quality")).collect()
    have = sorted(((r["doc_id"], *[r[c] for c in Q.COUNTS[:5]], r["base_failed"], r["kept"]) for r in got), key=str)
    want = []
    for r in rows:
        c = brute_counts(r[1])
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want.append((r[0], *c, failed, not failed))
    assert have == sorted(want, key=str)
    long = Q.judge(cases.table(spark, [r for r in cases.edges() if r[0] == 9]), labels(spark, [], "quality")).head()
    assert long["n_words"] == 60_000 and Q.judge(cases.empty(spark), labels(spark, [(1, 0)], "quality")).count() == 0


def test_quality_rules_are_learned(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.judge(docs, marks).join(marks, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.02 * n[1, True] and n[0, False] > 0.7 * (n[0, False] + n.get((0, True), 0))


def test_rules_cover_what_they_should():
    rng = np.random.default_rng(1)
    values = {f: rng.random(900) for f in Q.FEATURES}
    bad = (values["symbol_share"] > 0.8) | ((values["upper_share"] > 0.5) & (values["word_length"] < 0.3))
    rules = Q.learn_rules(values, bad)
    out = np.zeros(900, bool)
    for rule in rules:
        out |= Q._covers(rule, values, 900)
    assert (out == bad).mean() > 0.95
