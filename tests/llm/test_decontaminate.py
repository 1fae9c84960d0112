import pytest
from pyspark.sql import functions as F

from tallyline.llm import decontaminate as D
from tallyline.llm.base import Scratch

from . import cases


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


QUESTION = "A train leaves the station with Anna and travels 120 km in 2 hours before Anna meets Bert at the second bridge over the river."


def found(spark, texts, items):
    docs = cases.table(spark, [(k, t, "en", "a") for k, t in enumerate(texts)])
    return sorted((r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench(spark, items)).collect())


def test_reparameterised_questions(spark):
    texts = [
        "before " + QUESTION + " after", QUESTION.replace("Anna", "Carla").replace("Bert", "Dora").replace("120 km", "75 miles").replace("2 hours", "9 minutes"),
        QUESTION.replace("Anna and", "Carla and").replace("Anna meets", "Ines meets").replace("120", "7").replace("2 ", "3 "),
        "A train leaves the station " + cases.prose(60, 4), QUESTION.upper(), cases.prose(200, 5), None, "",
    ]
    got = found(spark, texts, [(1, QUESTION), (2, cases.prose(30, 9)), (3, "two words"), (4, None), (None, cases.prose(40, 10))])
    # the third gives one name two values: two of its five slots disagree
    assert got == [(0, 1), (1, 1), (4, 1)]


def test_copies_in_other_case_spacing_and_punctuation(spark):
    item = "A train leaves with Anna and 120 km go by in 2 hours. Before noon Anna meets Bert. They cross the bridge."
    texts = [
        item.upper(), item.lower(), item.replace(".", ""), item.replace(" Anna", "  Anna"), "so said " + item, item.title(),
        item.replace("Anna", "  Carla").replace("120", "75"), cases.prose(100, 5),
    ]
    assert found(spark, texts, [(1, item)]) == [(k, 1) for k in range(7)]


def test_names_that_open_sentences(spark):
    item = "Tom has 3 apples in the basket. Tom gives 2 apples to the girl."
    texts = [item.replace("Tom", "Carla"), item.replace("Tom has", "Carla has").replace("Tom gives", "Ines gives"), item]
    assert found(spark, texts, [(1, item)]) == [(0, 1), (2, 1)]


def test_items_poor_in_words_and_short_items(spark):
    dense, names, short, shorter = "What is 12 + 7 - 3 * 4", "Anna 5, Bert 7, Carla 9, Dora 11, Emil 13", "Which river crosses Verona?", "Add 4 twice"
    opening = "Which number comes after 4 sevens"
    texts = [f"{cases.prose(40, 1)} {x} {cases.prose(30, 2)}" for x in (dense, names, short, shorter, opening)]
    texts += [dense.replace("7", "8").replace("4", "5"), cases.prose(90, 3) + " 1 2 3 4 5 6", short, "crosses Verona", "Add 5 twice"]
    items = [(k, x) for k, x in enumerate((dense, names, short, shorter, opening))] + [(9, "4 7")]
    assert found(spark, texts, items) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (7, 2)]


def brute(texts, items):
    out = set()
    for item, text in items:
        own = text.split()
        windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
        for k, t in enumerate(texts):
            have = t.split()
            at = {}
            for i in range(len(have) - 4):
                at.setdefault(tuple(have[i : i + 5]), []).append(i)
            shifts = [p - i for i, x in enumerate(windows) for p in at.get(x, ())]
            run = max((shifts.count(s) for s in set(shifts)), default=0)
            if sum(x in at for x in windows) >= D.CONTAINED * len(windows) or run >= D.RUN:
                out.add((k, item))
    return sorted(out)


def test_plain_passages_match_brute_force(spark):
    items = [(k, cases.prose(20 + k, 100 + k)) for k in range(12)]
    texts = [cases.prose(50, k) + " " + items[k % 12][1] + " " + cases.prose(30, 50 + k) for k in range(20)]
    texts += [items[3][1][: len(items[3][1]) // 3] + " " + cases.prose(60, 900), items[4][1] + " " + items[5][1], cases.prose(300, 901)]
    for k, (item, text) in enumerate(items):
        own = text.split()
        own[k] = "edited"
        texts.append(" ".join(own))
    assert found(spark, texts, items) == brute(texts, items)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_edges_and_both_joins(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", limit)
    rows = [(10 + k, f"{cases.prose(30, k)} {QUESTION}", "en", "a") for k in range(3)]
    rows += [(None, QUESTION, "en", "a"), (None, QUESTION, "en", "a"), (11, QUESTION, "en", "a")]
    df = cases.table(spark, cases.edges() + rows)
    got = [(r["doc_id"], r["item_id"]) for r in D.leaks(df, bench(spark, [(1, QUESTION), (1, QUESTION)])).collect()]
    assert sorted(got, key=str) == [(10, 1), (11, 1), (11, 1), (12, 1), (None, 1)]
    kept = D.drop_leaks(df, bench(spark, [(1, QUESTION)]))
    assert kept.columns == df.columns and kept.count() == len(cases.edges())
    assert D.leaks(cases.empty(spark), bench(spark, [(1, QUESTION)])).count() == 0
    assert D.drop_leaks(df, bench(spark, [])).count() == df.count()


def test_no_python_in_the_plan(spark):
    df = cases.table(spark, cases.edges())
    plan = D.drop_leaks(df, bench(spark, [(1, QUESTION)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_scan_windows_are_compiled(spark, monkeypatch):
    """Functions over arrays are interpreted, and one per window and form took most of the time of the query."""
    plans, write = {}, Scratch.write

    def seen(self, df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, label)

    monkeypatch.setattr(Scratch, "write", seen)
    assert found(spark, ["so " + QUESTION], [(1, QUESTION), (2, "Add 4 twice")]) == [(0, 1)]
    assert "lambda" not in plans["window-hits"]
    # the tokens are made once, not again in a filter
    assert plans["window-hits"].count("regexp_extract_all") == 1


def spelled(toks):
    """Windows' tokens by form: template, plain, open, plain with values."""
    word = [t[1:] if t < "\x05" else t for t in toks]
    unit = [i > 0 and toks[i - 1][0] == "\x02" and w in D.UNITS for i, w in enumerate(word)]
    valued = [t if t[0] == "\x02" else "\x03" + w if u else w for t, w, u in zip(toks, word, unit, strict=True)]
    template = [w if t[0] == "\x04" or t >= "\x05" else t[0] for t, w in zip(toks, word, strict=True)]
    opened = ["\x01" if t[0] == "\x04" else x for t, x in zip(toks, template, strict=True)]
    return template, [v[0] if v < "\x05" else v for v in valued], opened, valued


@pytest.mark.parametrize("lengths", [[5], [5, 3, 4], [5, 4]])
def test_probes_are_the_windows_of_every_form(spark, lengths):
    texts = [
        QUESTION, "On 3 Days, 5 KG of 12.5 kg; then 7 km and Anna 4 m. Tom has 3.5 Miles. 9 10 11 12 13 14", "Kg 5 kg", "one", "", None, "5 m 6 m 7 m 8 m", "a b c d",
        "Only plain words stand in this text and none of them is a name", "5..3 kg of 2 Anna 3 Days", cases.prose(60, 8), "Der Ärger, Zoë 5 Days: ÉTÉ 3 l",
    ]
    read = cases.table(spark, [(k, t, "en", "a") for k, t in enumerate(texts)]).select("doc_id", D._text_key(F.col("text")).alias("text_key"), D.tokens(F.col("text")).alias("toks"))
    needed, allowed = set(), set()
    for r in read.collect():
        forms = spelled(r["toks"])
        for n in lengths:
            for p in range(len(r["toks"]) - n + 1):
                windows = [tuple(f[p : p + n]) for f in forms]
                allowed |= {(r["doc_id"], p, w) for w in windows}
                poor = sum(t < "\x05" for t in windows[D.VALUED]) > n - D.LITERALS
                needed |= {(r["doc_id"], p, w) for w in windows[: 4 if poor else 3]}
    hashed = spark.createDataFrame([(k, p, list(w)) for k, p, w in allowed], "doc_id long, place int, w array<string>").select("*", F.xxhash64("w").alias("hash"))
    name = {(r["doc_id"], r["place"], r["hash"]): (r["doc_id"], r["place"], tuple(r["w"])) for r in hashed.collect()}
    got = {name[r["doc_id"], r["place"], r["hash"]] for r in D._probes(read, lengths).collect()}
    assert needed <= got <= allowed
