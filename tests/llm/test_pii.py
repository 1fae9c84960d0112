import hashlib
import random
import re

from pyspark.sql import functions as F

from tallyline.llm import pii as P

from . import cases

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def brute(text):
    # the plain email pattern takes the square of a run's length, so texts without the sign skip it
    spans = {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if valid(k, m[0])] if k != "email" or "@" in (text or "") else [] for k, p in PLAIN.items()}
    joined = ",".join(f"{k}:{s}:{e}" for k, own in spans.items() for s, e in own)
    return (*(len(v) for v in spans.values()), hashlib.sha256(joined.encode()).hexdigest()), joined


def rows():
    rng = random.Random(8)
    texts = [
        "é\U0001f600 mail a.b+c@x-y.co.uk, a@b.c_d@e.f x@y @z.w", "ip 1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0255.001.0.0 1..2.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112 5500005555555559",
        "+1 (555) 010-9999 +49.30.1234567 +12 +1 234567890123456789 ++1 (2) 345 6789", "call 555-010-9999 or write me (at) mail.com",
        " ".join(f"{rng.randint(0, 300)}.{rng.randint(0, 300)}.1.2" for _ in range(700)), "1 " * 3000, "9" * 3000, "a" * 2000 + "@", "+" * 2000 + "1" + "-" * 5000,
        "a@1.2.3.4 +4111111111111111",
    ]
    for k in range(60):
        texts.append("".join(rng.choice(["1", "22", "4111111111111111", "+", "-", " ", ".", "@", "a", "b.c", "(", ")", "é", "x@y.z"]) for _ in range(40)))
    return cases.edges() + [(100 + k, t, "en", "a") for k, t in enumerate(texts)]


def test_base_matches_brute_force(spark):
    got = P.find(cases.table(spark, rows())).collect()
    have = sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got), key=str)
    assert have == sorted(((r[0], *brute(r[1])[0]) for r in rows()), key=str)
    texts = {r[0]: r[1] for r in rows() if r[0] is not None}
    for r in got:
        if r["doc_id"] is not None:
            base = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("other"))
            assert base == brute(texts[r["doc_id"]])[1]
    assert P.find(cases.empty(spark)).count() == 0


def test_redaction(spark):
    df = cases.table(spark, rows()).withColumn("base", F.lit("x"))
    out = P.redact(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    assert got[1] is None and got[2] == "" and got[9] == dict((r[0], r[1]) for r in rows())[9]
    assert got[100] == "é\U0001f600 mail [EMAIL], [EMAIL][EMAIL] x@y @z.w" and got[110].startswith("[EMAIL][IP]"[:7])
    assert got[102].startswith("[CARD] and ") and "4111 1111" not in got[102]
    for text in got.values():
        assert "@" not in (text or "") or not re.search(PLAIN["email"], text)


def test_trees_learn_and_become_columns(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(400):
        r = {f: rng.randrange(n) for f, n in P.FEATURES.items()}
        n = rng.randint(1, 9)
        rows.append(r | {"n": n, "known": n if r["plus"] and r["digits"] >= 4 else 0, "held": rng.random() < 0.25})
    model = P.boost(rows)
    held = [r for r in rows if r["held"]]
    assert all((model.at(r) >= model.threshold) == (r["known"] > 0) for r in held)
    df = spark.createDataFrame(rows).withColumn("score", model.column(F.col))
    assert all(abs(r["score"] - model.at(r.asDict())) < 1e-9 for r in df.collect())
    assert P.boost([]).threshold == float("inf") and P.boost([r for r in rows if r["known"]]).threshold == float("inf")


def test_no_python_in_the_plan(spark):
    plan = P.redact(cases.table(spark, rows()[:20]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_statistics_take_every_combination(spark, monkeypatch):
    docs, seen = cases.table(spark, rows()), []
    monkeypatch.setattr(P, "MOST_COMBINATIONS", 1, raising=False)  # the cut there was
    monkeypatch.setattr(P, "boost", lambda combinations: seen.extend(combinations) or P.Trees())
    P.fit(docs)
    candidates = P.candidate_spans(P.base_spans(P._prepare(docs))).agg(F.sum(F.size("candidates"))).head()[0]
    assert {r["held"] for r in seen} == {True, False} and sum(r["n"] for r in seen) == candidates
