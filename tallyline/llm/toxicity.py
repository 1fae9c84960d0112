"""Toxic spans and document scores by a linear-chain conditional random field (operator 5).

Evidence: how much likelier a word, or its first letters, is in toxic than in
other labelled training texts.  Words with strong evidence are the labelled
tokens of the field, which is trained by gradient ascent on the segments around
them.  In a text, forward-backward marginals of the same segments give toxic
spans; noisy-or over a text's marginals, calibrated on the training rows, gives
its score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.base import held_out, map_texts, needed, query, schema, table
from tallyline.shipping import by_value

by_value(__name__)

#: Labelled rows trained on, chosen by a hash of their id, and keys kept as evidence.
TRAIN_ROWS, KEYS = 20_000, 4096
#: Words of one training text that become training segments.
TRAIN_WORDS = 256
#: Chains the field is trained on.
TRAIN_CHAINS = 3000
#: Evidence is log-odds less two standard errors; a key has at least so much, and is in this share of the toxic texts.
SUPPORT, ODDS_LEAST, ERRORS = 0.002, 1.0, 2.0
#: Words of a toxic text within this of its strongest evidence are labelled toxic.
ODDS_NEAR = 1.5
#: Words without evidence kept on either side of one with it; the gap that parts two segments is twice that.
CONTEXT = 2
#: Words with evidence in one segment; longer stretches are cut.
HITS = 8
MOST_ODDS = 20.0
#: Features of a word; the weights of the four transitions follow theirs.
EMIT = 4
THRESHOLD, RIDGE, STEPS = 0.3, 1e-3, 120
SPAN_MARGINAL = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def keys_of(word: str) -> tuple[str, str, str]:
    """The word and its first four and five letters, marked as beginnings."""
    return word, word[:4] + "-", word[:5] + "-"


@dataclass
class Model:
    odds: dict[str, float] = field(default_factory=dict)
    begins: set[str] = field(default_factory=set)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(EMIT + 4))
    slope: float = 0.0
    bias: float = -8.0


def _evidence(model: Model, words: list[str]) -> tuple[list[int], list[tuple[float, float, float]]]:
    begins, odds = model.begins, model.odds
    at = [i for i, x in enumerate(words) if x[:4] in begins]
    found = [tuple(odds.get(k, 0.0) for k in keys_of(words[i])) for i in at]
    kept = [(i, f) for i, f in zip(at, found) if any(f)]
    return [i for i, _ in kept], [f for _, f in kept]


def segments(at: list[int], n: int) -> list[tuple[int, int, list[int]]]:
    """(first word, end, indices into ``at``): stretches around words with evidence, cut at long gaps."""
    out: list[tuple[int, int, list[int]]] = []
    for k, i in enumerate(at):
        if out and i - at[out[-1][2][-1]] <= 2 * CONTEXT and len(out[-1][2]) < HITS:
            out[-1][2].append(k)
        else:
            out.append((max(0, i - CONTEXT), 0, [k]))
    return [(s, min(n, at[own[-1]] + CONTEXT + 1), own) for s, _, own in out]


def _features(evidence: list[tuple], at: list[int], segment: tuple[int, int, list[int]]) -> np.ndarray:
    """Per word of a segment: one, its evidence, that of its beginnings, and that of its neighbours."""
    s, e, own = segment
    x = np.zeros((e - s, EMIT))
    x[:, 0] = 1
    for k in own:
        x[at[k] - s, 1:3] = max(evidence[k]), max(evidence[k][1:])
    x[1:, 3] = x[:-1, 1]
    x[:-1, 3] = np.maximum(x[:-1, 3], x[1:, 1])
    return x


def _potentials(weights: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Emission of the toxic state over the clean one, and the 2 x 2 transition scores."""
    return x @ weights[:EMIT], weights[EMIT:].reshape(2, 2)


def forward_backward(emission: np.ndarray, trans: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Toxic marginals, transition marginals and log-partition of padded chains (rows x words)."""
    rows, n = emission.shape
    score = np.stack([np.zeros_like(emission), emission], axis=2)
    fwd, bwd = np.zeros((rows, n, 2)), np.zeros((rows, n, 2))
    fwd[:, 0] = score[:, 0]
    for t in range(1, n):
        step = np.logaddexp.reduce(fwd[:, t - 1, :, None] + trans, axis=1) + score[:, t]
        fwd[:, t] = np.where(mask[:, t, None], step, fwd[:, t - 1])
    for t in range(n - 2, -1, -1):
        step = np.logaddexp.reduce(trans + (score[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
        bwd[:, t] = np.where(mask[:, t + 1, None], step, bwd[:, t + 1])
    log_z = np.logaddexp.reduce(fwd[:, -1], axis=1)
    both = np.exp(fwd + bwd - log_z[:, None, None])
    pair = np.zeros((rows, 2, 2))
    for t in range(1, n):
        p = np.exp(fwd[:, t - 1, :, None] + trans + (score[:, t] + bwd[:, t])[:, None, :] - log_z[:, None, None])
        pair += np.where(mask[:, t, None, None], p, 0)
    return both[:, :, 1] * mask, pair, log_z


def train_field(chains: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights that maximise the penalised likelihood of (features, 0/1 labels) chains."""
    weights = np.zeros(EMIT + 4)
    if not chains:
        return weights
    n = max(len(y) for _, y in chains)
    x, y, mask = np.zeros((len(chains), n, EMIT)), np.zeros((len(chains), n)), np.zeros((len(chains), n), bool)
    for k, (a, b) in enumerate(chains):
        x[k, : len(b)], y[k, : len(b)], mask[k, : len(b)] = a, b, True
    states = np.stack([1 - y, y], axis=2) * mask[:, :, None]
    seen_emit = np.einsum("rt,rtf->f", y * mask, x)
    seen_pair = np.einsum("rti,rtj->ij", states[:, :-1], states[:, 1:])
    first, second = np.zeros(EMIT + 4), np.zeros(EMIT + 4)
    for step in range(1, STEPS + 1):
        emission, trans = _potentials(weights, x)
        marginal, pair, _ = forward_backward(emission, trans, mask)
        gradient = np.concatenate([seen_emit - np.einsum("rt,rtf->f", marginal, x), (seen_pair - pair.sum(axis=0)).ravel()]) / len(chains)
        gradient -= RIDGE * weights
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        weights = weights + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def marginals(features: list[np.ndarray], weights: np.ndarray) -> list[np.ndarray]:
    """Toxic marginal of every word of every chain; chains of like length share a call."""
    out: list[np.ndarray] = [np.empty(0)] * len(features)
    order = sorted(range(len(features)), key=lambda k: len(features[k]))
    for start in range(0, len(order), 1024):
        own = order[start : start + 1024]
        n = len(features[own[-1]])
        x, mask = np.zeros((len(own), n, EMIT)), np.zeros((len(own), n), bool)
        for row, k in enumerate(own):
            x[row, : len(features[k])], mask[row, : len(features[k])] = features[k], True
        emission, trans = _potentials(weights, x)
        marginal, _, _ = forward_backward(emission, trans, mask)
        for row, k in enumerate(own):
            out[k] = marginal[row, : len(features[k])]
    return out


def text_odds(found: list[list[np.ndarray]]) -> np.ndarray:
    """Per text, log-odds that any of its words is toxic, from its segments' marginals (the least without segments)."""
    out = np.full(len(found), -MOST_ODDS)
    for k, own in enumerate(found):
        if own:
            clean = float(sum(np.log1p(-np.minimum(m, 1 - 1e-12)).sum() for m in own))
            out[k] = max(-MOST_ODDS, min(MOST_ODDS, math.log(max(-math.expm1(clean), 1e-12)) - clean))
    return out


def _places(text: str, lowered: str, hits: set[int]) -> list[tuple[int, int]]:
    """Code points of the words ``hits``; lower case may change a text's length, then offsets are mapped back."""
    place = [m.span() for k, m in enumerate(_WORD.finditer(lowered)) if k in hits]
    if len(lowered) != len(text):
        origin = [i for i, c in enumerate(text) for _ in c.lower()]
        place = [(origin[s], origin[e - 1] + 1) for s, e in place]
    return place


def mark(texts: list, model: Model) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Log-odds of each text and its toxic spans in code points."""
    cut, features = [], []
    for text in texts:
        words = _WORD.findall(text.lower()) if text else []
        at, evidence = _evidence(model, words)
        own = segments(at, len(words))
        cut.append(own)
        features += [_features(evidence, at, segment) for segment in own]
    flat = iter(marginals(features, model.weights))
    found = [[next(flat) for _ in own] for own in cut]
    spans = []
    for text, own, marginal in zip(texts, cut, found):
        hits = {seg[0] + int(i) for seg, m in zip(own, marginal) for i in np.flatnonzero(m >= SPAN_MARGINAL)}
        spans.append(_places(text, text.lower(), hits) if hits else [])
    return text_odds(found), spans


def score_of(odds: float, model: Model) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * odds + model.bias))))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(``text``, ``toxic``) of about ``rows`` labelled texts outside the held-out fold."""
    marked = needed(labels, "doc_id", "toxic").where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    total = marked.count()
    share = min(1.0, rows / max(total, 1))
    some = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * rows)
    # the sample is bounded, so texts need not be shuffled to meet it
    return needed(docs, "doc_id", "text").join(F.broadcast(some), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int"))


def _key_odds(rows: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Evidence of keys that are surely likelier in toxic texts."""

    def fold(frames):
        for pdf in frames:
            seen: dict[str, list[int]] = {}
            for text, label in zip(pdf["text"], pdf["toxic"]):
                for key in {k for x in set(_WORD.findall(text.lower())) for k in keys_of(x)}:
                    seen.setdefault(key, [0, 0])[int(label == 1)] += 1
            yield pd.DataFrame([(k, c, t) for k, (c, t) in seen.items()], columns=["key", "c", "t"])

    counts = rows.mapInPandas(fold, schema("key string, c long, t long")).groupBy("key").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(t / (toxic + 1)) - F.log(c / (clean + 1)) - ERRORS * F.sqrt(1 / t + 1 / c)
    best = counts.where(F.col("t") >= max(3, math.ceil(SUPPORT * toxic))).select("key", odds.alias("odds"), "t").where(F.col("odds") >= ODDS_LEAST)
    return {r["key"]: r["odds"] for r in best.orderBy(F.desc("odds"), F.desc("t"), "key").limit(KEYS).collect()}


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from ``labels`` (``doc_id``, ``toxic``); without both kinds of rows every score is the share of toxic ones."""
    train = training_rows(docs, labels, rows)
    shares = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    toxic, clean = shares.get(1, 0), sum(n for k, n in shares.items() if k != 1)
    if not toxic or not clean:
        return Model(bias=8.0 if toxic else -8.0)
    model = Model(odds=_key_odds(train, toxic, clean))
    model.begins = {k.rstrip("-")[:4] for k in model.odds}

    def encode():
        def run(texts):
            out = []
            for text in texts:
                words = _WORD.findall(text.lower())
                at, evidence = _evidence(model, words)
                out.append((len(words), at[:TRAIN_WORDS], [x for f in evidence[:TRAIN_WORDS] for x in f]))
            return {name: [o[k] for o in out] for k, name in enumerate(("n", "at", "evidence"))}

        return run

    coded = map_texts(train, encode, "n int, at array<int>, evidence array<double>")
    found = sorted(coded.collect(), key=lambda r: (r["at"], r["evidence"], r["n"], r["toxic"]))
    chains = []
    for row in found:
        evidence = np.array(row["evidence"]).reshape(-1, 3)
        strong = evidence.max() - ODDS_NEAR if len(evidence) else 0.0
        for segment in segments(row["at"], row["n"]):
            labels_of = np.zeros(segment[1] - segment[0])
            for k in segment[2]:
                labels_of[row["at"][k] - segment[0]] = row["toxic"] == 1 and evidence[k].max() >= strong
            chains.append((_features([tuple(f) for f in evidence], row["at"], segment), labels_of))
    model.weights = train_field(chains[:: max(1, math.ceil(len(chains) / TRAIN_CHAINS))])
    flat = iter(marginals([x for x, _ in chains], model.weights))
    odds = text_odds([[next(flat) for _ in segments(row["at"], row["n"])] for row in found])
    model.slope, model.bias = calibrate(odds, np.array([row["toxic"] == 1 for row in found], float))
    return model


def calibrate(odds: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the logistic curve from log-odds to shares, by damped Newton steps."""
    slope, bias = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * odds + bias, -30, 30)))
        weight = p * (1 - p) + 1e-9
        g = np.array([((truth - p) * odds).sum() - 1e-3 * slope, (truth - p).sum()])
        h = np.array([[(weight * odds * odds).sum() + 1e-3, (weight * odds).sum()], [(weight * odds).sum(), weight.sum()]])
        move = np.linalg.solve(h, g)
        slope, bias = slope + float(np.clip(move[0], -1, 1)), bias + float(np.clip(move[1], -2, 2))
    return max(0.0, slope), bias


def toxic_score(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([score_of(o, model) for o in mark(list(texts), model)[0]], dtype="float64")

    return udf(text)


def tag(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``score``, ``predicted`` and ``spans`` (toxic ``start``, ``end``).

    Only the text is read.  Null and empty texts have no spans and the least
    score; null ids count as held out; repeated rows score alike; no rows give
    no rows.
    """

    def factory():
        def run(texts):
            odds, places = mark(texts, model)
            spans = [[{"start": s, "end": e} for s, e in own] for own in places]
            return {"score": [score_of(o, model) for o in odds], "spans": spans}

        return run

    rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    out = map_texts(rows, factory, "score double, spans array<struct<start:int,end:int>>")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that :func:`tag` predicts toxic; all columns are kept."""
    return docs.where(toxic_score(F.col("text"), model) < threshold)


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return tag(docs, fit(docs, table(spark, sf_dir, "labels")))
