"""Toxicity by weak supervision.

Lexicons are mined from ``LABELLED_ROWS`` labelled rows that are not held out: words, and word beginnings, that toxic texts
hold far more often than others.  They are dealt out to ``LEXICONS`` voters; a public word list and writing patterns vote too.  A
generative model of the votes (two classes, one accuracy per voter and class, fitted by expectation maximisation to the
histogram of all vote patterns) estimates how good the voters are, and how much they agree beyond their classes;
correlated voters count for less.  Its posterior labels train a linear classifier over the mined words, whose score is returned.

What reaches the driver is bounded: ``FEATURES`` words, 2 ** voters vote patterns, and a sample of ``TRAIN_ROWS`` rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.session import written

from .language import is_held_out

HELD_OUT_MOD, HELD_OUT_REST = 5, 0
BEGINNINGS = (4, 5, 6)  # letters
LEXICONS = 8
FEATURES = 3000
LEAST_TEXTS = 3  # labelled toxic texts with a mined word
CHANCE_WORDS = 0.1  # mined words that are expected to say nothing
LEAST_ODDS = 3.0  # log odds ratio of a mined word that a voter may use
TRAIN_ROWS = 8000
LABELLED_ROWS = 20_000  # labelled rows from which words are mined
EPOCHS = 300
# A small public list of insults.
PUBLIC = "idiot idiots moron morons stupid dumb loser losers pathetic worthless scum trash disgusting clown fool filth vermin".split()
PATTERNS = (re.compile(r"!{3,}|\?{3,}"), re.compile(r"\byou(?:'re| are)?\s+(?:an?\s+)?\w+\s+(?:idiot|moron|loser|scum|clown)", re.I))
VOTERS = LEXICONS + 1 + len(PATTERNS)
LETTERS = re.compile(r"[^\W\d_]+")


def tokens(text: Column) -> Column:
    """Distinct words of letters, in lower case, and their beginnings (marked ``^``)."""
    words = F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", -1), ""))
    starts = F.flatten(
        F.transform(
            words,
            lambda w: F.filter(
                F.array(*(F.when(F.length(w) >= n, F.concat(F.lit("^"), F.substring(w, 1, n))) for n in BEGINNINGS)), F.isnotnull
            ),
        )
    )
    return F.concat(words, F.array_distinct(starts))


def mined(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float]:
    """Log odds ratios of at most ``FEATURES`` tokens, and the share of toxic texts.

    From a bounded sample of the labelled rows that are not held out: ``LABELLED_ROWS`` of them, by a hash of their ids.
    """
    labelled = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = labelled.filter(~is_held_out(HELD_OUT_MOD, HELD_OUT_REST) & F.col("doc_id").isNotNull())
    sampled = written(labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS))
    # At most LABELLED_ROWS ids are broadcast, so texts are not shuffled for their labels.
    rows = docs.select("doc_id", "text").join(F.broadcast(sampled), "doc_id")
    # Equal texts count once.
    rows = rows.groupBy(F.xxhash64("text").alias("digest")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    rows = written(rows.select("toxic", tokens(F.col("text")).alias("tokens")))
    n_toxic, n_clean = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    if not n_toxic or not n_clean:
        return {}, 0.1
    share = n_toxic / (n_toxic + n_clean)
    toxic = rows.filter("toxic = 1").select(F.explode("tokens").alias("token"))
    held = written(toxic.groupBy("token").agg(F.count("*").alias("pos")).filter(F.col("pos") >= LEAST_TEXTS))
    clean = rows.filter("toxic <> 1").select(F.explode("tokens").alias("token")).join(held, "token", "left_semi")
    both = held.join(clean.groupBy("token").agg(F.count("*").alias("neg")), "token", "left").fillna(0, ["neg"])
    n = F.col("pos") + F.col("neg")
    rate = F.col("pos") / n
    # Chernoff bound of the chance that so many of a token's texts are toxic, if it says nothing.
    bound = n * (rate * F.log(rate / share) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0))
    odds = (
        F.log((F.col("pos") + 0.5) / (n_toxic - F.col("pos") + 0.5)) - F.log((F.col("neg") + 0.5) / (n_clean - F.col("neg") + 0.5))
    )
    best = both.select("token", odds.alias("odds"), bound.alias("bound")).filter(
        (F.col("odds") > 0) & (rate > share) & (F.col("bound") > math.log(max(1, held.count()) / CHANCE_WORDS))
    )
    return {r["token"]: r["odds"] for r in best.orderBy(F.desc("bound"), "token").limit(FEATURES).collect()}, share


def noted(docs: DataFrame, features: dict[str, float]) -> DataFrame:
    """``doc_id, held_out, votes`` (a bit per voter) ``, found`` (numbers of the features) of every document."""
    number = {token: i for i, token in enumerate(features)}
    strong = [token for token, odds in features.items() if odds >= LEAST_ODDS]
    voter = {number[token]: i % LEXICONS for i, token in enumerate(strong)}
    public = frozenset(PUBLIC)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def note(text: str) -> tuple[int, list[int]]:
        votes, found = 0, set()
        for word in set(LETTERS.findall(text.lower())):
            if word in number:
                found.add(number[word])
            if word in public:
                votes |= 1 << LEXICONS
            for n in BEGINNINGS:
                if len(word) >= n and (start := "^" + word[:n]) in number:
                    found.add(number[start])
        for i in found:
            if i in voter:
                votes |= 1 << voter[i]
        for i, pattern in enumerate(PATTERNS):
            if pattern.search(text):
                votes |= 1 << (LEXICONS + 1 + i)
        return votes, sorted(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [note(text or "") for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([v for v, _ in rows], pa.int32()),
                    pa.array([f for _, f in rows], pa.list_(pa.int32())),
                ],
                names=["doc_id", "held_out", "votes", "found"],
            )

    rows = docs.select("doc_id", is_held_out(HELD_OUT_MOD, HELD_OUT_REST).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, votes int, found array<int>")


def label_model(votes: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 50) -> np.ndarray:
    """Posterior probability of the toxic class for each vote pattern.

    Accuracies start from "a vote is right more often than not" and are refitted to the patterns; the class share stays
    near the labelled one.  A voter's log-likelihood ratio is divided by one plus the agreement it shares with others
    within the classes.
    """
    bits = (votes[:, None] >> np.arange(VOTERS) & 1).astype(float)
    weight = counts / max(1.0, counts.sum())
    prior = min(max(prior, 0.005), 0.5)
    on = {1: np.full(VOTERS, 0.5), 0: np.full(VOTERS, 0.02)}
    damp = np.ones(VOTERS)
    share, posterior = prior, np.zeros(len(votes))
    for _ in range(rounds):
        ratio = bits * np.log(on[1] / on[0]) + (1 - bits) * np.log((1 - on[1]) / (1 - on[0]))
        logit = np.clip((ratio / damp).sum(axis=1) + math.log(share / (1 - share)), -30, 30)
        posterior = 1 / (1 + np.exp(-logit))
        agreement = np.zeros((VOTERS, VOTERS))
        for label, own in ((1, posterior * weight), (0, (1 - posterior) * weight)):
            total = own.sum()
            on[label] = np.clip((own @ bits + 0.001 * (0.5 if label else 0.02)) / (total + 0.001), 1e-4, 1 - 1e-4)
            centred = (bits - on[label]) / np.sqrt(on[label] * (1 - on[label]))
            agreement += total * np.abs((centred * own[:, None]).T @ centred) / max(total, 1e-9)
        # A voter keeps pointing at its class.
        on[1] = np.maximum(on[1], 1.5 * on[0]).clip(1e-4, 1 - 1e-4)
        share = min(max(0.5 * prior + 0.5 * float(posterior @ weight), 0.5 * prior), 2 * prior, 0.6)
        np.fill_diagonal(agreement, 0)
        damp = 1 + np.minimum(agreement, 1).sum(axis=1) / 2
    return posterior


def train(found: list[list[int]], goal: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier on soft labels, by accelerated gradient steps with a small penalty."""
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    columns = np.array([i for f in found for i in f], dtype=np.int64)
    w, bias = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, EPOCHS + 1):
        z = np.bincount(rows, weights=w[columns], minlength=len(found)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - goal) / len(found)
        g = np.append(np.bincount(columns, weights=error[rows], minlength=size) + 1e-5 * w, error.sum())
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        change = 0.05 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - change[:-1], bias - change[-1]
    return w, bias


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    NULL and empty texts hold no word and get the score of such a text.  Repeated rows get equal scores.  Without labelled
    rows only the public list and the patterns vote.  A table without rows gives none.
    """
    features, prior = mined(docs, labels)
    features |= {token: LEAST_ODDS for token in PUBLIC if token not in features}
    notes = written(noted(docs, features))
    # At most 2 ** VOTERS patterns.
    known = notes.filter("NOT held_out").groupBy("votes").count().orderBy("votes").collect()
    votes = np.array([r["votes"] for r in known], dtype=np.int64)
    posterior = label_model(votes, np.array([r["count"] for r in known], dtype=float), prior)
    likely = dict(zip(votes.tolist(), posterior.tolist(), strict=True))
    w, bias = np.zeros(len(features)), 0.0
    if likely:
        entries = [x for v, p in likely.items() for x in (F.lit(v), F.lit(p))]
        rows = notes.filter("NOT held_out").select("found", F.create_map(*entries)[F.col("votes")].alias("p"), F.xxhash64("doc_id").alias("pick"))
        kept = []
        for side in ("p >= 0.5", "p < 0.5"):
            kept += rows.filter(side).orderBy("pick").limit(TRAIN_ROWS // 2).collect()
        w, bias = train([r["found"] for r in kept], np.array([r["p"] for r in kept]), len(features))
    weights = F.lit([float(x) for x in w])
    z = F.aggregate("found", F.lit(float(bias)), lambda total, i: total + F.element_at(weights, i + 1))
    score = 1 / (1 + F.exp(-z))
    return notes.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
