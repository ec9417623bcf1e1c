"""Balanced mixing, spelling variants and whitening against brute force, with every odd case."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veriscope.llm import mixing, spelling, whitening
from veriscope.llm.queries import QUERIES

from ..conftest import SF_DIR

# Mixing


def dealt(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by dealing the excess again and again; ``sizes`` by source in order."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    target, left, free = dict.fromkeys(sizes, 0.0), share * sum(sizes.values()), list(sizes)
    while free and left > 1e-9:
        each = left / sum(weight[s] for s in free)
        over = [s for s in free if each * weight[s] > most * sizes[s]]
        if not over:
            target |= {s: each * weight[s] for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def by_source(rows):
    found = defaultdict(list)
    for r in rows:
        found[r.source].append(r)
    return found


def check_mixture(rows, texts):
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts.items()}
    sizes = Counter()
    for r in rows:
        assert r.size == words[r.doc_id] and r.taken == r.copies * r.size and 0 <= r.copies <= 2
        sizes[r.source] += r.size
    ordered = dict(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")))
    targets = dealt(ordered)
    for source, own in by_source(rows).items():
        assert {r.source_size for r in own} == {sizes[source]}
        assert own[0].target == pytest.approx(targets[source])
        # Off by less than one mean document.
        assert abs(sum(r.taken for r in own) - targets[source]) <= max(10, sizes[source] / len(own))
        if sizes[source]:
            assert abs(sum(r.copies for r in own) - len(own) * targets[source] / sizes[source]) <= 12


def test_mixture_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mixing.mixed(docs).collect()
    check_mixture(rows, {r.doc_id: r.text for r in docs.collect()})
    again = mixing.mixed(docs.repartition(5)).collect()
    assert sorted(rows) == sorted(again)


def test_one_source_with_most_documents_flies_in_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 64)
    rng = random.Random(3)
    data = [(i, "w " * int(rng.lognormvariate(3, 1.2)), "big" if i % 5 else f"s{i % 7}") for i in range(3000)]
    rows = mixing.mixed(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    assert len(rows) == 3000
    check_mixture(rows, {i: t for i, t, _ in data})


def test_mixture_of_odd_rows(spark, messy, nothing):
    rows = mixing.mixed(messy).collect()
    assert len(rows) == messy.count()
    # One document holds nearly all words: no mixture comes nearer than half of it.
    assert abs(sum(r.taken for r in rows) - 1.5 * sum(r.size for r in rows)) <= 15_000
    assert all(r.taken <= 2 * r.size for r in rows)
    assert mixing.mixed(nothing).collect() == []
    empty = spark.createDataFrame([(1, None, None), (2, "", "a"), (2, "", "a")], "doc_id long, text string, source string")
    assert {(r.size, r.target, r.taken) for r in mixing.mixed(empty).collect()} == {(0, 0.0, 0)}


def test_null_source_is_last_and_is_a_source(spark):
    data = [(i, "a b c d", s) for i, s in enumerate(["b", None, "a", "ä"] * 25)]
    rows = mixing.mixed(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    # a, b, ä, NULL weigh 3, 1, 2, 3 of 600 words: the third of them each 200 at most.
    assert {r.source: round(r.target, 6) for r in rows} == dict(a=200.0, b=66.666667, ä=133.333333) | {None: 200.0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=3, max_size=60), st.floats(0.05, 0.95), st.integers(0, 999))
def test_flight_keeps_both_totals(sizes, p, seed):
    chance = [p] * len(sizes)
    left = mixing.flown([float(s) for s in sizes], chance, random.Random(seed), list(range(len(sizes))))
    assert len(left) <= 2 and all(c in (0.0, 1.0) for i, c in enumerate(chance) if i not in left)
    assert sum(chance) == pytest.approx(p * len(sizes), abs=1e-5)
    assert sum(c * s for c, s in zip(chance, sizes, strict=True)) == pytest.approx(p * sum(sizes), abs=1e-3)


def test_flight_is_fair():
    """Each document is taken as often as its probability says."""
    sizes = [float(s) for s in (1, 3, 10, 40, 5, 7, 90, 2, 2, 30)]
    taken = np.zeros(len(sizes))
    for seed in range(3000):
        chance = [0.3] * len(sizes)
        mixing.flown(sizes, chance, random.Random(seed), list(range(len(sizes))))
        taken += chance
    assert np.abs(taken / 3000 - 0.3).max() < 0.04


# Spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(counts):
    rows = {}
    for w, n in counts.items():
        close = [x for x in counts if x != w and near(w, x)]
        best = min(close, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= 10 * n else None
        rows[w] = [form, n, len(close), counts[form] if form else None]
    found = {}
    for w, (form, *rest) in rows.items():
        root = w
        while rows[root][0]:
            root = rows[root][0]
        found[w] = (form, root, *rest)
    return found


def brute_vocabulary(texts):
    counts = Counter()
    for i, text in texts:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def as_rows(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_words_of_odd_texts(spark, messy, nothing):
    found = {r.word: r.n for r in spelling.vocabulary(messy).collect()}
    assert found == brute_vocabulary((r.doc_id, r.text) for r in messy.collect())
    assert as_rows(spelling.spelling_variants(messy)) == expected_variants(found)
    assert spelling.spelling_variants(nothing).collect() == []
    assert spelling.spelling_variants(nothing).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_every_near_pair_of_random_words_is_found(spark):
    """Few letters, so that grams repeat inside words and ties abound."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abÿ") for _ in range(rng.randint(7, 9))) for _ in range(1500)}
    counts = {w: rng.choice([2, 3, 20, 200, 2000]) for w in words} | {"a" * 400: 5, "a" * 401: 50, "a" * 402: 500}
    given_words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    expected = expected_variants(counts)
    assert as_rows(spelling.variants(given_words)) == expected
    assert any(root != form for form, root, *_ in expected.values() if form)  # forms that have forms


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=4, max_size=12), st.data())
def test_pivots_are_the_rarest_disjoint_grams(word, data):
    grams = {word[i : i + 2] for i in range(len(word) - 1)}
    ranks = {g: r for r, g in enumerate(data.draw(st.permutations(sorted(grams))))}
    end, prefix, chosen = spelling.grams_of(word, ranks)
    rank = lambda p: ranks[word[p : p + 2]]
    assert len(prefix) >= 3 and all(rank(p) <= end for p in prefix)
    assert len(chosen) == 2 and abs(chosen[0] - chosen[1]) >= 2 and set(chosen) <= set(prefix)
    assert rank(chosen[0]) + rank(chosen[1]) == min(rank(p) + rank(q) for p in prefix for q in prefix if q - p >= 2)


# Whitening


def expected_whitening(rows, most=16):
    """Exact numbers by Python integers, coordinates by numpy."""
    good = [(k, [math.floor(64 * float(c)) + 1000000 for c in v]) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for _, x in good]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    spread, directions = np.linalg.eigh(centred.T @ centred / n)
    spread, directions = spread[::-1][:most], directions[:, ::-1][:, :most]
    every = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for _, x in good])
    with np.errstate(all="ignore"):
        return good, n, deviation, spread / np.trace(centred.T @ centred / n), every @ directions / np.sqrt(spread)


def test_whitening_of_a_table(spark):
    given_rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given_rows.collect()]
    good, n, deviation, share, coordinates = expected_whitening(rows)
    found = {(r.vec_id, r.component): r for r in QUERIES["op13_block_whitening"](spark, SF_DIR).collect()}
    assert len(found) == 16 * len(good) and {r.n for r in found.values()} == {n}
    sign = [np.sign(found[good[0][0], c + 1].whitened * coordinates[0][c]) for c in range(16)]
    for i, (key, _) in enumerate(good):
        for c in range(16):
            r = found[key, c + 1]
            assert r.deviation == deviation[i] and r.explained == pytest.approx(share[c], rel=1e-9)
            assert r.whitened == pytest.approx(sign[c] * coordinates[i][c], abs=1e-6)
    assert max(r.identity_error for r in found.values()) < 1e-9


def test_whitening_over_many_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 20)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 3)
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(150, 4)) * [1, 2, 3, 4])]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(None, rows[1][1]), (None, rows[2][1]), (7, rows[3][1])]
    rows += [(2000, None), (2001, [1.0, None, 1.0, 1.0]), (2002, [float("nan")] * 4), (2003, [float("inf")] * 4), (2004, []), (2005, [1.0])]
    given_rows = spark.createDataFrame(
        [(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<double>, whitened string, _index int"
    ).repartition(5)
    found = whitening.whiten(given_rows).collect()
    good, n, deviation, share, coordinates = expected_whitening([r for r in rows if r[0] != 2005])
    assert n == 150 and len(found) == 4 * len(good) and {r.n for r in found} == {n}
    assert Counter((r.vec_id, r.deviation) for r in found if r.component == 1) == Counter((k, d) for (k, _), d in zip(good, deviation, strict=True))
    for c in range(4):
        got = sorted(abs(r.whitened) for r in found if r.component == c + 1)
        assert got == pytest.approx(sorted(np.abs(coordinates[:, c])), abs=1e-9)
        assert {round(r.explained, 9) for r in found if r.component == c + 1} == {round(share[c], 9)}
    assert max(r.identity_error for r in found) < 1e-9


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(same)] == [
        (k, c, 1, 0, None, 0.0, 0.0) for k in (1, 2) for c in (1, 2)
    ]
    line = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])], schema)).collect()
    first = {r.vec_id: r.whitened for r in line if r.component == 1}
    assert abs(first[1]) == pytest.approx(math.sqrt(1.5)) and first[2] == pytest.approx(0) and first[3] == pytest.approx(-first[1])
    assert {r.whitened for r in line if r.component == 2} == {None} and line[0].identity_error < 1e-9


def test_a_deviation_beyond_a_long_is_null(spark):
    rows = spark.createDataFrame([(1, [1e9]), (2, [-1e9])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in whitening.whiten(rows).collect()] == [None, None]
