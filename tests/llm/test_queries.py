"""The registered queries against their SQL, and the pipeline against brute force stage by stage."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from veriscope import llm
from veriscope.llm import fertility, packing, secrets
from veriscope.llm.tables import DOCUMENTS
from veriscope.session import written

from ..conftest import SF_DIR
from ..test_oracle import table

WITHOUT_SQL = {
    "op1_suffix_array_dedup",
    "op4_tokeniser_fertility",
    "op6_secret_scans",
    "op7_pattern_packing",
    "op9_weak_toxicity",
    "op10_byte_cnn_language",
    "op11_cube_mixing",
    "op13_block_whitening",
}


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_sql(spark, duck, name):
    result = llm.QUERIES[name](spark, SF_DIR)
    expected = duck.sql(llm.ORACLES[name])
    rows = result.collect()
    assert sorted(result.columns) == sorted(expected.columns)
    assert table(result.columns, rows) == table(expected.columns, expected.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(llm.QUERIES) - set(llm.ORACLES) == WITHOUT_SQL


def words(text, pattern):
    return re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    before = {r.doc_id: r for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "near_duplicates", "decontamination", "secret_scans", "best_fit_packing"]

    def step(name, rows):
        after = written(steps[name](spark, rows, SF_DIR))
        assert name == "best_fit_packing" or tuple(after.columns) == DOCUMENTS
        return after, after.collect()

    docs, rows = step("quality_rules", docs)
    vocabulary = fertility.words_of(*fertility.vocabularies())
    measured = {i: fertility.measure(r.text, vocabulary) for i, r in before.items()}
    eligible = {i: dict(zip(fertility.COLUMNS, m)) for i, m in measured.items() if m[6]}
    low = {}
    for lang in {before[i].lang for i in eligible}:
        for name in fertility.FOLLOWED:
            lengths = {(m["n_words"], m["word_chars"]): m[name] for i, m in eligible.items() if before[i].lang == lang}
            bins = Counter(int(v * fertility.BINS) for v in lengths.values())
            low[lang, name] = fertility.lower_limit(np.array(sorted(bins)), np.array([bins[b] for b in sorted(bins)]))
    fits = lambda i, m: all(m[name] >= low[before[i].lang, name] for name in fertility.FOLLOWED)
    assert all(before[i].lang for i in eligible) and {m["script"] for m in eligible.values()} == {"latin"}
    assert {r.doc_id for r in rows} == {i for i, m in eligible.items() if fits(i, m)}
    assert all(r == before[r.doc_id] for r in rows)

    sets = {}
    for r in rows:
        w = words(r.text, r"[^\x20\x09-\x0D]+")
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    docs, rows = step("near_duplicates", docs)
    assert {r.doc_id for r in rows} == {i for i, own in label.items() if i == own}

    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for item in benchmark:
        w = words(item.text, pattern)
        n = min(13, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    clean = set()
    for r in rows:
        w, hit = words(r.text, pattern), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            clean.add(r.doc_id)
    docs, rows = step("decontamination", docs)
    assert {r.doc_id for r in rows} == clean and all(r == before[r.doc_id] for r in rows)

    spans = {r.doc_id: r.spans for r in secrets.find(docs).collect()}
    docs, rows = step("secret_scans", docs)
    assert {r.doc_id for r in rows} == clean
    for r in rows:
        assert (r.text == before[r.doc_id].text) == (not spans[r.doc_id])
        assert r.n_chars == len(r.text) and (secrets.MASK in r.text or not spans[r.doc_id])

    _, parts = step("best_fit_packing", docs)
    assert Counter((r.doc_id, r.piece, r.length) for r in parts) == Counter(
        (r.doc_id, k, min(packing.CAPACITY, n - k * packing.CAPACITY))
        for r in rows
        for n in [len(packing.ids_of(r.text, packing.vocabulary())) // 4]
        for k in range(-(-n // packing.CAPACITY))
    )
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(parts)
