"""Operators that learn, on held-out rows; and the as-of join."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from veriscope.llm import language, revisits, toxicity

from .conftest import prose


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(3)
    parts = {"aa": ["tha", "ing", "er", "st"], "bb": ["ção", "ões", "lha", "que"], "cc": ["при", "вет", "ск", "ой"]}
    rows = []
    for i in range(600):
        lang = rng.choice(list(parts))
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 200)))
        rows.append((i, text, lang if i % 11 else None, lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")


def test_language_on_held_out_rows(spark, tongues, messy, nothing):
    net = language.fit(*language.sample(tongues))
    found = language.predict(tongues, net).join(tongues, "doc_id")
    held = found.filter("held_out")
    assert held.count() > 80 and held.filter("lang_pred = truth").count() >= 0.98 * held.count()
    assert found.filter("score < 0 OR score > 1").count() == 0
    odd = language.predict(messy, net)
    assert odd.count() == messy.count()
    assert {r.doc_id for r in odd.filter("lang_pred = 'und'").collect()} == {1, 2, 3, None} and odd.filter("lang_pred = 'und'").count() == 4
    # Without labels, and without rows.
    assert language.identified(messy).filter("lang_pred <> 'und' OR score <> 0").count() == 0
    assert language.identified(nothing).count() == 0


def test_language_never_reads_held_out_labels(tongues):
    other = tongues.withColumn("lang", F.when(language.is_held_out(4, 2), "zz").otherwise(F.col("lang")))
    assert set(language.sample(other)[1]) == {"aa", "bb", "cc"}
    assert language.sample(other) == language.sample(tongues)


def test_toxicity_on_held_out_rows(spark, messy, nothing):
    rng = random.Random(4)
    slurs = ["grobnik", "stupid", "zzlowa", "zzlowb", "zzlowc", "zzlowd", "idiot"]
    rows, labels = [], []
    for i in range(900):
        words = prose(1000 + i, rng.randint(40, 90)).split(" ")
        toxic = i % 6 == 0
        if toxic:
            for slur in rng.sample(slurs, 2):
                words.insert(rng.randrange(len(words)), slur)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (1, None), (None, 1), (10**6, 1)], "doc_id long, toxic int")
    found = toxicity.scored(docs, marks).join(marks.filter("toxic IS NOT NULL"), "doc_id")
    held = found.filter("held_out")
    assert held.filter("toxic = 1 AND predicted = 1").count() >= 0.9 * held.filter("toxic = 1").count()
    assert held.filter("toxic = 0 AND predicted = 1").count() <= 0.02 * held.count()
    assert found.filter("score < 0 OR score > 1 OR predicted <> cast(score >= 0.5 AS int)").count() == 0
    # Labels of held-out rows change nothing.
    flipped = marks.withColumn("toxic", F.when(language.is_held_out(5, 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    both = toxicity.scored(docs, flipped).withColumnRenamed("score", "other").join(found, "doc_id")
    assert both.filter("abs(score - other) > 1e-9").count() == 0
    odd = toxicity.scored(messy, marks.limit(0))
    assert odd.count() == messy.count() and odd.filter("score IS NULL").count() == 0
    assert toxicity.scored(nothing, marks).count() == 0


def test_revisits(spark, monkeypatch):
    monkeypatch.setattr(revisits, "BUCKET", 10)
    head = {"date": "1", "content-type": "t", "etag": "a"}
    rows = [
        (1, "http://www.Host.com:80/x/#top", 1, "response", "a", None, head, "one"),
        (2, "https://host.com/x?utm_source=q", 5, "revisit", "a", None, {"date": "2", "content-type": "no", "Vary": "no", "vary": "v"}, None),
        (3, "host.com/x?ref=1", 55, "revisit", "a", None, None, None),
        (4, "host.com/x", 60, "response", "b", None, None, "two"),
        (5, "host.com/x", 60, "revisit", "b", None, None, None),
        (6, "host.com/x", 61, "revisit", "a", None, None, None),
        (7, "host.com/x", 0, "revisit", "a", None, None, None),
        (8, "host.com/y?a=1&utm_x=2&b=3", 3, "response", None, "m", head, "three"),
        (9, "host.com/y?a=1&b=3", 300, "revisit", "q", "m", {}, None),
        (10, "host.com/y?a=1&b=3", 300, "revisit", None, None, {}, None),
        (11, None, 300, "revisit", "a", None, {}, None),
        (12, "host.com/x", None, "revisit", "a", None, {}, None),
        (13, None, 1, "response", "a", None, {}, "lost"),
        (14, "host.com/x", None, "response", "a", None, {}, "lost"),
        (15, "host.com/x", 200, "other", "a", None, {}, "no"),
        (16, "host.com/x", 201, "revisit", "b", None, {}, None),
        (16, "host.com/x", 201, "revisit", "b", None, {}, None),
    ]
    schema = "record_id long, url string, at long, kind string, etag string, last_modified string, headers map<string,string>, payload string"
    records = spark.createDataFrame(rows, schema).withColumn("bucket", F.lit("clash")).repartition(4)
    found = sorted((r.record_id, r.status, r.response_id, r.payload) for r in revisits.resolve(records).collect())
    assert found == [
        (2, "resolved", 1, "one"),
        (3, "resolved", 1, "one"),
        (5, "resolved", 4, "two"),
        (6, "mismatch", None, None),
        (7, "missing", None, None),
        (9, "resolved", 8, "three"),
        (10, "mismatch", None, None),
        (11, "missing", None, None),
        (12, "missing", None, None),
        (16, "resolved", 4, "two"),
        (16, "resolved", 4, "two"),
    ]
    headers = {r.record_id: r.headers for r in revisits.resolve(records).collect()}
    assert headers[2] == {"date": "2", "content-type": "t", "etag": "a", "vary": "v"}
    assert headers[3] == head and headers[5] == {}
    assert revisits.resolve(records.limit(0)).count() == 0
