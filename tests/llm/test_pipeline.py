"""The corpus pipeline as a whole: what it returns, over rows without ids and with repeated ones."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from veriscope.llm import near_dup, packing, secrets
from veriscope.llm.tables import DOCUMENTS

from .conftest import changed, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, *rows):
    return spark.createDataFrame([(i, text, "en", source, len(text or "")) for i, text, source in rows], SCHEMA)


def test_near_duplicates_stage_judges_rows_without_an_id_and_of_one_id(spark):
    """A copy goes also where another row without an id, or of its id, stays."""
    one, two, three, four, five = (prose(200 + i, 120) for i in range(5))
    docs = documents(
        spark,
        (None, changed(one, 30), "a"),  # a copy of 5, while other rows without an id stay
        (5, one, "b"),
        (None, two, "c"),
        (None, two, "d"),
        (None, changed(two, 40), "e"),
        (7, three, "f"),
        (7, changed(one, 50), "g"),  # a copy of 5, while its own id stays by another text
        (8, four, "h"),
        (8, four, "h"),
        (9, changed(four, 60), "i"),
        (None, five, "j"),
        (None, None, "k"),
        (None, " \n", "l"),
        (None, None, "k"),
        (10, "", "m"),
    )
    kept = corpus_pipeline.near_duplicates(spark, docs.repartition(3), "")
    assert kept.columns == list(DOCUMENTS)
    found = Counter(r.source for r in kept.collect())
    assert sum(found.pop(x, 0) for x in "cde") == 1
    assert found == Counter({"b": 1, "f": 1, "h": 2, "j": 1, "k": 2, "l": 1, "m": 1})
    # As the operator says of each row; only of a component without any id it keeps all.
    verdicts = Counter(r.doc_id for r in near_dup.near_duplicates(docs).filter("kept").collect())
    assert verdicts == Counter({None: 7, 5: 1, 7: 1, 8: 2, 10: 1})


def test_pipeline_returns_the_sequences(spark, tmp_path):
    """The result holds the ids of every remaining text, masked, and they fill the sequences without gaps or overlaps."""
    from tokenizers import Tokenizer

    secret = "password = hunter2hunter2hunter2"
    texts = [prose(300 + i, 80 + 9 * i) for i in range(30)]
    texts[4] += " " + secret
    texts[5] = prose(9, 6000)
    rows = [(i, text, "s") for i, text in enumerate(texts)] + [(99, changed(texts[20], 11), "s"), (None, changed(texts[21], 12), "s")]
    documents(spark, *rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(77, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert result.columns == [*names, "ids", "sequence_id", "offset"]
    tokenizer = Tokenizer.from_file(packing.vocabulary())
    pieces, sequences = {}, {}
    for r in result.collect():
        pieces[r.doc_id, r.piece] = r.ids
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    texts[4] = texts[4].replace(secret, secrets.MASK)
    for i, text in enumerate(texts):
        own = [x for k in range(len(pieces)) for x in pieces.pop((i, k), [])]
        assert own == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
    assert not pieces
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(len(x) for _, x in parts[:i]) for i in range(len(parts))]
        assert sum(len(x) for _, x in parts) <= packing.CAPACITY
    # Without being asked for ids the operator gives the same places.
    plain = packing.packed(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert plain.columns == [*names, "sequence_id", "offset"]
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, result.drop("ids").collect()))


def test_packing_returns_ids_of_any_size(spark):
    for largest in (0, 32_767, 32_768, 65_534, 65_535, 65_536, 2**31 - 1):
        rows = [(i, 0, 0, 3, i, [0, i, largest]) for i in range(5)] + [(None, 0, 0, 1, 7, [min(largest, 40_000)])]
        parts = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>")
        packed = packing.pack(parts)
        assert packed.schema["ids"].dataType == parts.schema["ids"].dataType
        assert Counter((r.doc_id, tuple(r.ids)) for r in packed.collect()) == Counter((r[0], tuple(r[5])) for r in rows)
    assert packing.packed(parts.select("doc_id").withColumn("text", F.lit(None).cast("string")).limit(0), with_ids=True).count() == 0
