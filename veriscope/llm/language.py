"""Language identification by a small byte convolutional network in numpy.

Bytes are embedded, filters of several widths slide over fixed-length windows, each filter keeps its maximum, and a softmax
layer names the language.  Training uses a bounded sample: of each language at most ``PER_LANGUAGE`` different texts, and
``SAMPLE_WINDOWS`` windows of each.  Prediction covers every window of every text; a text's score is the
softmax of its windows' mean log-probabilities, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

PER_LANGUAGE = 600
SAMPLE_WINDOWS = 3
WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 12  # of each width
EMBEDDING = 8
EPOCHS = 8
BATCH = 64
RATE = 0.01
HELD_OUT_MOD, HELD_OUT_REST = 4, 2
SPAN = max(WIDTHS)
SALTS = 16


@dataclass
class Network:
    """Weights; ``conv`` holds all widths side by side, with zeros beyond a filter's own width."""

    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    conv: np.ndarray  # SPAN * EMBEDDING x filters
    bias: np.ndarray
    dense: np.ndarray  # filters x languages
    dense_bias: np.ndarray

    def windows(self, raw: np.ndarray) -> np.ndarray:
        """Neighbouring embeddings of each place, from bytes (n x (length + SPAN - 1))."""
        length = raw.shape[1] - SPAN + 1
        spread = np.empty((*raw.shape[:1], length, SPAN * EMBEDDING), dtype=np.float32)
        own = self.embedding[raw]
        for j in range(SPAN):
            spread[:, :, j * EMBEDDING : (j + 1) * EMBEDDING] = own[:, j : j + length]
        return spread

    def log_probabilities(self, raw: np.ndarray) -> np.ndarray:
        spread = self.windows(raw)
        answers = spread.reshape(-1, spread.shape[2]) @ self.conv
        top = np.maximum(answers.reshape(*spread.shape[:2], -1).max(axis=1) + self.bias, 0)
        return _log_softmax(top @ self.dense + self.dense_bias)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def fit(windows: list[bytes], answers: list[str], seed: int = 7) -> Network | None:
    """A network trained on labelled windows (None without any); the same input gives the same network."""
    if not windows:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted(set(answers))
    raw = np.stack([_padded(np.frombuffer(w, dtype=np.uint8)[:WINDOW]) for w in windows])
    goal = np.array([languages.index(a) for a in answers])
    filters = FILTERS * len(WIDTHS)
    mask = np.repeat(
        np.array([[offset < width for width in WIDTHS for _ in range(FILTERS)] for offset in range(SPAN)]), EMBEDDING, axis=0
    )
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        (rng.normal(0, 0.3, (SPAN * EMBEDDING, filters)) * mask).astype(np.float32),
        np.zeros(filters, dtype=np.float32),
        rng.normal(0, 0.3, (filters, len(languages))).astype(np.float32),
        np.zeros(len(languages), dtype=np.float32),
    )
    names = ("embedding", "conv", "bias", "dense", "dense_bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(raw))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            gradients = _gradients(net, raw[rows], goal[rows])
            gradients["conv"] *= mask
            step += 1
            for n in names:  # Adam
                g = gradients[n]
                first[n] += 0.1 * (g - first[n])
                second[n] += 0.001 * (g * g - second[n])
                change = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, (getattr(net, n) - RATE * change).astype(np.float32))
    return net


def _gradients(net: Network, raw: np.ndarray, goal: np.ndarray) -> dict[str, np.ndarray]:
    spread = net.windows(raw)
    n, length, _ = spread.shape
    answers = (spread.reshape(n * length, -1) @ net.conv).reshape(n, length, -1)
    place = answers.argmax(axis=1)
    top = np.take_along_axis(answers, place[:, None], axis=1)[:, 0] + net.bias
    hidden = np.maximum(top, 0)
    error = np.exp(_log_softmax(hidden @ net.dense + net.dense_bias))
    error[np.arange(n), goal] -= 1
    error /= n
    back = (error @ net.dense.T) * (top > 0)
    seen = spread[np.arange(n)[:, None], place]  # n x filters x SPAN * EMBEDDING
    own = np.zeros_like(net.embedding)
    to_inputs = (back[:, :, None] * net.conv.T[None]).reshape(n, -1, SPAN, EMBEDDING)
    read = raw[np.arange(n)[:, None, None], place[:, :, None] + np.arange(SPAN)]
    np.add.at(own, read, to_inputs)
    return {
        "embedding": own,
        "conv": np.einsum("nf,nfk->kf", back, seen),
        "bias": back.sum(axis=0),
        "dense": hidden.T @ error,
        "dense_bias": error.sum(axis=0),
    }


def _padded(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(WINDOW + SPAN - 1, dtype=np.uint8)
    out[: len(raw)] = raw
    return out


def is_held_out(mod: int, rest: int, doc_id: str = "doc_id"):
    """Whether crc32 of the id as text has this remainder; a NULL id never has."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % mod == rest, F.lit(False))


def sample(docs: DataFrame) -> tuple[list[bytes], list[str]]:
    """Labelled windows for training, from rows that are not held out and whose text has a letter."""
    raw = F.encode(F.col("text"), "UTF-8")
    spare = F.greatest(F.length(raw) - WINDOW, F.lit(0)) + 1
    picks = F.array(
        *(F.substring(raw, (F.pmod(F.xxhash64("text", F.lit(i)), spare) + 1).cast("int"), F.lit(WINDOW)) for i in range(SAMPLE_WINDOWS))
    )
    rows = (
        docs.filter(~is_held_out(HELD_OUT_MOD, HELD_OUT_REST) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        .select("lang", F.xxhash64("text").alias("pick"), picks.alias("windows"))
        .dropDuplicates(["lang", "pick"])
    )
    # Twice: the second window sees at most SALTS * PER_LANGUAGE rows of a language, however many tasks there are.
    for parts in (["lang", F.pmod("pick", F.lit(SALTS))], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy("pick"))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= PER_LANGUAGE).drop("rank")
    kept = rows.orderBy("lang", "pick").collect()
    return [bytes(w) for r in kept for w in r["windows"]], [r["lang"] for r in kept for _ in r["windows"]]


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; a narrow map over whole texts.

    ``und`` with score 0 for NULL, for texts without a letter, and for every text if there is no network.  Repeated rows get
    equal answers.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            known = [net is not None and text is not None and any(map(str.isalpha, text)) for text in texts]
            sums = np.zeros((len(texts), len(net.languages) if net else 1))
            sizes = np.zeros(len(texts))
            held: list[tuple[int, np.ndarray]] = []

            def flush(held: list, sums: np.ndarray, sizes: np.ndarray) -> None:
                if held:
                    owner = np.array([i for i, _ in held])
                    size = np.array([min(len(raw), WINDOW) for _, raw in held], dtype=float)
                    logs = net.log_probabilities(np.stack([_padded(raw) for _, raw in held]))
                    np.add.at(sums, owner, logs * size[:, None])
                    np.add.at(sizes, owner, size)
                    held.clear()

            for i, text in enumerate(texts):
                if known[i]:
                    raw = np.frombuffer(text.encode(), dtype=np.uint8)
                    for at in range(0, len(raw), WINDOW):
                        held.append((i, raw[at : at + WINDOW + SPAN - 1]))
                        if len(held) == 256:
                            flush(held, sums, sizes)
            flush(held, sums, sizes)
            mean = np.exp(_log_softmax(sums / np.maximum(sizes, 1)[:, None]))
            best = mean.argmax(axis=1)
            names = [net.languages[b] if ok else "und" for b, ok in zip(best, known, strict=True)]
            scores = np.where(known, mean.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", is_held_out(HELD_OUT_MOD, HELD_OUT_REST).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """Trains on the labelled rows of a table and names the language of all its rows."""
    return predict(docs, fit(*sample(docs)))
