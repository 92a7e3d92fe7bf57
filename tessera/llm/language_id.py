"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Texts are folded to lower-case letters with single spaces; n-grams of 1 to 3 characters are
hashed into ``DIMENSIONS`` features.  Document frequencies cover all learning documents.
The weights are fitted by follow-the-regularised-leader with elastic-net penalties on a
sample of about ``SAMPLE_PER_LANG`` documents of each language, chosen by a hash of the id
(the documented bound of the fit); a fifth of the sample is kept out to fit the temperature.

Null texts and texts without a letter get ``und`` and score 0, and so does everything when
no document can be learnt from.  Repeated documents are each predicted.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import SLICE_BYTES, add_columns, documents, fold, held_by_worker, slices

DIMENSIONS = 1 << 15
SAMPLE_PER_LANG = 400
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.01
UNKNOWN = "und"


def _folding() -> np.ndarray:
    """Code point -> lower-case letter, or a space for all that is no letter."""
    return held_by_worker(("letters",), _letters)


def _letters() -> np.ndarray:
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers and their counts; none for a text without a letter."""
    none = np.zeros(0, np.int64)
    if not text:
        return none, none
    letters = _folding()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    padded = np.concatenate([[32], letters, [32]]).astype(np.uint32)
    space = padded == 32
    if space.all():
        return none, none
    padded = padded[~(space & np.concatenate([[False], space[:-1]]))]
    hashed, parts = np.zeros(len(padded), np.uint32), []
    for n in range(1, 4):
        m = len(padded) - n + 1
        if m <= 0:
            break
        hashed = hashed[:m] * np.uint32(0x01000193) + padded[n - 1 : n - 1 + m]
        mixed = hashed ^ (hashed >> np.uint32(15))
        parts.append((mixed * np.uint32(0x9E3779B1)) >> np.uint32(17))
    counts = np.bincount(np.concatenate(parts).astype(np.int64), minlength=DIMENSIONS)
    index = np.flatnonzero(counts)
    return index, counts[index]


class Model:
    def __init__(self, langs: list[str], idf: np.ndarray) -> None:
        self.langs, self.idf = langs, idf
        self.weights = np.zeros((DIMENSIONS + 1, len(langs)))
        self.temperature = 1.0

    def vector(self, index: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = (1 + np.log(counts)) * self.idf[index]
        norm = np.sqrt(value @ value) or 1.0
        return np.append(index, DIMENSIONS), np.append(value / norm, 1.0)

    def logits(self, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at, value = self.vector(index, counts)
        return value @ self.weights[at]

    def predict(self, text: str | None) -> tuple[str, float]:
        index, counts = features(text)
        if not len(index) or not self.langs:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(index, counts) / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _fit(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """Follow the regularised leader over ``rows`` of (class, features, counts); then the temperature."""
    z, n = np.zeros_like(model.weights), np.zeros_like(model.weights)

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    train = [r for i, r in enumerate(rows) if i % 5]
    for _ in range(EPOCHS):
        for k, index, counts in train:
            at, value = model.vector(index, counts)
            w = weights(z[at], n[at])
            error = _softmax(value @ w)
            error[k] -= 1
            g = value[:, None] * error
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    model.weights = weights(z, n)
    kept = rows[::5]
    if not kept:
        return
    logits = np.array([model.logits(i, c) for _, i, c in kept])
    truth = np.array([k for k, _, _ in kept])
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on the given learning documents; null languages and texts are left out."""
    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(F.col(key)).alias("h")).where("t is not null and l is not null")
    totals = {r[0]: r[1] for r in rows.groupBy("l").count().collect()}  # one row per language
    if not totals:
        return Model([], np.ones(DIMENSIONS))

    def frequencies(batches):
        import pyarrow as pa

        found, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                for t in part.column("t").to_pylist():
                    found[features(t)[0]] += 1
                    n += 1
        yield pa.RecordBatch.from_pydict({"i": pa.array([*range(DIMENSIONS), -1], pa.int32()), "n": pa.array([*found.tolist(), n], pa.int64())})

    counted = rows.select("t").mapInArrow(frequencies, "i int, n long").groupBy("i").agg(F.sum("n")).collect()  # DIMENSIONS + 1 rows
    number = {r[0]: r[1] for r in counted}
    df = np.array([number.get(i, 0) for i in range(DIMENSIONS)])
    langs = sorted(totals)
    model = Model(langs, np.log((1 + number.get(-1, 0)) / (1 + df)) + 1)
    # a uniform share of each language, so that about per_lang documents are expected
    share = F.create_map(*[x for k, n in totals.items() for x in (F.lit(k), F.lit(min(1.0, per_lang / n)))])
    sample = rows.where(F.pmod("h", F.lit(1 << 30)) < share[F.col("l")] * (1 << 30)).orderBy("h", "t", "l")

    def make():
        return lambda texts: [tuple(a.tolist() for a in features(t)) for t in texts]

    fitted = add_columns(sample, "i array<long>, c array<long>", make, "t").drop("t").orderBy("h", "l", "i", "c").collect()
    position = {k: i for i, k in enumerate(langs)}
    _fit(model, [(position[r["l"]], np.array(r["i"], np.int64), np.array(r["c"], np.int64)) for r in fitted if r["i"]])
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the calibrated probability."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS + 1 rows, one column per language

    def make():
        predicted = sent.value.predict
        return lambda texts: [predicted(t) for t in texts]

    return add_columns(docs, "lang_pred string, score double", make, text)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs.where(~fold("doc_id", 1, 3)))
    return predict(docs.select("doc_id", "text", fold("doc_id", 1, 3).alias("held_out")), model).drop("text")
