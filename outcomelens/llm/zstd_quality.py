"""Quality scores from compression with a dictionary of good and one of bad text.

Two zstandard dictionaries are trained, one on text labelled good and one on text labelled bad. A text
is cut into blocks and every block is compressed with either dictionary; good text shrinks more with the
first. The difference of the two total sizes over their sum, with the text's own compressed share, goes
through a logistic curve fitted on labelled rows that no dictionary has seen.

Fitting reads a bounded, deterministic sample of the labelled rows: ``SAMPLE_DOCS`` per label, chosen by a
hash of the id, and of each at most ``SAMPLE_CHARS`` characters from a place chosen by a hash of the text.
Scoring reads whole texts.

Defined results
    Null and empty texts have no difference, so they get the score of the fitted intercept. A label counts by the
    majority of its rows; ties and null labels are not used. Without rows of both labels every score is 0.5. Extra
    columns pass through whatever their name; null ids and repeated documents keep their rows. Empty table: no rows.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.llm.common import fold, held_out, packed, prepare, query, table

SAMPLE_DOCS = 3_000
SAMPLE_CHARS = 8_192
BLOCK_BYTES = 512
DICTIONARY_BYTES = 112_640
LEVEL = 3


class QualityModel:
    """Two dictionaries and the curve; compressors are made where it is used."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> None:
        self.good, self.bad, self.weights, self.centre, self.scale = good, bad, weights, centre, scale

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_pair"}

    def _compressors(self):
        import zstandard

        if "_pair" not in self.__dict__:
            pair = []
            for raw in (self.good, self.bad):
                trained = zstandard.ZstdCompressionDict(raw)
                trained.precompute_compress(level=LEVEL)
                pair.append(
                    zstandard.ZstdCompressor(
                        level=LEVEL, dict_data=trained, write_content_size=False, write_dict_id=False
                    )
                )
            self._pair = pair
        return self._pair

    def features(self, text: str | None) -> tuple[float, float]:
        """Size difference over the sum, and log of the compressed share."""
        raw = (text or "").encode()
        if not raw:
            return 0.0, 0.0
        good, bad = self._compressors()
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        g = sum(len(good.compress(b)) for b in blocks)
        b = sum(len(bad.compress(x)) for x in blocks)
        return (b - g) / (b + g), float(np.log(min(b, g) / len(raw)))

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack((np.ones(len(features)), _terms((features - self.centre) / self.scale)))
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _terms(x: np.ndarray) -> np.ndarray:
    """Both features, and the bend of the second: repetitive text is unlike any other."""
    return np.column_stack((x[:, 0], x[:, 1], np.minimum(x[:, 1] + 1.0, 0.0)))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps for a weighted logistic curve with a small ridge (not on the intercept)."""
    x = np.column_stack((np.ones(len(x)), x))
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-9
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (w * (y - p)) - penalty @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _dictionary(texts: list[str]) -> bytes:
    """Trained on blocks; too little text becomes the dictionary as it is."""
    import zstandard

    blocks = [b for t in texts for raw in (t.encode(),) for i in range(0, len(raw), BLOCK_BYTES) if (b := raw[i : i + BLOCK_BYTES])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, k=1000, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(blocks)[-DICTIONARY_BYTES:]


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> QualityModel | None:
    """Fit from documents (doc_id, text) and labels (doc_id, quality); None without both labels."""
    votes = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg(F.col("quality").cast("double")).alias("vote"))
        .filter(F.col("vote") != 0.5)
        .select(F.col("doc_id").alias("id"), (F.col("vote") > 0.5).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in votes.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("label") == 1, min(1.0, sample_docs / sizes[1])).otherwise(min(1.0, sample_docs / sizes[0]))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    # About 2 x sample_docs rows of two numbers, so small enough to be sent to every executor.
    chosen = F.broadcast(votes.filter(place < share))
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1)
    rows = (
        docs.filter(F.length("text") > 0)
        .join(chosen, F.col("doc_id") == F.col("id"))
        .select("id", "label", F.substring(F.col("text"), start.cast("int") + 1, F.lit(SAMPLE_CHARS)).alias("text"))
        .dropDuplicates(["id"])
        .toPandas()
        .sort_values("id", ignore_index=True)
    )
    if rows["label"].nunique() < 2:
        return None
    # Documents that repeat one another stay on one side.
    half = rows["text"].map(lambda t: hash_half(t)).to_numpy()
    first = rows[half == 0] if rows[half == 0]["label"].nunique() == 2 else rows
    good, bad = (_dictionary(first.loc[first["label"] == k, "text"].tolist()) for k in (1, 0))
    second = rows[half == 1] if rows[half == 1]["label"].nunique() == 2 else rows
    model = QualityModel(good, bad, np.zeros(4), np.zeros(2), np.ones(2))
    x = np.array([model.features(t) for t in second["text"]])
    y = second["label"].to_numpy(float)
    model.centre, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    drawn = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    w = np.where(y == 1, sizes[1] / drawn[1], sizes[0] / drawn[0])
    model.weights = _logistic(_terms((x - model.centre) / model.scale), y, w * len(y) / w.sum())
    return model


def hash_half(text: str) -> int:
    import zlib

    return zlib.crc32(text[:200].encode()) & 1


_MODELS: dict[str, QualityModel] = {}


def score(docs: DataFrame, model: QualityModel | None, text: str = "text", carry=None) -> DataFrame:
    """``doc`` (the input row, or its ``carry`` columns), size_difference, score, predicted."""
    spark = docs.sparkSession
    prepare(spark)
    rows = packed(docs, carry, __text=text)
    if model is None:
        scored = rows.select("doc", F.lit(0.0).alias("size_difference"), F.lit(0.5).alias("score"))
    else:
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, pickle.dumps(model)))

        @F.pandas_udf("size_difference double, score double")
        def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            key, raw = shared.value
            if key not in _MODELS:
                _MODELS.clear()
                _MODELS[key] = pickle.loads(raw)
            own = _MODELS[key]
            for batch in texts:
                x = np.array([own.features(t) for t in batch]).reshape(-1, 2)
                yield pd.DataFrame({"size_difference": x[:, 0], "score": own.scores(x)})

        scored = rows.select("doc", measure("__text").alias("m")).select("doc", "m.*")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op6_compression_quality")
def op6_compression_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = learn(docs.filter(fold(F.col("doc_id")) != 1), labels.filter(fold(F.col("doc_id")) != 1))
    found = score(docs, model, carry=["doc_id"])
    return found.select("doc.doc_id", held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted")
