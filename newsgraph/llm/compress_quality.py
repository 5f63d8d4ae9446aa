"""Quality classifier by compression with trained dictionaries.

Two zstandard dictionaries are trained, one on good and one on bad labelled
texts.  A text is compressed with each, in chunks of ``CHUNK`` bytes that
know nothing of each other (so a long text cannot become its own
dictionary), and

    d = (bytes with the bad dictionary - bytes with the good one)
        / (bytes with both)

is the normalised difference.  A text that repeats itself is small with
either dictionary and so has a ``d`` near 0; the logarithm of how small it is
(bytes with both / twice the text's bytes) tells it from others.  A logistic
curve over both, fitted on labelled texts that the dictionaries have not seen,
gives the probability of label 1.

Bounds: the dictionaries and the curve are fitted on the driver from at most
``SAMPLE_TEXTS`` labelled texts a class, those of the smallest id hashes,
whose texts hold at most ``SAMPLE_TEXT_BYTES`` bytes each.  Every text is
scored, over its whole length, wherever Spark has put it.

Null and empty texts have d = 0 and log size 0.  If a class has too few texts to train a
dictionary from, every score is the share of label 1 among the labelled rows
(0.5 without any).  A document with several label rows counts with each;
null labels are ignored.  Rows with null or equal ids are scored as they are;
extra columns do not matter.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_TEXTS = 1500
SAMPLE_TEXT_BYTES = 32_768
DICT_BYTES = 64 * 1024
CHUNK = 2048
LEVEL = 3
FOLDS = 5
CUT = 0.3


@dataclass
class Model:
    good: bytes = b""
    bad: bytes = b""
    slopes: tuple[float, float] = (0.0, 0.0)
    shift: float = 0.0
    coders: list = field(default_factory=list, repr=False, compare=False)

    def sizes(self, text: str) -> tuple[float, float]:
        """Normalised difference of the compressed sizes, and the logarithm
        of their mean share of the text's size."""
        if not self.good or not text:
            return 0.0, 0.0
        import zstandard
        if not self.coders:
            for raw in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                self.coders.append(zstandard.ZstdCompressor(
                    dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        good, bad = (c.compress for c in self.coders)
        data = text.encode()
        g = b = 0
        for i in range(0, len(data), CHUNK):
            part = data[i:i + CHUNK]
            g += len(good(part))
            b += len(bad(part))
        return (b - g) / (b + g), math.log((b + g) / (2 * len(data)))

    def score(self, d: float, size: float) -> float:
        z = self.slopes[0] * d + self.slopes[1] * size + self.shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def __getstate__(self):
        return self.__dict__ | {"coders": []}


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("long").cast("string").cast("binary")), F.lit(FOLDS))


def _dictionary(texts: list[str], size: int) -> bytes:
    import zstandard
    parts = [data[i:i + CHUNK] for data in (t.encode() for t in texts) for i in range(0, len(data), CHUNK)]
    try:
        return zstandard.train_dictionary(size, parts, k=512, d=8, steps=4).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text for the trainer
        return b""


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and shift of a lightly damped logistic fit (Newton's method)."""
    scale = np.where(x.std(0) > 0, x.std(0), 1.0)
    z = np.hstack([x / scale, np.ones((len(x), 1))])
    w, damp = np.zeros(z.shape[1]), np.diag([1e-2] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + damp, z.T @ (y - p) - damp @ w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1])


def sample(docs: DataFrame, labels: DataFrame, texts: int = SAMPLE_TEXTS,
           text_bytes: int = SAMPLE_TEXT_BYTES) -> list[tuple[int, str]]:
    """(label, text) of at most ``texts`` training rows a class."""
    train = (labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0))
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the sample's ids first (a bounded top list per class), so that only its texts are moved
    small = text.where(F.octet_length("text").between(1, text_bytes)).select("doc_id").distinct()
    known = train.join(small, "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = (known.where("quality = 1").orderBy(*order).limit(texts)
              .unionByName(known.where("quality = 0").orderBy(*order).limit(texts)))
    rows = (text.where(F.octet_length("text").between(1, text_bytes)).join(F.broadcast(picked), "doc_id")
            .orderBy(*order, "quality", "text").limit(2 * texts).collect())
    return [(r["quality"], r["text"]) for r in rows]


def fit(rows: list[tuple[int, str]], prior: float) -> Model:
    """Model from labelled texts: even rows of each class train its
    dictionary, odd ones the curve.  ``prior`` is the share of label 1 among
    all training labels; the sample holds the classes in another one."""
    texts = {y: [t for label, t in rows if label == y] for y in (0, 1)}
    edge = min(max(prior, 1e-3), 1 - 1e-3)
    base = Model(shift=math.log(edge / (1 - edge)))
    # equally large, or the larger one would win by its size
    size = min([DICT_BYTES, *(sum(len(t.encode()) for t in texts[y][::2]) // 4 for y in (0, 1))])
    good, bad = _dictionary(texts[1][::2], size), _dictionary(texts[0][::2], size)
    held = [(y, t) for y in (0, 1) for t in texts[y][1::2]]
    if not good or not bad or len({y for y, _ in held}) < 2:
        return base
    model = Model(good, bad)
    x, y = np.array([model.sizes(t) for _, t in held]), np.array([float(y) for y, _ in held])
    slopes, shift = _logistic(x, y)
    share = y.mean()
    return Model(good, bad, tuple(map(float, slopes)), shift + base.shift - math.log(share / (1 - share)))


def train(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    """Fit on the labelled rows outside fold 0."""
    known = labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0))
    prior = known.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    return fit(sample(docs, labels, **bounds), 0.5 if prior is None else prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``difference``, ``score`` and ``predicted`` (columns of
    these names are replaced); the text decides alone."""
    names = ("difference", "score", "predicted")
    docs = docs.select("*", F.col("text").cast("string").alias("_text")).drop(*names)
    kept = [c for c in docs.columns if c != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.sizes(t.as_py() or "") for t in batch.column(len(kept))]
            s = [model.score(*v) for v in x]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([d for d, _ in x], pa.float64()), pa.array(s, pa.float64()),
                 pa.array([int(p >= CUT) for p in s], pa.int32())], names=[*kept, *names])

    schema = docs.drop("_text").schema.add("difference", "double").add("score", "double").add("predicted", "integer")
    return docs.mapInArrow(run, schema)


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = score(slim, train(docs, labels))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                        "score", "predicted", "difference")


def keep_good(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted 1, with its columns; the model is fitted
    on the texts of ``labelled``."""
    return score(docs, train(labelled, labels)).where("predicted = 1").select(docs.columns)
