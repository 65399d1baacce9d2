"""Quality classifier: random-indexing word vectors pooled per document, a
two-layer network on top, and calibrated probabilities.

Every word has a sparse random index vector of +1 and -1, fixed by its hash. The
context vector of a unit is the sum of the index vectors around it. Units are
frequent words and word shapes (runs of letter case, digits and marks), so that
a word never seen takes the vector of its shape. A document's features are the
mean of its words' context vectors, the mean product of neighbouring index
vectors (words that repeat agree with themselves), and its length. A network of
one hidden layer is trained on labelled documents, and one temperature, fitted
on documents kept out of that training, makes its outputs probabilities.

Word vectors and network are fitted on a sample of labelled documents whose size
is a parameter. Scoring reads every text whole, in chunks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusweave.llm.training import crc_mod, sampled, seeded
from corpusweave.session import written


@dataclass(frozen=True)
class QualityConfig:
    """``sample_docs``: labelled documents that may train. ``units``: words and
    shapes that get a vector of their own. ``cut``: score from which a document
    is good. Documents with crc32(doc_id) mod ``fold`` = 0 never train."""

    sample_docs: int = 6_000
    units: int = 20_000
    min_count: int = 10
    dim: int = 32
    nonzero: int = 4
    window: int = 2
    hidden: int = 32
    epochs: int = 60
    fold: int = 5
    cut: float = 0.3
    seed: int = 5


class _Shapes(dict):
    """Character classes: capital, small, digit, and each mark by itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        found = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "x" if c.isalpha() else c
        self[code] = found
        return found


_SHAPES = _Shapes()
_RUNS = re.compile(r"([^\n])\1+")


def shapes(words: list[str]) -> list[str]:
    """``IN!!`` is ``A!``, ``The`` is ``Aa``; at most eight runs count. Words hold no line end."""
    return ["\x00" + s[:8] for s in _RUNS.sub(r"\1", "\n".join(words).translate(_SHAPES)).split("\n")] if words else []


def index_vectors(words: list[str], dim: int, nonzero: int, seed: int) -> np.ndarray:
    """Sparse random vectors of length one, the same for a word wherever it is met."""
    h = np.array([xxhash.xxh64_intdigest(w.encode(), seed) for w in words], dtype=np.uint64)
    out = np.zeros((len(words), dim), dtype=np.float32)
    rows = np.arange(len(words))
    for k in range(nonzero):
        at = (h >> np.uint64(8 * k)) % np.uint64(dim)
        sign = np.where((h >> np.uint64(32 + k)) & np.uint64(1), 1, -1)
        out[rows, at.astype(np.int64)] += sign  # each row once
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)


@dataclass
class QualityModel:
    config: QualityConfig
    unit: dict[str, int] = field(default_factory=dict)  # words and shapes that have a context vector
    context: np.ndarray | None = None
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None
    layers: list[np.ndarray] | None = None
    temperature: float = 1.0
    prior: float = 0.5


_CHUNK = 50_000  # words whose vectors are held at a time
_KEPT = 100_000


class _Vocabulary:
    """Vectors of the words met, kept up to a bound."""

    def __init__(self, model: QualityModel):
        self.model, self.at = model, {}
        c = model.config
        self.size = 0
        self.index = np.zeros((1 << 16, c.dim), dtype=np.float32)
        self.context = np.zeros((1 << 16, c.dim), dtype=np.float32)

    def ids(self, words: list[str]) -> np.ndarray:
        if len(self.at) > _KEPT:
            self.at, self.size = {}, 0
        found = list(map(self.at.get, words))
        if None in found:
            self._add([*dict.fromkeys(w for w, k in zip(words, found, strict=True) if k is None)])
            found = map(self.at.__getitem__, words)
        return np.fromiter(found, dtype=np.int64, count=len(words))

    def _add(self, new: list[str]) -> None:
        c, m = self.model.config, self.model
        end = self.size + len(new)
        if end > len(self.index):
            room = max(end, 2 * len(self.index)) - len(self.index)
            self.index, self.context = (np.vstack([a, np.zeros((room, c.dim), dtype=np.float32)]) for a in (self.index, self.context))
        self.index[self.size : end] = index_vectors(new, c.dim, c.nonzero, c.seed)
        if m.context is not None:
            none = len(m.context) - 1
            known = [m.unit.get(w, -1) for w in "\n".join(new).lower().split("\n")]
            of_shape = [m.unit.get(s, none) for s in shapes(new)]
            both = m.context[np.array(of_shape)].copy()
            has = np.array(known) >= 0
            both[has] = (both[has] + m.context[np.array(known)[has]]) / 2
            self.context[self.size : end] = both
        self.at.update(zip(new, range(self.size, end), strict=True))
        self.size = end


def features(texts: Iterable[str | None], n_texts: int, vocabulary: _Vocabulary) -> np.ndarray:
    """One row per text. Words are taken up in chunks: many short texts share
    one, a long text has several."""
    dim = vocabulary.model.config.dim
    out = np.zeros((n_texts, 2 * dim + 1))
    held: list[str] = []
    spans: list[tuple[int, int, int, int]] = []  # row, first word, own words, words with the next one

    def flush() -> None:
        if not held:
            return
        ids = vocabulary.ids(held)
        row, start, own, more = np.array(spans).T
        none = np.zeros((1, dim), dtype=np.float32)
        context = np.concatenate([vocabulary.context[ids], none])
        index = vocabulary.index[ids]
        products = np.concatenate([index[:-1] * index[1:], none, none])
        between = lambda a, n: np.add.reduceat(a, np.stack([start, start + n], axis=1).ravel(), axis=0, dtype=np.float64)[::2]
        np.add.at(out[:, :dim], row, between(context, own))
        np.add.at(out[:, dim : 2 * dim], row, between(products, more - 1) * (more > 1)[:, None])
        held.clear()
        spans.clear()

    for row, text in enumerate(texts):
        words = (text or "").split()
        out[row, -1] = len(words)
        for at in range(0, len(words), _CHUNK):
            part = words[at : at + _CHUNK + 1]
            spans.append((row, len(held), min(len(part), _CHUNK), len(part)))
            held.extend(part)
            if len(held) >= _CHUNK:
                flush()
    flush()
    n = out[:, -1:].copy()
    out[:, :dim] /= np.maximum(n, 1)
    out[:, dim : 2 * dim] *= dim / np.maximum(n - 1, 1)
    out[:, -1] = np.log1p(n[:, 0])
    return out


def _contexts(config: QualityConfig):
    """Sums of index vectors around each unit, for a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(QualityModel(config))
        for batch in batches:
            unit: dict[str, int] = {}
            total = np.zeros((1024, config.dim))
            count = np.zeros(1024, dtype=np.int64)
            for text in batch.column(0):
                words = (text.as_py() or "").split()
                for at in range(0, len(words), _CHUNK):
                    part = words[at : at + _CHUNK]
                    ids = vocabulary.ids(part)  # may replace the tables
                    v = vocabulary.index[ids].astype(np.float64)
                    around = np.zeros_like(v)
                    for d in range(1, config.window + 1):
                        around[d:] += v[:-d]
                        around[:-d] += v[d:]
                    for names in ([w.lower() for w in part], shapes(part)):
                        ids = np.fromiter((unit.setdefault(u, len(unit)) for u in names), dtype=np.int64, count=len(names))
                        while len(unit) > len(total):
                            total, count = np.vstack([total, np.zeros_like(total)]), np.concatenate([count, np.zeros_like(count)])
                        np.add.at(total, ids, around)
                        count += np.bincount(ids, minlength=len(count))
            n = len(unit)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(unit), pa.string()), pa.array(count[:n]), *(pa.array(total[:n, k]) for k in range(config.dim))],
                    ["unit", "n", *(f"v{k}" for k in range(config.dim))],
                )

    return run


def _network(x: np.ndarray, y: np.ndarray, config: QualityConfig) -> list[np.ndarray]:
    """Two layers by Adam on the log loss with a little weight decay."""
    rng = seeded("quality", config.seed)
    layers = [
        rng.standard_normal((x.shape[1], config.hidden)) / np.sqrt(x.shape[1]), np.zeros(config.hidden),
        rng.standard_normal((config.hidden, 1)) / np.sqrt(config.hidden), np.zeros(1),
    ]
    m, v, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for _ in range(config.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            a, t = x[rows], y[rows, None]
            h = np.tanh(a @ layers[0] + layers[1])
            err = (1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -30, 30))) - t) / len(rows)
            back = (err @ layers[2].T) * (1 - h * h)
            slopes = [a.T @ back + 1e-4 * layers[0], back.sum(axis=0), h.T @ err + 1e-4 * layers[2], err.sum(axis=0)]
            step += 1
            for k, g in enumerate(slopes):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                layers[k] = layers[k] - 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def _logits(x: np.ndarray, model: QualityModel) -> np.ndarray:
    z = (x - model.mean) / model.deviation
    w1, b1, w2, b2 = model.layers
    return (np.tanh(z @ w1 + b1) @ w2 + b2)[:, 0]


def probabilities(x: np.ndarray, model: QualityModel) -> np.ndarray:
    if model.layers is None:
        return np.full(len(x), model.prior)
    return 1 / (1 + np.exp(-np.clip(_logits(x, model) / model.temperature, -30, 30)))


def fit(documents: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> QualityModel:
    """Word vectors, network and temperature from up to ``sample_docs`` labelled documents.

    ``labels(doc_id, quality)``; rows with null label, null text or of the
    held-out fold do not train; repeated labels that disagree are left out. With
    one class or none the score is that class's share (0.5 without labels).
    """
    kept = labels.where(F.col("quality").isNotNull() & (crc_mod(F.col("doc_id"), config.fold) != 0))
    kept = kept.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_top")).where("label = _top")
    ids = sampled(kept.select("doc_id", "label"), config.sample_docs)
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull())
    # The sample of ids is bounded by sample_docs.
    rows = written(texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]), "quality-sample")
    model = QualityModel(config)
    sums = rows.select("text").mapInArrow(
        _contexts(config), "unit string, n long, " + ", ".join(f"v{k} double" for k in range(config.dim))
    )
    sums = sums.groupBy("unit").agg(F.sum("n").alias("n"), *(F.sum(f"v{k}").alias(f"v{k}") for k in range(config.dim)))
    found = sums.where(F.col("n") >= config.min_count).orderBy(F.desc("n"), "unit").limit(config.units).collect()
    model.unit = {r["unit"]: k for k, r in enumerate(found)}
    vectors = np.array([[r[f"v{k}"] for k in range(config.dim)] for r in found]).reshape(len(found), config.dim)
    vectors /= np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-9)
    model.context = np.vstack([vectors, np.zeros((1, config.dim))]).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(model)
        for batch in batches:
            x = features(batch.column(2).to_pylist(), batch.num_rows, vocabulary)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    # At most sample_docs rows of features come to the driver.
    got = rows.select(F.col("doc_id").cast("long"), F.col("label").cast("int"), "text").mapInArrow(run, "doc_id long, label int, x array<double>")
    got = sorted(got.collect(), key=lambda r: r["doc_id"])
    y = np.array([float(r["label"]) for r in got])
    if len(y):
        model.prior = float(y.mean())
    if len(set(y)) < 2:
        return model
    x = np.array([r["x"] for r in got])
    kept_out = np.array([xxhash.xxh64_intdigest(str(r["doc_id"]), 9) % 5 == 0 for r in got])
    if len(set(y[~kept_out])) < 2:
        kept_out[:] = False
    model.mean, model.deviation = x[~kept_out].mean(axis=0), np.maximum(x[~kept_out].std(axis=0), 1e-6)
    z = (x - model.mean) / model.deviation
    model.layers = _network(z[~kept_out], y[~kept_out], config)
    if kept_out.any():
        logits, t = _logits(x[kept_out], model), y[kept_out]
        heat = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, -np.where(t > 0, 1, -1) * logits / h)) for h in heat]
        model.temperature = float(heat[int(np.argmin(loss))])
    return model


def scored(documents: DataFrame, model: QualityModel, columns: list[str]) -> DataFrame:
    """``_row``, a struct of ``columns`` of ``documents``, and ``_score``, the
    probability that the text is good. Null and empty texts are scored as texts
    without words."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    fields = [F.col(f"`{c}`") for c in columns]
    packed = documents.select(F.struct(*fields).alias("_row"), *([] if "text" in columns else ["text"]))
    in_row = columns.index("text") if "text" in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(shared.value)
        for batch in batches:
            row = batch.column(0)
            text = batch.column(1) if in_row is None else row.field(in_row)
            x = features((t.as_py() for t in text), len(text), vocabulary)
            yield pa.RecordBatch.from_arrays([row, pa.array(probabilities(x, vocabulary.model))], ["_row", "_score"])

    schema = T.StructType([packed.schema["_row"], T.StructField("_score", T.DoubleType())])
    return packed.mapInArrow(run, schema)


def judge(documents: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``documents``.

    Only texts are inputs of a score. Repeated rows stay; rows without doc_id
    never train and are not held out. Extra columns go.
    """
    found = scored(documents, fit(documents, labels, config), ["doc_id"])
    held = F.coalesce(crc_mod(F.col("doc_id"), config.fold) == 0, F.lit(False)).alias("held_out")
    return found.select("_row.doc_id", "_score").select(
        "doc_id", held, F.col("_score").alias("score"), (F.col("_score") >= config.cut).cast("int").alias("predicted")
    )


def accepted(documents: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The documents that score ``cut`` or more, with their columns."""
    found = scored(documents, fit(documents, labels, config), documents.columns)
    return found.where(F.col("_score") >= config.cut).select("_row.*")
