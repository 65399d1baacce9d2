"""Language identification in two steps: the family, then the language in it.

A text becomes a vector of hashed character n-grams (one to three letters, words
marked at both ends). Families are found from the data: the languages' mean
vectors are merged, nearest first, until about the square root of their number
is left. A linear model for each family decides first. Within it, linear support
vector machines compare the languages two by two; the one that wins most, then
by the larger margins, is the answer.

The models are fitted on a bounded number of documents for each language, and on
every language there is. Features stay in a written sample: the driver holds a
mean vector a language and the models, tasks hold a shard of the sample or two
blocks of a family's languages. Every text is scored whole, in chunks of bounded
size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.llm.training import crc_mod, sampled
from corpusweave.session import written

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageConfig:
    """``per_language`` bounds the documents that train each language.
    Documents with crc32(doc_id) mod ``fold`` = ``held`` never train. The family
    models are trained in shards of about ``shard_rows``, each with about
    ``shard_least`` rows of every language or more, and averaged; a task of the
    pairs gets two blocks of ``block`` languages."""

    per_language: int = 600
    shard_rows: int = 6000
    shard_least: int = 4
    block: int = 8
    dim: int = 4096
    fold: int = 4
    held: int = 2
    penalty: float = 1e-4
    rounds: int = 150


_CHUNK = 1 << 18  # characters at a time
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _TABLE[0]


def _counts(text: str, dim: int) -> np.ndarray | None:
    """N-gram counts of a text, None without letters."""
    total = None
    lowered = text.lower()
    for at in range(0, len(lowered), _CHUNK):
        # Two more characters on each side, so that no n-gram is cut; those of the overlap count once.
        lo = max(0, at - 2)
        codes = np.frombuffer(lowered[lo : at + _CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        if not letter.any():
            continue
        codes = np.where(letter, codes, 32).astype(np.uint64)
        if lo == 0:
            codes, letter = np.concatenate([[np.uint64(32)], codes]), np.concatenate([[False], letter])
        fresh = np.zeros(len(codes), dtype=bool)
        fresh[at - lo if lo else 0 :] = True
        a, b, c = (np.uint64(f) for f in _FACTORS)
        one = codes * a
        two = one[1:] + codes[:-1] * b
        three = two[1:] + codes[:-2] * c
        grams = [one[letter & fresh], two[(letter[1:] | letter[:-1]) & fresh[1:]], three[letter[1:-1] & fresh[2:]]]
        h = np.concatenate([(g ^ (g >> np.uint64(15)) ^ np.uint64(k)) * a >> np.uint64(11) for k, g in enumerate(grams)])
        found = np.bincount((h % np.uint64(dim)).astype(np.int64), minlength=dim)
        total = found if total is None else total + found
    return total


def features(texts: Iterable[str | None], n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of the counts at length one, and whether a text has a letter."""
    out, some = np.zeros((n, dim), dtype=np.float32), np.zeros(n, dtype=bool)
    for row, text in enumerate(texts):
        counts = _counts(text, dim) if text else None
        if counts is not None:
            out[row], some[row] = np.sqrt(counts / counts.sum()), True
    return out, some


def _linear_svm(x: np.ndarray, y: np.ndarray, config: LanguageConfig) -> np.ndarray:
    """Weights and bias of a squared-hinge support vector machine, ``y`` of -1 and 1;
    one machine a column if ``y`` has columns.

    Accelerated gradient steps on the class-balanced loss.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    weight = np.where(y > 0, 0.5 / np.maximum(1, (y > 0).sum(axis=0)), 0.5 / np.maximum(1, (y < 0).sum(axis=0))).astype(np.float32)
    w = np.zeros((x.shape[1], *y.shape[1:]), dtype=np.float32)
    ahead, t = w, 1.0
    step = 1 / (2 * 2 + config.penalty)  # rows have length at most sqrt(2)
    for _ in range(config.rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        slope = config.penalty * ahead - 2 * (x.T @ (weight * y * slack))
        new = (ahead - step * slope).astype(np.float32)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = (new + (t - 1) / t_new * (new - w)).astype(np.float32)
        w, t = new, t_new
    return w


@dataclass
class LanguageModel:
    config: LanguageConfig
    languages: list[str] = field(default_factory=list)
    family: np.ndarray | None = None  # of each language
    between: np.ndarray | None = None  # one column per family
    pairs: list[tuple[int, int]] = field(default_factory=list)  # languages of one family, family by family
    within: np.ndarray | None = None  # one column per pair


def families(means: np.ndarray) -> np.ndarray:
    """Family number of each language: average-linkage merging of mean vectors by cosine.

    No family gets more than about twice the square root of the languages, so
    the pairs stay far fewer than all pairs.
    """
    n = len(means)
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
    total, size, group = (unit @ unit.T).astype(np.float64), np.ones(n), np.arange(n)  # of first members
    most = max(4, 2 * np.ceil(np.sqrt(n)))
    live = np.ones(n, dtype=bool)

    def row(a: int) -> tuple[float, int]:
        """Nearest later group and how near it is."""
        free = live & (size + size[a] <= most)
        free[: a + 1] = False
        near = np.where(free, total[a] / (size[a] * size), -np.inf)
        return near.max(), int(near.argmax())

    best, at = (np.array(v) for v in zip(*(row(a) for a in range(n)), strict=True))
    while live.sum() > max(1, round(np.sqrt(n))) and best.max() > -np.inf:
        a = int(best.argmax())
        b = int(at[a])
        total[a] += total[b]
        total[:, a] += total[:, b]
        size[a] += size[b]
        group[group == b] = a
        live[b], best[b] = False, -np.inf
        for k in np.flatnonzero(live[: b + 1]):
            if k == a or at[k] in (a, b):
                best[k], at[k] = row(k)
            elif k < a and size[k] + size[a] <= most and (near := total[k, a] / (size[k] * size[a])) >= best[k]:
                best[k], at[k] = near, a if near > best[k] else min(a, at[k])
    return np.unique(group, return_inverse=True)[1]


def _sample(documents: DataFrame, config: LanguageConfig) -> DataFrame:
    """``doc_id, label, x``, written: the documents that train, with their features."""
    usable = documents.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod(F.col("doc_id"), config.fold) != config.held)
    )
    ids = written(usable.groupBy("doc_id").agg(F.min("lang").alias("label")), "language-ids")
    sizes = ids.groupBy("label").agg(F.count("*").alias("n"))
    # The first by hash lie below a border, by more than ten deviations; only these meet in a window of their language.
    border = F.lit(-(2.0**63)) + F.lit(2.0**64) * (config.per_language + 10 * config.per_language**0.5 + 20) / F.col("n")
    first = ids.join(F.broadcast(sizes), "label").where(F.xxhash64("doc_id").cast("double") <= border).select("doc_id", "label")
    chosen = sampled(first, config.per_language, "label")
    rows = usable.drop("lang").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    dim = config.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x, some = features((t.as_py() for t in part.column(2)), part.num_rows, dim)
                packed = pa.array([r.astype(np.float16).tobytes() if ok else None for r, ok in zip(x, some, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), packed], ["doc_id", "label", "x"])

    got = rows.select(F.col("doc_id").cast("long"), "label", "text").mapInArrow(run, "doc_id long, label string, x binary")
    return written(got.where(F.col("x").isNotNull()), "language-sample")


def _unpacked(table: pa.Table) -> tuple[list[str], np.ndarray]:
    """Labels and features of sample rows, ordered by label and doc_id."""
    table = table.sort_by([("label", "ascending"), ("doc_id", "ascending")])
    x = np.empty((table.num_rows, len(table["x"][0].as_py()) // 2), dtype=np.float32)
    for k, row in enumerate(table["x"]):
        x[k] = np.frombuffer(row.as_buffer(), dtype=np.float16)
    return table["label"].to_pylist(), x


def _mean(table: pa.Table) -> pa.Table:
    label, x = _unpacked(table)
    mean = x.mean(axis=0, dtype=np.float64).astype(np.float32).tobytes()
    return pa.table({"label": label[:1], "n": pa.array([len(x)], pa.int64()), "mean": pa.array([mean], pa.binary())})


def _between(sample: DataFrame, sizes: list[int], model: LanguageModel) -> np.ndarray:
    """A column for each family, against all others.

    Each shard of the sample trains all columns; a family's column is their mean
    by its rows in the shard, so shards without it do not count. Rows of rare
    languages go to several shards.
    """
    config, family, n = model.config, model.family, int(model.family.max()) + 1
    of = {lang: int(f) for lang, f in zip(model.languages, family, strict=True)}
    shards = -(-sum(sizes) // config.shard_rows)
    copies = [min(shards, -(-config.shard_least * shards // size)) for size in sizes]
    dealt = sample.sparkSession.createDataFrame(list(zip(model.languages, copies, strict=True)), "label string, _copies int")
    shard = F.explode(F.transform(
        F.sequence(F.lit(0), F.col("_copies") - 1), lambda i: F.pmod(F.pmod(F.xxhash64("doc_id"), F.lit(shards)) + i, F.lit(shards))
    ))
    rows = sample.join(F.broadcast(dealt), "label").select("doc_id", "label", "x", shard.alias("shard"))

    def train(key: tuple, table: pa.Table) -> pa.Table:
        label, x = _unpacked(table.select(["doc_id", "label", "x"]))
        own = np.array([of[lang] for lang in label])[:, None] == np.arange(n)
        w = _linear_svm(x, np.where(own, 1, -1).astype(np.float32), config)
        count = own.sum(axis=0)
        some = np.flatnonzero((count > 0) & (count < len(x)))
        columns = pa.array([np.ascontiguousarray(w[:, f]).tobytes() for f in some], pa.binary())
        at = pa.array([key[0].as_py()] * len(some), pa.int64())
        return pa.table({"shard": at, "family": pa.array(some, pa.int64()), "n": pa.array(count[some], pa.int64()), "w": columns})

    found = rows.groupBy("shard").applyInArrow(train, "shard long, family long, n long, w binary")
    total, weight = np.zeros((config.dim + 1, n)), np.zeros(n)
    for r in written(found, "language-shards").orderBy("shard", "family").toLocalIterator():
        total[:, r["family"]] += r["n"] * np.frombuffer(r["w"], dtype=np.float32).astype(np.float64)
        weight[r["family"]] += r["n"]
    return (total / np.maximum(weight, 1)).astype(np.float32)


def _within(sample: DataFrame, model: LanguageModel) -> np.ndarray:
    """A column for each of ``model.pairs``; a task trains the pairs of two blocks of one family's languages."""
    config = model.config
    index = {lang: k for k, lang in enumerate(model.languages)}
    blocks = []
    for f in range(int(model.family.max()) + 1):
        members = np.flatnonzero(model.family == f)
        if len(members) > 1:
            blocks += [(model.languages[k], f, at // config.block, (len(members) - 1) // config.block) for at, k in enumerate(members)]
    dealt = sample.sparkSession.createDataFrame(blocks, "label string, _family int, _block int, _last int")
    both = F.explode(F.transform(
        F.sequence(F.lit(0), F.col("_last")),
        lambda j: F.struct(F.col("_family").alias("f"), F.least("_block", j).alias("i"), F.greatest("_block", j).alias("j")),
    ))
    rows = sample.join(F.broadcast(dealt), "label").select("doc_id", "label", "x", "_block", both.alias("t")).select("*", "t.*").drop("t")

    def train(key: tuple, table: pa.Table) -> pa.Table:
        block = {index[lang]: b for lang, b in zip(table["label"].to_pylist(), table["_block"].to_pylist(), strict=True)}
        label, x = _unpacked(table.select(["doc_id", "label", "x"]))
        y = np.array([index[lang] for lang in label])
        _, i, j = (k.as_py() for k in key)
        first, second = (sorted(k for k, b in block.items() if b == of) for of in (i, j))
        pairs = list(combinations(first, 2) if i == j else product(first, second))
        columns = []
        for a, b in pairs:
            rows = (y == a) | (y == b)
            columns.append(_linear_svm(x[rows], np.where(y[rows] == a, 1, -1).astype(np.float32), config).tobytes())
        ends = [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]
        return pa.table({"a": ends[0], "b": ends[1], "w": pa.array(columns, pa.binary())})

    found = written(rows.groupBy("f", "i", "j").applyInArrow(train, "a long, b long, w binary"), "language-pairs")
    out, at = np.zeros((config.dim + 1, len(model.pairs)), dtype=np.float32), {p: k for k, p in enumerate(model.pairs)}
    for r in found.toLocalIterator():
        out[:, at[r["a"], r["b"]]] = np.frombuffer(r["w"], dtype=np.float32)
    return out


def fit(documents: DataFrame, config: LanguageConfig = LanguageConfig()) -> LanguageModel:
    """Model from up to ``per_language`` documents of each of ``documents.lang``, however many there are.

    Rows with null lang, null text, no letter or of the held-out fold do not
    train; a doc_id that repeats trains once. A mean vector for each language
    and a column for each family and pair come to the driver, no features.
    """
    model = LanguageModel(config)
    sample = _sample(documents, config)
    means = sorted(sample.groupBy("label").applyInArrow(_mean, "label string, n long, mean binary").collect(), key=lambda r: r["label"])
    if not means:
        return model
    model.languages = [r["label"] for r in means]
    model.family = families(np.stack([np.frombuffer(r["mean"], dtype=np.float32) for r in means]))
    pairs = ((a, b) for f in range(model.family.max() + 1) for a, b in combinations(np.flatnonzero(model.family == f).tolist(), 2))
    model.pairs = list(pairs)
    blank = np.zeros((config.dim + 1, 0), dtype=np.float32)
    model.between = _between(sample, [r["n"] for r in means], model) if model.family.max() > 0 else blank
    model.within = _within(sample, model) if model.pairs else blank
    return model


def predictions(x: np.ndarray, some: np.ndarray, model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1) of each row; undetermined at 0 without letters or without a model."""
    n = len(x)
    if not model.languages:
        return [UNDETERMINED] * n, np.zeros(n)
    squash = lambda m: 1 / (1 + np.exp(-4 * np.clip(m, -7, 7)))
    x = np.hstack([x, np.ones((n, 1), dtype=np.float32)])
    family, score = np.zeros(n, dtype=np.int64), np.ones(n)
    if model.between.shape[1]:
        margins = x @ model.between
        family, score = margins.argmax(axis=1), squash(margins.max(axis=1))
    best = np.zeros(n, dtype=np.int64)
    of = model.family[[a for a, _ in model.pairs]] if model.pairs else np.zeros(0, dtype=np.int64)
    for f in np.unique(family):
        rows, langs = np.flatnonzero(family == f), np.flatnonzero(model.family == f)
        lo, hi = np.searchsorted(of, (f, f + 1))
        place = {k: at for at, k in enumerate(langs.tolist())}
        shape = (len(rows), len(langs))
        votes, margin, least = np.zeros(shape), np.zeros(shape), np.ones(shape)
        inner = x[rows] @ model.within[:, lo:hi]
        for k, (a, b) in enumerate(model.pairs[lo:hi]):
            p = squash(inner[:, k])
            for lang, q, m in ((place[a], p, inner[:, k]), (place[b], 1 - p, -inner[:, k])):
                votes[:, lang] += m > 0
                margin[:, lang] += m
                least[:, lang] = np.minimum(least[:, lang], q)
        won = (votes + 0.5 / (1 + np.exp(-np.clip(margin, -30, 30)))).argmax(axis=1)
        best[rows] = langs[won]
        score[rows] *= least[np.arange(len(rows)), won]
    names = [model.languages[k] if ok else UNDETERMINED for k, ok in zip(best, some, strict=True)]
    return names, np.where(some, score, 0.0)


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` per row; only texts decide. Repeated rows stay, extra columns go."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x, some = features((t.as_py() for t in part.column(1)), part.num_rows, model.config.dim)
                names, score = predictions(x, some, model)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def judge(documents: DataFrame, config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row; rows without doc_id never train and are not held out."""
    held = F.coalesce(crc_mod(F.col("doc_id"), config.fold) == config.held, F.lit(False)).alias("held_out")
    return identify(documents, fit(documents, config)).select("doc_id", held, "lang_pred", "score")
