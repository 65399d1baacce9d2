"""Phrases whose words keep together, counted in quotient filters.

Words that occur often enough get numbers, so a phrase of up to ``max_words``
words is one packed integer. A Feistel network permutes these integers: it can be
undone, so nothing is lost, and it spreads phrases evenly. The permuted integer
is cut into quotient and remainder; a counting quotient filter keeps, sorted,
how many entries each quotient has (two bits an entry), the whole remainders and
a counter each (one byte unless it is large). It is exact: quotient and remainder
give the phrase back.

Texts are coded once, by shards of bounded size with a dictionary of their own.
Only dictionaries meet: summed counts say which words are frequent, their
numbers go back to the shards, and each shard counts its phrases in a filter.
Filters move as blocks of the permuted range and are merged there, sorted run by
sorted run. Blocks are even, as the permutation is; a phrase that fills a third
of the corpus has one entry a shard. Nothing is pruned but phrases with a word
too rare for the whole to be a candidate.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusweave.operators.scans import ordinals
from corpusweave.session import written

# The characters that end a piece of a text.
BORDERS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(BORDERS + bytes(range(0x41, 0x5B)), b"." * len(BORDERS) + bytes(range(0x61, 0x7B)))
_CUT = re.compile(rb"[ \t.,;:!?\n-\r]")
_PART = 1 << 20  # bytes of a text that are split into words at a time


@dataclass(frozen=True)
class CollocationConfig:
    max_words: int = 3
    min_count: int = 10
    scale: int = 1_000_000
    share: int = 50  # percent of a phrase's occurrences that lie in one longer phrase, from which it goes
    top: int = 2000
    shard_words: int = 1 << 19
    block_entries: int = 1 << 21

    def __post_init__(self) -> None:
        if self.max_words < 2 or self.min_count < 1:
            raise ValueError("phrases have two words or more and occur")


# -- counting quotient filter ------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Bits of a phrase: ``words`` numbers of ``bits`` each in two lanes of ``half``
    bits; the first ``block`` bits after the permutation name the block."""

    words: int
    bits: int
    block: int = 0

    def __post_init__(self) -> None:
        if self.half > 63:
            raise ValueError("too many words for two lanes of 63 bits")

    @property
    def half(self) -> int:
        return max(-(-self.words * self.bits // 2), self.block)

    def pack(self, numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Lanes of phrases given word by word; missing words at the end are zero."""
        u = np.uint64
        high, low = np.zeros(len(numbers[0]), u), np.zeros(len(numbers[0]), u)
        for i, w in enumerate(numbers):
            w, at = w.astype(u), (self.words - 1 - i) * self.bits
            if at >= self.half:
                high |= w << u(at - self.half)
            else:
                low |= w << u(at)
                high |= w >> u(self.half - at)
        return high, low & u((1 << self.half) - 1)

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        u, found = np.uint64, []
        for i in range(self.words):
            at = (self.words - 1 - i) * self.bits
            w = high >> u(at - self.half) if at >= self.half else low >> u(at) | high << u(self.half - at)
            found.append((w & u((1 << self.bits) - 1)).astype(np.int64))
        return found

    def _round(self, x: np.ndarray, k: int) -> np.ndarray:
        u = np.uint64
        x = (x + u(k + 1)) * u(0x9E3779B97F4A7C15)
        x = (x ^ x >> u(29)) * u(0xBF58476D1CE4E5B9)
        return (x ^ x >> u(32)) & u((1 << self.half) - 1)

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in range(4):
            high, low = low, high ^ self._round(low, k)
        return high, low

    def restore(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in reversed(range(4)):
            high, low = low ^ self._round(high, k), high
        return high, low


def _summed(layout: Layout, high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, kind: str | None = None):
    """Sorted distinct lanes and their counts. ``kind`` names the sort: a stable one merges sorted runs."""
    if not len(high):
        return high, low, np.zeros(0, np.int64)
    if 2 * layout.half <= 64:
        joined = high << np.uint64(layout.half) | low
        if counts is None:
            joined.sort()
            order = slice(None)
        else:
            order = np.argsort(joined, kind=kind)
            joined = joined[order]
        starts = np.flatnonzero(np.concatenate(([True], joined[1:] != joined[:-1])))
        high, low = joined[starts] >> np.uint64(layout.half), joined[starts] & np.uint64((1 << layout.half) - 1)
    else:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        starts = np.flatnonzero(np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]))))
        high, low, joined = high[starts], low[starts], order
    if counts is None:
        return high, low, np.diff(np.append(starts, len(joined)))
    return high, low, np.add.reduceat(counts[order], starts)


def _bytes_of(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_bytes(data: bytes, at: int, n: int, width: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return wide.view("<u8").ravel().astype(np.uint64)


@dataclass(frozen=True)
class QuotientFilter:
    """Sorted distinct entries of a block with their counts."""

    layout: Layout
    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, layout: Layout, high: np.ndarray, low: np.ndarray) -> QuotientFilter:
        """Occurrences of permuted phrases, counted."""
        return cls(layout, *_summed(layout, high, low, None))

    def blocks(self) -> Iterator[tuple[int, QuotientFilter]]:
        """The filter of each block that has entries."""
        names = (self.high >> np.uint64(self.layout.half - self.layout.block)).astype(np.int64)
        borders = [*np.flatnonzero(np.diff(names, prepend=-1)).tolist(), len(names)]
        for a, b in zip(borders, borders[1:], strict=False):
            yield int(names[a]), QuotientFilter(self.layout, self.high[a:b], self.low[a:b], self.counts[a:b])

    def pack(self) -> bytes:
        """One block's entries: runs a quotient in unary, remainders, counters."""
        u, n, rest = np.uint64, len(self.high), self.layout.half - self.layout.block
        q = min(rest, max(0, n.bit_length() - 1))
        inner = self.high & u((1 << rest) - 1)
        runs = np.zeros(n + (1 << q), np.uint8)
        runs[(inner >> u(rest - q)).astype(np.int64) + np.arange(n)] = 1  # an entry is a one, the end of a quotient a zero
        small = np.minimum(self.counts, 255).astype(np.uint8)
        return b"".join((
            np.array([n, q, int(self.high[0] >> u(rest)) if n else 0], "<i8").tobytes(), np.packbits(runs).tobytes(),
            _bytes_of(inner & u((1 << (rest - q)) - 1), -(-(rest - q) // 8)), _bytes_of(self.low, -(-self.layout.half // 8)),
            small.tobytes(), self.counts[small == 255].astype("<i8").tobytes(),
        ))

    @classmethod
    def unpack(cls, layout: Layout, data: bytes) -> QuotientFilter:
        u, rest = np.uint64, layout.half - layout.block
        n, q, block = np.frombuffer(data, "<i8", 3).tolist()
        at, bits = 24, n + (1 << q)
        runs = np.unpackbits(np.frombuffer(data, np.uint8, -(-bits // 8), at), count=bits)
        quotient = (np.flatnonzero(runs) - np.arange(n)).astype(u)
        at += -(-bits // 8)
        width, wide = -(-(rest - q) // 8), -(-layout.half // 8)
        high = u(block) << u(rest) | quotient << u(rest - q) | _from_bytes(data, at, n, width)
        low = _from_bytes(data, at + n * width, n, wide)
        at += n * (width + wide)
        counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
        large = counts == 255
        counts[large] = np.frombuffer(data, "<i8", int(large.sum()), at + n)
        return cls(layout, high, low, counts)

    @classmethod
    def merged(cls, layout: Layout, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter of several sorted ones; equal entries add up."""
        parts = [np.concatenate([getattr(f, c) for f in filters]) for c in ("high", "low", "counts")]
        return cls(layout, *_summed(layout, *parts, kind="stable"))


# -- shards ------------------------------------------------------------------


class _Numbers(dict):
    """Numbers words as they come, from one on; zero is the border of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _parts(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > _PART:
        found = _CUT.search(text, at + _PART)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


SHARD = "shard string, lang string, words array<string>, counts array<long>, codes binary"


def shards(documents: DataFrame, config: CollocationConfig = CollocationConfig()) -> DataFrame:
    """Texts as numbers of their words, a row for each shard and language: the shard's
    distinct ``words`` (the first is the border), their ``counts``, and ``codes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, _Numbers] = {}
        codes: dict[str, list[np.ndarray]] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            rows = []
            for lang, parts in codes.items():
                flat = np.concatenate(parts)
                counts = np.bincount(flat, minlength=len(numbers[lang]))
                planes = flat.astype("<u4").view(np.uint8).reshape(-1, 4).T  # high bytes, mostly zero, together
                rows.append((uuid.uuid4().hex, lang, list(numbers[lang]), counts, np.ascontiguousarray(planes).tobytes()))
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["shard", "lang", "words", "counts", "codes"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                known = numbers.setdefault(lang, _Numbers({b".": 0}))
                mine = codes.setdefault(lang, [])
                for part in _parts(text.as_py() or b""):
                    words = part.translate(_FOLD).replace(b".", b" . ").split()
                    mine.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)).astype(np.int32))
                    held += len(words)
                mine.append(np.zeros(1, np.int32))
                held += 1
                if held >= config.shard_words:
                    yield flush()
                    numbers, codes, held = {}, {}, 0
        if codes:
            yield flush()

    lang = F.coalesce(F.col("lang"), F.lit("und"))
    return documents.select(lang.alias("lang"), F.col("text").cast("binary")).mapInArrow(run, SHARD)


def _counter(layout: Layout):
    def run(coded: pa.Table, frequent: pa.Table) -> pa.Table:
        """Filters of one shard's phrases, block by block."""
        found: list[tuple[int, bytes]] = []
        if coded.num_rows and frequent.num_rows:
            planes = np.frombuffer(coded.column("codes")[0].as_py(), np.uint8).reshape(4, -1)
            codes = np.ascontiguousarray(planes.T).view("<u4").ravel()
            at = frequent.column("at").to_numpy()
            name = np.zeros(max(int(codes.max()), int(at.max())) + 1, np.uint64)
            name[at] = frequent.column("id").to_numpy().astype(np.uint64)
            numbers = name[codes]
            lanes = []
            for n in range(2, layout.words + 1):
                parts = [numbers[k : len(numbers) - n + 1 + k] for k in range(n)]
                whole = np.logical_and.reduce([p > 0 for p in parts])
                lanes.append(layout.permute(*layout.pack([p[whole] for p in parts])))
            counted = QuotientFilter.of(layout, *(np.concatenate(x) for x in zip(*lanes, strict=True)))
            found = [(b, f.pack()) for b, f in counted.blocks()]
        return pa.table({"block": pa.array([b for b, _ in found], pa.int64()), "filter": pa.array([f for _, f in found], pa.binary())})

    return run


def _merger(layout: Layout, min_count: int):
    def run(table: pa.Table) -> pa.Table:
        """Phrases of a block that occur ``min_count`` times, as numbers of their words."""
        whole = QuotientFilter.merged(layout, [QuotientFilter.unpack(layout, f.as_py()) for f in table.column("filter")])
        often = whole.counts >= min_count
        words = np.stack(layout.unpack(*layout.restore(whole.high[often], whole.low[often])), axis=1)
        sizes = (words > 0).sum(axis=1)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(words[words > 0], pa.int64()))
        return pa.table({"ids": lists, "a": pa.array(whole.counts[often], pa.int64())})

    return run


# -- phrases -----------------------------------------------------------------


def phrase_counts(documents: DataFrame, config: CollocationConfig = CollocationConfig()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(totals, words, phrases)`` of ``documents(text, lang)``.

    ``totals(lang, n)`` counts all words of a language, ``words(id, lang, word, f)``
    are those that occur ``min_count`` times, ``phrases(ids, a)`` all phrases that do.
    """
    coded = written(shards(documents, config), "phrase-shards")
    listed = coded.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "_w")).where("at > 0")
    every = written(listed.groupBy("lang", F.col("_w.words").alias("word")).agg(F.sum("_w.counts").alias("f")), "phrase-words")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    numbered = ordinals(every.where(F.col("f") >= config.min_count), [], ["lang", "word"], "_k")
    words = written(numbered.select((F.col("_k") + 1).alias("id"), "lang", "word", "f"), "phrase-dictionary")

    most = words.agg(F.count("*"), F.sum("f")).first()
    entries = (most[1] or 0) * (config.max_words - 1)
    layout = Layout(config.max_words, max(1, most[0].bit_length()), max(0, (entries // config.block_entries).bit_length()))
    named = listed.select("shard", "at", "lang", F.col("_w.words").alias("word")).join(words.select("lang", "word", "id"), ["lang", "word"])
    count, merge = _counter(layout), _merger(layout, config.min_count)
    named = named.select(F.col("shard").alias("of"), "at", "id").groupBy("of")
    filters = coded.select("shard", "codes").groupBy("shard").cogroup(named).applyInArrow(lambda a, b: count(a, b), "block long, filter binary")
    phrases = filters.groupBy("block").applyInArrow(lambda t: merge(t), "ids array<long>, a long")
    return totals, words, written(phrases, "phrases")


def _scored(words: DataFrame, phrases: DataFrame, config: CollocationConfig) -> DataFrame:
    """``ids, a, lang, score, l, r`` by the cut that holds least."""
    parts = words.select(F.array("id").alias("_part"), F.col("f"), "lang").unionByName(
        phrases.select(F.col("ids").alias("_part"), F.col("a").alias("f"), F.lit(None).cast("string").alias("lang"))
    )
    cuts = phrases.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
        "ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("_l"), F.slice("ids", F.col("k") + 1, F.size("ids")).alias("_r")
    )
    left = parts.select(F.col("_part").alias("_l"), F.col("f").alias("l"), "lang")
    right = parts.select(F.col("_part").alias("_r"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(16,0)")  # noqa: E731  products of two fit 38 digits with the scale
    up, down = wide("a") * wide("a") * F.lit(config.scale).cast("decimal(7,0)"), wide("l") * wide("r")
    found = cuts.join(left, "_l").join(right, "_r").withColumn("_up", up).withColumn("_down", down)
    cut = F.struct(F.expr("_up div _down").alias("score"), "k", "l", "r")
    least = found.groupBy("ids", "a").agg(F.min(cut).alias("_c"), F.max("lang").alias("lang"))
    return least.select("ids", "a", "lang", "_c.score", "_c.l", "_c.r")


def _within(phrases: DataFrame, config: CollocationConfig) -> DataFrame:
    """``ids, most``: how often the most frequent longer phrase around a phrase occurs."""
    n = F.size("ids")
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), n - 1),
        lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: F.slice("ids", at, size)),
    ))
    longer = phrases.where(n > 2).select(F.explode(spans).alias("ids"), "a")
    return longer.groupBy("ids").agg(F.max("a").alias("most"))


def collocations(documents: DataFrame, config: CollocationConfig = CollocationConfig()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of ``documents(text, lang)``.

    Texts are lower-cased (A-Z) and cut into pieces at ``BORDERS``, pieces into words
    at blanks and tabs. Everything is per ``lang``; a null one is ``und``, and meets
    texts marked so. Phrases of 2 to ``max_words`` words that occur ``min_count``
    times within pieces are scored by their worst cut, ``scale * a * a / (l * r)``
    rounded down; equal cuts count as the first. Those that a longer candidate holds
    in ``share`` percent of their occurrences go. The ``top`` of each language are
    returned, by score, then ``a``, both descending, then phrase by its bytes. Null
    and empty texts have no words; repeated rows count again; ids are not needed.
    """
    totals, words, phrases = phrase_counts(documents, config)
    scored = _scored(words, phrases, config).join(_within(phrases, config), "ids", "left")
    kept = scored.where(F.col("most").isNull() | (100 * F.col("most") < config.share * F.col("a")))
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = kept.withColumn("_k", F.rank().over(best)).where(F.col("_k") <= config.top)
    near = written(near.select("ids", "a", "lang", "score", "l", "r"), "phrases-near")
    spelt = near.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelt = spelt.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("_w"))
    named = near.join(spelt, "ids").withColumn("phrase", F.array_join("_w.word", " "))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= config.top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
