"""SimHash near-duplicates through a segment-popcount embedding.

A document's fingerprint is the bitwise majority of the XXH64 values of its word
shingles. The 64 bits are cut into 32 segments of two, and a fingerprint is
mapped to the vector of its segments' bit counts. A bit that differs moves one
count by one at most, so the Manhattan distance of two vectors is a lower bound
of the Hamming distance of the fingerprints: pairs farther apart than ``radius``
in the embedding cannot link.

The range join runs on a grid. The 32 coordinates form ``GROUPS`` groups; within
Manhattan distance 4 at most four groups differ, so at least five agree. A cell
is the lattice point of five groups, and every pair within the radius shares a
cell, while two unrelated fingerprints do so once in some 300,000 times. Counts are kept in unary inside one long (two bits a segment), so a cell
key is a mask and a Manhattan distance is the bit count of a XOR.

Pairs of a cell are never listed, and cells are made and moved once: sorted by
cell, they stream past one scan. It compares every fingerprint of a cell with the
cell's smallest, which links a group of near copies as a star, then those of cells
that stay apart among each other, and hands on a spanning forest of the links.
Only cells of more than a block of fingerprints hand on their members: those whose
members are not one component by then are dealt out over pairs of blocks, so no
task holds more than two of them, and compared in arrays in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.llm.components import components
from corpusweave.session import shuffle_width, written

SEED = 42
RADIUS = 4  # the grid below is complete for this distance and any smaller one
GROUPS = 9
_CHUNK = 1 << 16
_EVEN = 0x5555555555555555


@dataclass(frozen=True)
class SimHashConfig:
    shingle: int = 4
    max_distance: int = RADIUS
    block: int = 2048  # fingerprints of a cell that meet at a time

    def __post_init__(self) -> None:
        if not 0 <= self.max_distance <= RADIUS:
            raise ValueError(f"max_distance must be from 0 to {RADIUS}")
        if self.shingle < 1:
            raise ValueError("shingle must be positive")


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority bits of the shingles' hashes; a bit needs more than half. No words: zero."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    of, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):  # a long text needs no more memory for its bits
        spans = zip(starts[at : min(n, at + _CHUNK)].tolist(), last[at : at + _CHUNK].tolist(), strict=True)
        h = np.array([of(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(documents: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """``(doc_id, fp)`` per row, ``fp`` as a signed long. Null texts have no words."""
    shingle = config.shingle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def embedded(fp: Column) -> Column:
    """Bit counts of two-bit segments in unary: 00, 01 or 11 each."""
    even = F.lit(_EVEN).cast("long")
    high = F.shiftrightunsigned(fp, 1)
    both, either = fp.bitwiseAND(high).bitwiseAND(even), fp.bitwiseOR(high).bitwiseAND(even)
    return F.shiftleft(both, 1).bitwiseOR(either)


def _masks() -> list[int]:
    """Bits of the lattice coordinates of each kind of cell, as signed longs."""
    groups = [sum(0b11 << 2 * s for s in range(g, 32, GROUPS)) for g in range(GROUPS)]
    found = [sum(chosen) for chosen in combinations(groups, GROUPS - RADIUS)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _cells(points: DataFrame) -> DataFrame:
    """One row per cell of each fingerprint: ``kind, cell, fp`` and further columns."""
    masks = F.array(*(F.lit(m) for m in _masks()))
    others = [c for c in points.columns if c not in ("fp",)]
    rows = points.select("fp", *others, embedded(F.col("fp")).alias("_e"), F.posexplode(masks).alias("kind", "_m"))
    return rows.select(F.col("kind").cast("byte").alias("kind"), F.col("_e").bitwiseAND(F.col("_m")).alias("cell"), "fp", *others)


def _labelled(points: DataFrame, edges: DataFrame) -> DataFrame:
    """``points(fp)`` with the component their links give; alone, their own."""
    found = components(edges).withColumnRenamed("id", "fp").withColumnRenamed("component", "_c")
    return points.join(found, "fp", "left").select("fp", F.coalesce("_c", "fp").alias("comp"))


def link_components(points: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """``(fp, comp)`` for distinct ``points(fp)``: equal ``comp`` where links of up
    to ``max_distance`` bits connect, directly or through others. Exact."""
    cell = ["kind", "cell"]
    # A few narrow files make many cells: spread them before they do.
    points = points.repartition(shuffle_width(points.sparkSession), "fp")
    scanned = written(_scanned(_cells(points), config), "simhash-cells")
    links = scanned.where(F.col("kind") == LINK).select("a", "b").distinct()
    first = written(_labelled(points, links), "simhash-stars")
    large = scanned.where(F.col("kind") != LINK).select(*cell, F.col("a").alias("fp"))
    if large.isEmpty():
        return first

    members = large.join(first, "fp")
    mixed = members.groupBy(*cell).agg(F.count("*").alias("_n"), F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a <> _b")
    dealt = _dealt(members.join(mixed.select(*cell, "_n"), cell), config.block)
    joined = components(_compared(dealt, config).distinct())
    found = first.join(joined.select(F.col("id").alias("comp"), "component"), "comp", "left")
    return found.select("fp", F.coalesce("component", "comp").alias("comp"))


LINK = -1  # in place of a kind of cell


def cell_links(unit: np.ndarray, fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that span what lies near within whole cells, whose rows stand together."""
    heads = np.flatnonzero(np.diff(unit, prepend=-1))
    pivot = np.repeat(heads, np.diff(heads, append=len(unit)))
    star = np.bitwise_count(fp ^ fp[pivot]) <= radius
    signed = fp.view(np.int64)
    comp = np.where(star, signed[pivot], signed)
    near = star & (comp != signed)
    pairs = np.unique(np.stack([signed[near], comp[near]]), axis=1)
    # Cells that the star did not join.
    apart = (~np.logical_and.reduceat(star, heads) if len(heads) else np.zeros(0, bool)).repeat(np.diff(heads, append=len(unit)))
    one = np.ones(int(apart.sum()), bool)
    more = unit_links(unit[apart], ~one, one, fp[apart], comp[apart], radius)
    joined = np.concatenate([pairs, np.array(more, np.int64).reshape(-1, 2).T], axis=1)
    return spanning(*joined)


def _scanned(cells: DataFrame, config: SimHashConfig) -> DataFrame:
    """``(kind, cell, a, b)``: links ``a, b`` under the kind ``LINK``, and the members ``a``
    of cells of more than a block, of which only those of the smallest are among the links."""
    radius, block = config.max_distance, config.block

    def rows(kind: np.ndarray, cell: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(kind, pa.int8()), pa.array(cell, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["kind", "cell", "a", "b"])

    def links(pairs: np.ndarray) -> pa.RecordBatch:
        return rows(np.full(len(pairs), LINK), np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])

    def members(kind: np.ndarray, cell: np.ndarray, fp: np.ndarray, pivot: int) -> Iterator[pa.RecordBatch]:
        yield rows(kind, cell, fp, fp)
        near = fp[(np.bitwise_count((fp ^ pivot).view(np.uint64)) <= radius) & (fp != pivot)]
        yield links(np.stack([near, np.full(len(near), pivot)], axis=1))

    def whole(kind: np.ndarray, cell: np.ndarray, fp: np.ndarray, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links and members of the cells of these rows, ``new`` where one begins."""
        heads = np.flatnonzero(new)
        sizes = np.diff(heads, append=len(fp))
        for head, size in zip(heads[sizes > block].tolist(), sizes[sizes > block].tolist(), strict=True):
            at = slice(head, head + size)
            yield from members(kind[at], cell[at], fp[at], fp[head])
        met = np.repeat((sizes > 1) & (sizes <= block), sizes)
        pairs = cell_links(np.cumsum(new)[met], fp[met].view(np.uint64), radius)
        if pairs:
            yield links(np.array(pairs, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        large: tuple[int, int, int] | None = None  # a cell that is handed on as it comes, and its smallest
        for batch in batches:
            kind, cell, fp = (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True))
            if large is not None:
                n = int(((kind == large[0]) & (cell == large[1])).sum())  # sorted: the first rows
                yield from members(kind[:n], cell[:n], fp[:n], large[2])
                kind, cell, fp = kind[n:], cell[n:], fp[n:]
            held = [kind, cell, fp]
            if not len(fp):
                continue
            large = None
            new = (np.diff(kind, prepend=kind[:1]) != 0) | (np.diff(cell, prepend=cell[:1]) != 0)
            new[0] = True
            last = int(np.flatnonzero(new)[-1])  # its cell may go on in the next batch
            yield from whole(kind[:last], cell[:last], fp[:last], new[:last])
            held = [kind[last:], cell[last:], fp[last:]]
            if len(held[0]) > block:
                large = (int(kind[last]), int(cell[last]), int(fp[last]))
                yield from members(*held, large[2])
                held = [h[:0] for h in held]
        kind, cell, fp = held
        if len(fp):
            yield from whole(kind, cell, fp, np.arange(len(fp)) == 0)

    by = cells.select("kind", "cell", "fp").repartition(shuffle_width(cells.sparkSession), "kind", "cell")
    return by.sortWithinPartitions("kind", "cell", "fp").mapInArrow(run, "kind byte, cell long, a long, b long")


UNIT = ["kind", "cell", "i", "j"]


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """Members of cells of ``_n`` fingerprints, for each pair ``i <= j`` of blocks they take part in."""
    blocks = F.ceil(F.col("_n") / block).cast("int")
    placed = members.withColumn("_k", blocks).withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("_k")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda o: F.struct(F.least("sub", o).alias("i"), F.greatest("sub", o).alias("j")))
    return placed.select("kind", "cell", "sub", "fp", "comp", F.explode(pairs).alias("_p")).select("kind", "cell", "_p.i", "_p.j", "sub", "fp", "comp")


def spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of links between components, those that join what was apart."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept


def unary(fp: np.ndarray) -> np.ndarray:
    """``embedded`` for an array of fingerprints."""
    even, high = np.uint64(_EVEN), fp >> np.uint64(1)
    return (fp & high & even) << np.uint64(1) | (fp | high) & even


def unit_links(unit: np.ndarray, right: np.ndarray, inner: np.ndarray, fp: np.ndarray, comp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between components within units of work, whose rows stand together. A row
    is compared with those up to the end of its unit; ``inner`` units have one block,
    in others only rows of the left and the ``right`` block meet."""
    e, n, found = unary(fp), len(fp), []
    ends = np.flatnonzero(np.diff(unit, append=-1))
    last = np.repeat(ends, np.diff(ends, prepend=-1))
    rows, step = np.arange(n), 1
    while len(rows := rows[rows + step <= last[rows]]):
        other = rows + step
        near = (np.bitwise_count(e[rows] ^ e[other]) <= radius) & (comp[rows] != comp[other]) & (inner[rows] | (right[rows] != right[other]))
        a, b = rows[near], other[near]
        exact = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        found.append(np.stack([comp[a[exact]], comp[b[exact]]]))
        step += 1
    if not found:
        return []
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return spanning(*pairs)


def _compared(dealt: DataFrame, config: SimHashConfig) -> DataFrame:
    """``(a, b)``: links between components, from the units that ``dealt`` holds."""
    radius = config.max_distance

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(table: pa.Table) -> pa.RecordBatch:
            columns = [table.column(c).to_numpy().astype(np.int64) for c in (*UNIT, "sub", "fp", "comp")]
            kind, cell, i, j, sub, fp, comp = columns
            new = np.logical_or.reduce([np.diff(c, prepend=c[:1]) != 0 for c in (kind, cell, i, j)]) if len(fp) else np.zeros(0, bool)
            pairs = unit_links(np.cumsum(new), sub == j, i == j, fp.view(np.uint64), comp, radius)
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            # The last unit may go on in the next batch.
            same = np.logical_and.reduce([held.column(c).to_numpy() == held.column(c)[-1].as_py() for c in UNIT]) if held.num_rows else np.zeros(0, bool)
            whole = int(held.num_rows - same.sum())
            if whole:
                yield links(held.slice(0, whole))
                held = held.slice(whole).combine_chunks()
        if held is not None and held.num_rows:
            yield links(held)

    spread = dealt.repartition(shuffle_width(dealt.sparkSession), *UNIT).sortWithinPartitions(*UNIT, "sub")
    return spread.mapInArrow(run, "a long, b long")


def near_duplicates(documents: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``documents(doc_id, text)``.

    ``component_id`` is the smallest doc_id that links reach, itself included.
    Texts without words, null ones too, share fingerprint zero and link like any
    other. Repeated rows stay; a null doc_id names no component but takes part.
    """
    prints = written(fingerprints(documents, config), "simhash-prints")
    points = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-points")
    comps = written(link_components(points.select("fp"), config), "simhash-comps")
    smallest = points.join(comps, "fp").groupBy("comp").agg(F.min("first").alias("component_id"))
    named = comps.join(smallest, "comp").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(documents: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """``documents`` without those whose component has a smaller doc_id.

    All columns stay. Rows that repeat a doc_id stand or fall together; rows
    without doc_id stay, as nothing can name them.
    """
    gone = near_duplicates(documents, config).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, documents["doc_id"] == gone["_gone"], "left_anti")
