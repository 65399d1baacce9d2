"""Prefix trie of conversations from sorted neighbours.

A conversation is a sequence of turns, each known by a digest. Equal sequences
are taken together first, with their number. Distinct ones are sorted, range by
range; what two neighbours share, their longest common prefix (LCP), is an edge
of that depth between them. Taking the edges of a range in descending depth,
union-find joins neighbouring stretches of the sorted order: a join at depth
``d`` is the node ``d`` turns deep under which both lie, and it is a branching
node. Nodes between a branching node and the one above have the same members and
are written out along the way.

All that is told of a node is a sum, or a minimum, over its stretch. ``n_leaves``
counts sequences that the next one does not continue, ``n_children`` those that
leave the one before at that depth. And the sum of ``(n_convs - 1) * words`` over
a subtree is the words below the node in every member less the words of every
distinct node, and each distinct node is introduced by one sequence: the first
that has it.

So ranges need little of each other. A node whose stretch touches the border of
its range, at most as deep as the neighbours across the border agree, is open:
the range hands on its sums, and open nodes of one prefix are added up over the
ranges. All others are complete where they were found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusweave.session import shuffle_width, written

DIGEST = 16  # bytes of a turn's digest
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- sequences ---------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, steps`` of ``conversations(conv_id, turn, role, text)``: an array of
    ``(digest, words)`` in the order of turns, null turns first.

    Null roles and texts count as empty. Turns of one number are ordered by their
    digest; repeated rows are repeated turns. Rows without conv_id belong to no
    conversation and are left out; extra columns are ignored. Digests are taken
    before turns meet, so a conversation costs some 24 bytes a turn in one row.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    step = F.struct(
        "turn", F.substring(F.sha2(whole, 256), 1, 2 * DIGEST).alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("words"),
    )
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), step.alias("_s"))
    ordered = F.sort_array(F.collect_list("_s"))
    return rows.groupBy("conv_id").agg(ordered.alias("_a")).select(
        "conv_id", F.transform("_a", lambda s: F.struct(s["digest"].alias("digest"), s["words"].alias("words"))).alias("steps")
    )


def with_stems(steps: DataFrame, every: int = 20, longest: int = 3) -> DataFrame:
    """``steps(conv_id, steps)`` with the first ``h`` turns taken from the stem.

    The stem of ``c`` is conversation ``c - c % every``; ``h`` is the crc32 of ``c``
    in decimal, modulo ``longest + 1``. A stem with fewer turns gives all of them, a
    missing one none; ``c``'s own turns after its first ``h`` follow.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("int")
    stems = steps.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_stem"), F.slice("steps", 1, longest).alias("_head")
    )
    rows = steps.withColumn("_stem", F.col("conv_id") - F.col("conv_id") % every).withColumn("_h", h).join(stems, "_stem", "left")
    own = F.slice("steps", F.col("_h") + 1, F.size("steps"))
    head = F.when(F.col("_head").isNull(), F.slice("steps", 1, 0)).otherwise(F.slice("_head", F.lit(1), F.col("_h")))
    return rows.select("conv_id", F.concat(head, own).alias("steps"))


# -- distinct sequences ------------------------------------------------------


def _ends(rows: DataFrame) -> DataFrame:
    """``sid, ends_sha256``: the digest of each sequence's conversations, ascending.

    Ids stream through the hash in sorted order; only numbers move, and no list of
    them is held, however many conversations are alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, digest = None, [], hashlib.sha256()
        for batch in batches:
            sids, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts = [k for k in range(len(sids)) if k == 0 or sids[k] != sids[k - 1]]
            for a, b in zip(starts, [*starts[1:], len(sids)], strict=True):
                text = ",".join(map(str, ids[a:b])).encode()
                if sids[a] == now:
                    digest.update(b"," + text)
                    continue
                if now is not None:
                    found.append((now, digest.hexdigest()))
                now, digest = sids[a], hashlib.sha256(text)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], ["sid", "ends_sha256"])
                found = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["sid", "ends_sha256"])

    ordered = rows.select("sid", "conv_id").repartition(shuffle_width(rows.sparkSession), "sid").sortWithinPartitions("sid", "conv_id")
    return ordered.mapInArrow(run, "sid string, ends_sha256 string")


def _distinct(steps: DataFrame) -> DataFrame:
    """``seq, words, n, conv_id, ends_sha256`` of each distinct sequence."""
    seq = F.unhex(F.array_join(F.transform("steps", lambda s: s["digest"]), ""))
    rows = written(steps.select("conv_id", seq.alias("seq"), F.col("steps.words").alias("words")), "trie-rows")
    rows = rows.withColumn("sid", F.sha2("seq", 256))
    alike = rows.groupBy("sid").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("seq").alias("seq"), F.first("words").alias("words")
    )
    return alike.join(_ends(rows), "sid").drop("sid")


# -- the forest of a range ---------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from the start."""
    n = min(len(a), len(b))
    apart = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return (int(apart.argmax()) if apart.any() else n) // DIGEST


@dataclass
class Forest:
    """Compressed nodes of a range of sorted sequences. A node covers the
    stretch ``lo..hi``; ``joins`` counts the edges of just its depth in it."""

    depth: list[int]
    lo: list[int]
    hi: list[int]
    n: list[int]
    conv: list[int]
    leaves: list[int]
    below: list[int]  # words of every member, from the root on
    fresh: list[int]  # words of the nodes that the stretch introduces
    joins: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)

    @classmethod
    def joined(cls, lengths: list[int], lcp: list[int], n: list[int], conv: list[int], leaves: list[int], below: list[int], fresh: list[int]) -> Forest:
        """``lcp[i]`` is what sequence ``i`` shares with the one before."""
        m = len(lengths)
        f = cls([*lengths], [*range(m)], [*range(m)], [*n], [*conv], [*leaves], [*below], [*fresh], [0] * m, [-1] * m)
        root, top = [*range(m)], [*range(m)]

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in sorted(range(1, m), key=lambda i: -lcp[i]):
            a, b = find(i - 1), find(i)
            left, right = top[a], top[b]
            if f.depth[left] > lcp[i]:
                f.parent[left] = f._above(left, lcp[i])
                left = f.parent[left]
            f._take(left, right)
            root[b] = a
            top[a] = left
        return f

    def _above(self, v: int, depth: int) -> int:
        """A new node around ``v``."""
        for values in (self.lo, self.hi, self.n, self.conv, self.leaves, self.below, self.fresh):
            values.append(values[v])
        self.depth.append(depth)
        self.joins.append(0)
        self.parent.append(-1)
        return len(self.depth) - 1

    def _take(self, v: int, right: int) -> None:
        self.parent[right] = v
        self.joins[v] += 1
        self.hi[v] = self.hi[right]
        self.conv[v] = min(self.conv[v], self.conv[right])
        for values in (self.n, self.leaves, self.below, self.fresh):
            values[v] += values[right]


NODES = (
    "pid int, depth long, open boolean, key string, parent_key string, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_KINDS = [pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]
_NAMES = [part.split()[0] for part in NODES.split(", ")]


def _keys(seq: bytes, depth: int) -> list[str]:
    """A name for each prefix of ``seq`` up to ``depth`` turns."""
    found = [hashlib.blake2b(b"", digest_size=DIGEST).digest()]
    for d in range(depth):
        found.append(hashlib.blake2b(found[-1] + seq[DIGEST * d : DIGEST * (d + 1)], digest_size=DIGEST).digest())
    return [k.hex() for k in found]


def range_nodes(table: pa.Table) -> pa.Table:
    """Every node of a range, depth by depth; see ``NODES``. ``left`` and ``right``
    tell how deep the range agrees with its neighbours, -1 without one."""
    table = table.sort_by("seq")
    pid, left, right = (table.column(c)[0].as_py() for c in ("pid", "left", "right"))
    seqs, n, conv, ends = (table.column(c).to_pylist() for c in ("seq", "n", "conv_id", "ends_sha256"))
    sums = [np.concatenate(([0], np.cumsum(np.array(w, dtype=np.int64)))).tolist() for w in table.column("words").to_pylist()]
    m, lengths = len(seqs), [len(s) // DIGEST for s in seqs]
    lcp = [left, *(common(a, b) for a, b in zip(seqs, seqs[1:], strict=False))]
    leaves = [int(after < size) for size, after in zip(lengths, [*lcp[1:], right], strict=True)]
    below = [c * s[-1] for c, s in zip(n, sums, strict=True)]
    fresh = [s[-1] - s[max(shared, 0)] for s, shared in zip(sums, lcp, strict=True)]
    f = Forest.joined(lengths, lcp, n, conv, leaves, below, fresh)
    left_keys, right_keys = _keys(seqs[0], max(left, 0)), _keys(seqs[-1], max(right, 0))

    def key(depth: int, lo: int, hi: int) -> str | None:
        """The name of an open node; a node inside the range has none."""
        if lo == 0 and depth <= left:
            return left_keys[depth]
        return right_keys[depth] if hi == m - 1 and depth <= right else None

    rows = []
    for v, bottom in enumerate(f.depth):
        up, lo, hi, s = f.parent[v], f.lo[v], f.hi[v], sums[f.lo[v]]
        top = f.depth[up] if up >= 0 else -1
        over = key(top, f.lo[up], f.hi[up]) if up >= 0 else None
        above = f.conv[up] if up >= 0 and over is None else None
        for d in range(top + 1, bottom + 1):
            name = key(d, lo, hi)
            before = s[max(d - 1, 0)]
            inside = f.fresh[v] - (before - s[max(lcp[lo], 0)] if lcp[lo] < d else 0)
            kids = (f.joins[v] if d == bottom else 0) + (lcp[lo] <= d < lengths[lo])
            rows.append((
                pid, d, name is not None, name, over, f.conv[v], above, f.n[v], kids, f.leaves[v],
                f.below[v] - f.n[v] * before - inside, ends[lo] if lengths[lo] == d else None,
            ))
            over, above = name, f.conv[v] if name is None else None
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES)


# -- the whole ---------------------------------------------------------------


def _borders(ranged: DataFrame) -> DataFrame:
    """``pid, left, right``: how deep neighbouring ranges agree; a row per range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pid, before, first, last, after = (c.to_pylist() for c in batch.columns)
            shared = lambda x, y: [-1 if a is None or b is None else common(a, b) for a, b in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared(before, first), pa.int32()), pa.array(shared(last, after), pa.int32())], ["pid", "left", "right"]
            )

    order = W.orderBy("pid")
    ends = ranged.groupBy("pid").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    placed = ends.select("pid", F.lag("last").over(order).alias("before"), "first", "last", F.lead("first").over(order).alias("after"))
    return placed.mapInArrow(run, "pid int, left int, right int")


def trie(steps: DataFrame) -> DataFrame:
    """Every node of the prefix trie of ``steps(conv_id, steps)``, see ``sequences``.

    ``conv_id`` is the smallest member and with ``depth`` names the node;
    ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` as
    in the module's text, ``ends_sha256`` over the members that end at the node. A
    conversation without turns is a member of the root. No rows without conversations.
    A node that half of all sequences share lies in many ranges, each of which adds
    its part.
    """
    width = shuffle_width(steps.sparkSession)
    ranged = _distinct(steps).repartitionByRange(width, "seq").withColumn("pid", F.spark_partition_id())
    ranged = written(ranged, "trie-ranges")
    borders = F.broadcast(_borders(ranged))  # a row per range
    nodes = written(ranged.join(borders, "pid").groupBy("pid").applyInArrow(range_nodes, NODES), "trie-nodes")

    opened = nodes.where("open")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = opened.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), F.max("ends_sha256").alias("ends_sha256"), *sums
    )
    merged = written(merged, "trie-open")
    named = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    # The children that one range has under an open node meet that node by range, so that a busy node is spread.
    within = opened.select("pid", F.col("key").alias("parent_key")).distinct().join(named, "parent_key")
    closed = nodes.where("not open")
    parts = [
        closed.where("parent_key is null"),
        closed.where("parent_key is not null").join(within, ["pid", "parent_key"]).withColumn("parent_conv_id", F.col("_parent")),
        merged.where("parent_key is null").withColumn("parent_conv_id", F.lit(None).cast("long")),
        merged.join(named, "parent_key").withColumn("parent_conv_id", F.col("_parent")),
    ]
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    ]
    whole = parts[0].select(*columns)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*columns))
    return whole


def conversation_trie(conversations: DataFrame, every: int = 20, longest: int = 3) -> DataFrame:
    """The trie of ``conversations(conv_id, turn, role, text)``, rebuilt with stems."""
    return trie(with_stems(written(sequences(conversations), "trie-turns"), every, longest))
