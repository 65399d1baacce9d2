import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusweave.llm import ann, codes, embdedup, simhash
from corpusweave.llm.components import components

VECS = "vec_id long, embedding array<float>, digest string, label int"


def reached(n, pairs):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_components_of_random_links(spark, seed):
    rng = np.random.default_rng(seed)
    n = 300
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, n, (220, 2))] + [(k, k + 1) for k in range(60)] + [(200, k) for k in range(201, 260)]
    rows = pairs + [(b, a) for a, b in pairs[:20]] + [(5, 5), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    root = reached(n, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {k: root[k] for k in linked}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors(seed=0, n=400, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for k in range(60):  # near copies in chains and a dense group
        x[100 + k] = x[k % 5] + 0.08 * rng.standard_normal(dim)
        x[200 + k] = 3 * x[7] + 0.02 * k * rng.standard_normal(dim)
    x[300:310] = x[301]
    return x.astype(np.float32)


def odd_rows():
    bad = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 5]
    return [(9000 + k, v, "mine", 1) for k, v in enumerate(bad)]


def frame(spark, x):
    rows = [(k, [float(v) for v in r], "mine", 0) for k, r in enumerate(x)]
    return spark.createDataFrame(rows + odd_rows(), VECS)


def test_embedding_links_equal_all_pairs(spark):
    x = vectors()
    got = {r.vec_id: r for r in embdedup.linked(frame(spark, x), embdedup.EmbeddingDedupConfig(block=32, miss=1e-6)).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    root = reached(len(x), zip(*np.nonzero(near), strict=True))
    for k in range(len(x)):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (near[k].sum(), root[k], root[k] == k)
    for k, *_ in odd_rows():
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert len(got) == len(x) + len(odd_rows())


def test_embedding_rows_without_or_with_one_id(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(None, v, "d", 0), (4, v, "d", 0), (4, v, "d", 0), (2, [2.0, 4.0, 6.0], "d", 0)]
    got = sorted(map(tuple, embdedup.linked(spark.createDataFrame(rows, VECS)).collect()), key=str)
    assert got == sorted([(None, 3, 2, False), (4, 3, 2, False), (4, 3, 2, False), (2, 3, 2, True)], key=str)
    empty = spark.createDataFrame([], VECS)
    assert embdedup.linked(empty).collect() == []
    assert [tuple(r) for r in embdedup.linked(spark.createDataFrame([(1, None, "d", 0)], VECS)).collect()] == [(1, 0, 1, True)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    dim, bits = 64, 256
    turn = codes.rotation(dim, bits, 1)
    assert np.allclose(turn @ turn.T, np.eye(dim))
    x, q = (v / np.linalg.norm(v, axis=1)[:, None] for v in (rng.standard_normal((2000, dim)), rng.standard_normal((50, dim))))
    r = x @ turn
    l1 = np.abs(r).sum(axis=1)
    off = ((q @ turn) @ np.where(r > 0, 1, -1).T / l1 - q @ x.T) / codes.error_scale(l1, bits)
    assert abs(off.mean()) < 0.02 and (np.abs(off) < 3).mean() > 0.995


def test_nearest_recall_and_order(spark):
    x = vectors(seed=5, n=900)
    df = frame(spark, x)
    config = ann.AnnConfig(block=100, query_block=40)
    got = ann.nearest(df, df.where(F.col("vec_id") % 10 == 0), config).collect()
    hit = total = 0
    for q in range(0, len(x), 10):
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        want = np.lexsort((np.arange(len(x)), -score))[:20]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 21))
        assert np.allclose([m[2] for m in mine], [score[m[1]] for m in mine])
        assert [m[1] for m in mine] == sorted((m[1] for m in mine), key=lambda v: (-dict((a, s) for _, a, s in mine)[v], v))
        hit += len({m[1] for m in mine} & set(want.tolist()))
        total += 20
    assert hit / total >= 0.99
    assert not {r.query_id for r in got} & {k for k, *_ in odd_rows()}


def test_nearest_of_few(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0], "d", 0), (3, [2.0, 0.0], "d", 0), (1, [2.0, 0.0], "d", 0), (None, [5.0, 0.0], "d", 0)], VECS)
    got = ann.nearest(df, df.where("vec_id = 20")).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(20, 1, 1, 2.0), (20, 2, 3, 2.0)]
    one = df.where("vec_id = 20")
    assert ann.nearest(one, one).collect() == []
    assert ann.nearest(df.where("false"), df.where("false")).collect() == []


def prints(text, k=4):
    words = text.encode().lower().split()
    parts = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(v >> j & 1 for v in h) > len(h))


def test_fingerprints():
    texts = ["", " \t\n", "one", "One TWO three", "a b c d e", "x " * 50, "Ä   b c İ", "\x1f \x1c\x0bq", "w1 w2 w3 w4 " * 30_000]
    for t in texts[:-1]:
        assert simhash.fingerprint(t) % (1 << 64) == prints(t)
    assert simhash.fingerprint(None) == 0
    many = " ".join(f"w{k * k % 977}" for k in range(70_000))
    assert simhash.fingerprint(many) % (1 << 64) == prints(many)


def test_embedding_is_a_lower_bound(spark):
    rng = np.random.default_rng(1)
    rows = [tuple(int(v) for v in r) for r in rng.integers(-(1 << 63), (1 << 63) - 1, (300, 2))]
    df = spark.createDataFrame(rows, "a long, b long")
    bound = F.bit_count(simhash.embedded(F.col("a")).bitwiseXOR(simhash.embedded(F.col("b"))))
    for r in df.select("a", "b", bound.alias("l")).collect():
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        counts = [[bin(v >> 2 * s & 3).count("1") for s in range(32)] for v in (a, b)]
        assert r.l == sum(abs(p - q) for p, q in zip(*counts, strict=True)) <= bin(a ^ b).count("1")


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_grid_join_equals_all_pairs(spark, radius):
    rng = np.random.default_rng(radius)
    base = [int(v) for v in rng.integers(0, 1 << 63, 60)]
    points = set(base)
    for b in base[:30]:
        for _ in range(12):
            points.add(b ^ sum(1 << int(j) for j in set(rng.integers(0, 63, int(rng.integers(1, 7))))))
    at = base[0]
    for k in range(40):  # a chain of single steps
        at ^= 3 << k
        points.add(at)
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    got = {r.fp: r.comp for r in simhash.link_components(spark.createDataFrame([(s,) for s in signed], "fp long"), simhash.SimHashConfig(max_distance=radius)).collect()}
    arr = np.array(points, dtype=np.uint64)
    near = np.bitwise_count(arr[:, None] ^ arr[None, :]) <= radius
    root = reached(len(points), zip(*np.nonzero(near), strict=True))
    assert len(got) == len(points)
    assert len({(root[k], got[s]) for k, s in enumerate(signed)}) == len(set(root)) == len(set(got.values()))


@pytest.mark.parametrize("block", [7, 2048])
def test_a_group_around_its_least_member_links_as_all_pairs_do(spark, block):
    """Members are five to eight bits from the least one, so its star holds none of them."""
    rng = np.random.default_rng(block)
    points = {0}
    while len(points) < 150:
        points.add(sum(1 << int(j) for j in rng.choice(20, int(rng.integers(5, 9)), replace=False)))
    points = sorted(points)
    found = simhash.link_components(spark.createDataFrame([(p,) for p in points], "fp long"), simhash.SimHashConfig(block=block)).collect()
    arr = np.array(points, dtype=np.uint64)
    root = reached(len(points), zip(*np.nonzero(np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 4), strict=True))
    got = {r.fp: r.comp for r in found}
    assert len(found) == len(points) and 1 < len(set(root)) < 50
    assert len({(root[k], got[p]) for k, p in enumerate(points)}) == len(set(root)) == len(set(got.values()))


@pytest.mark.parametrize("block", [2, 5, 2048])
def test_cells_are_scanned_over_small_batches(spark, block):
    rng = random.Random(7)
    base = [rng.getrandbits(62) for _ in range(4)]
    points = sorted({b ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)) for b in base for _ in range(12)})
    root = {p: p for p in points}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= 4 and top(a) != top(b):
                root[max(top(a), top(b))] = min(top(a), top(b))
    df, size = spark.createDataFrame([(p,) for p in points], "fp long"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(size)
    spark.conf.set(size, "7")
    try:
        found = simhash.link_components(df, simhash.SimHashConfig(block=block)).collect()
    finally:
        spark.conf.set(size, was)
    assert {r.fp: r.comp for r in found} == {p: top(p) for p in points}


def test_near_copies_hand_on_a_link_each_not_their_cells(spark):
    base = 0x1234567890ABCDE
    points = sorted({base} | {base ^ 1 << i for i in range(62)})
    cells = simhash._cells(spark.createDataFrame([(p,) for p in points], "fp long"))
    shared = cells.groupBy("kind", "cell").count().where("count > 1").agg({"count": "sum"}).first()[0]
    links = simhash._scanned(cells, simhash.SimHashConfig())
    assert links.where(f"kind <> {simhash.LINK}").count() == 0
    assert links.count() <= 8 * (len(points) - 1) < shared / 8  # of four tasks, each with a last cell on its own


def test_documents_and_deduplication(spark):
    rows = [(5, "same words here now and then"), (3, "Same words here NOW and then"), (9, None), (8, " "), (7, "other text of its own kind"), (None, "same words here now and then"), (7, "other text of its own kind")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("fingerprint", F.lit(1))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (7, 7), (None, 3), (7, 7)], key=str)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 7, 7, 8, None]
    assert simhash.near_duplicates(docs.where("false")).collect() == []
    assert simhash.deduplicated(docs.where("false")).collect() == []
