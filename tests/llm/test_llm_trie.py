import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusweave.llm import trie

TURNS = "conv_id long, turn long, role string, text string, depth string, pid string, seq string, words int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    """Turns of each conversation behind its stem. A remainder has the sign of its id."""
    turns = defaultdict(list)
    for c, k, role, text, *_ in rows:
        if c is not None:
            turns[c].append((k is not None, k or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    stem = lambda c: c - (abs(c) % 20) * (1 if c >= 0 else -1)
    cut = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(stem(c), [])[: cut[c]] + own[c][cut[c] :] for c in own}


def model(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, rows = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = (len(members[p]) - 1) * words(p) + sum(saved[k] for k in kids[p])
        rows.append((
            min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        ))
    return sorted(rows, key=lambda r: r[:2])


def found(spark, rows, parts=1):
    got = trie.conversation_trie(spark.createDataFrame(rows, TURNS).repartition(parts))
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=lambda r: r[:2])


def talks(seed, convs, deep=6, hot=True):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if hot and c % 3 == 0:  # a third of all conversations alike
            said = [("user", "hi there"), ("bot", "hello you  all"), ("user", "bye")]
        else:
            said = [(rng.choice(["user", "bot"]), rng.choice(["a b", "c", "", "d e f\x1cg"])) for _ in range(rng.randint(1, deep))]
        rows += [(c, k, *t, "", "", "", 0) for k, t in enumerate(said)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", ["1", "4", "23"])
def test_equals_the_model_however_the_ranges_fall(spark, width):
    rows = talks(int(width), 150)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        assert found(spark, rows, 3) == model(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_long_conversations_share_long_prefixes(spark):
    rows = []
    for c in (20, 40, 41, 42, 60):
        said = [("user", f"t{k}") for k in range(400 + c)]
        if c == 42:
            said[300] = ("bot", "else")
        rows += [(c, k, *t, "", "", "", 0) for k, t in enumerate(said)]
    assert found(spark, rows) == model(rebuilt(rows))


def test_odd_rows_are_defined(spark):
    x = ("", "", "", 0)
    rows = [
        (0, 2, None, "b", *x), (0, None, "user", None, *x), (1, 5, "user", "own", *x), (None, 1, "user", "lost", *x),
        (7, 1, "user", "same", *x), (7, 2, "user", "same", *x), (-3, 1, "u", "ser", *x), (-23, 1, "us", "er", *x),
        (30_000_000_021, 1, "user", "far from its stem", *x),
    ]
    assert found(spark, rows) == model(rebuilt(rows))
    assert found(spark, []) == []


def test_conversations_without_turns_are_members_of_the_root(spark):
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(short, 1, "user", "a", "", "", "", 0), (short, 2, "bot", "b", "", "", "", 0)]
    assert found(spark, rows) == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]
