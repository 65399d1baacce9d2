import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from corpusweave.llm import mixing, secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shares(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > cap * sizes[s]]
        if not over:
            return fixed | {s: level * w[s] for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def mixed(spark, rows, **extra):
    return mixing.mix_report(spark.createDataFrame(rows, DOCS), **extra).collect()


def test_taken_words_come_near_the_targets(spark):
    rows = []
    for k in range(3000):
        source = "hot" if k % 3 == 0 else None if k % 7 == 0 else f"s{k % 5}"
        rows.append((k, "w " * (1 + k * k % 83), None, source, 0))
    got = mixed(spark, rows)
    by_id = {r[0]: r[3] for r in rows}
    sizes, taken, target = {}, {}, {}
    for r in got:
        s = by_id[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    want = shares(sizes)
    for s, words in sizes.items():
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 2 * 83
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixed(spark, rows)))


def test_white_space_is_ascii_and_odd_rows_are_defined(spark):
    rows = [(1, "a\u00a0b c\x1fd", None, "a", 0), (2, None, None, "a", 0), (3, "", None, None, 0), (None, "x y", None, "b", 0), (1, "a\u00a0b c\x1fd", None, "a", 0)]
    got = sorted((r.doc_id or 0, r.size) for r in mixed(spark, rows))
    assert got == [(0, 2), (1, 2), (1, 2), (2, 0), (3, 0)]
    assert mixed(spark, []) == []
    assert all(r.target == 0 and r.taken == 0 for r in mixed(spark, [(1, None, None, "a", 0)]))


def test_mix_emits_whole_rows_as_often_as_the_report_says(spark):
    rows = [(k, "w " * (k % 9), "en", f"s{k % 4}", k) for k in range(400)] + [(7, "w " * 7, "en", "s3", 7)] * 3
    docs = spark.createDataFrame(rows, DOCS).withColumn("_c", F.lit("kept")).withColumn("target", F.lit(1))
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    words = out.withColumn("n", mixing.word_count(F.col("text"))).groupBy("source").agg(F.sum("n").alias("n"))
    report = mixing.mix_report(docs).join(docs.select("doc_id", "source").distinct(), "doc_id").groupBy("source").agg(F.sum("taken").alias("n"))
    assert {tuple(r) for r in words.collect()} == {tuple(r) for r in report.collect()}


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{e}" for a, k, e in sorted(found))


HEXES = "0123456789abcdef"
TEXTS = [
    "", None, "plain words only", "\U0001f600\U0001f600 token = abcdef123 \u00e9",
    "secret=token : abcdefgh and password=short pass", 'API_KEY: "' + "Zq3" * 9 + '" apikey=abc.def-gh=',
    "AKIA" + "A1" * 8 + " AKIAshort AKIAAKIA" + "B" * 14, HEXES * 2 + "g" + HEXES + HEXES[:8] + HEXES[:7],
    "token=" + HEXES * 3, "passwd=x" * 3, "tokentoken=aaaaaa" * 700, "\n".join(["secret='abc123xyz'"] * 50),
    "tok\u017fecret=abcdefg \u212aey pa\u017f\u017fword=abcdefg", "e" * 24, "key " * 3000 + "PASSWORD = 'end-of-text'",
]


def test_base_spans_equal_a_sequential_scan(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        want = base(TEXTS[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), TEXTS[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k + ":") for s in want.split(",")) for k in secrets.KINDS[:3])
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_models_add_random_runs_and_leave_words(spark):
    words = "the reading overthinking understandably internationalization counterrevolutionaries electroencephalographically"
    random = "xK9qZ7vRw3TbN8mLp2Js"
    rows = [(k, f"{words} token={hashlib.md5(str(k).encode()).hexdigest()}") for k in range(60)] + [(99, f"{words} {random} {words}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    at = len(words) + 1
    assert got[99] == f"markov:{at}:{at + len(random)}"
    assert all(s.count("markov") == 0 for k, s in got.items() if k != 99)


def test_redaction_keeps_the_rest(spark):
    rows = [
        (1, "a token=abcdef1 b", "en", "s", 17), (2, None, None, None, None), (3, "nothing", "en", "s", 5),
        (4, "\U0001f600 token=" + HEXES * 2 + " AKIA" + "Q" * 16, "en", "s", 0), (4, "a token=abcdef1 b", "en", "s", 17),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("base", F.lit(1)).withColumn("row", F.lit(2)).withColumn("spans", F.lit("x"))
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    assert got == sorted([
        (1, "a [secret] b", 12), (2, None, None), (3, "nothing", 5), (4, "\U0001f600 [secret] [secret]", 19), (4, "a [secret] b", 12),
    ], key=str)
    assert secrets.redact(docs.where("false")).collect() == []
    assert secrets.find_secrets(docs.where("false")).collect() == []


def test_models_judge_what_a_pattern_leaves_and_the_parts_of_a_run(spark):
    words = "the reading overthinking understandably internationalization counterrevolutionaries electroencephalographically"
    random, access = "xK9qZ7vRw3TbN8mLp2Js", "AKIA" + "A1B2" * 4
    path = "counterrevolutionaries/understandably/internationalization/overthinking/reading/electroencephalographically/"
    key, tail = "0123456789abcdef" * 2, "xK9qZ7vRw3+TbN8mLp2Js"
    odd = [f"{access}/{random}.", f"{path * 3}{random} {words}", f"my-{tail}=token={key}", f"{path * 3} plain", f"{random}/{key}/{random}"]
    rows = [(k, f"{words} token={hashlib.md5(str(k).encode()).hexdigest()}") for k in range(60)] + [(100 + k, t) for k, t in enumerate(odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    end = len(access) + 1 + len(random)
    assert got[100] in {f"access:0:{len(access)},markov:{at}:{end}" for at in (len(access), len(access) + 1)}
    at = len(path * 3)
    assert got[101] == f"markov:{at}:{at + len(random)}"
    assert "markov" in got[102] and "assign" in got[102]
    assert got[103] == ""
    assert got[104].count("markov") == 2 and got[104].count("hex") == 1
    texts = secrets.redact(docs).where("doc_id >= 100").select("text").collect()
    assert not any(random in r.text or tail in r.text for r in texts)


def test_models_learn_from_every_document(spark):
    n = 10_500
    docs = spark.range(n).select(
        F.when(F.col("id") % 100 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("plain words token=x"), F.col("id") + 100_000).alias("text")
    )
    got = {r.secret: r["count"] for r in secrets.labelled_samples(docs).groupBy("secret").count().collect()}
    assert got == {True: n, False: 2}


def test_long_runs_and_many_distinct_words_stay_cheap(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = " ".join(letters[k % 26] + letters[k // 26 % 26] + letters[k // 676 % 26] + letters[k // 17576 % 26] + "word" for k in range(200_000))
    run = hashlib.sha256(b"run").hexdigest().upper() * 8000
    start = time.monotonic()
    got = secrets.find_secrets(spark.createDataFrame([(1, words, None, None, 0), (2, "x " + run + " y", None, None, 0)], DOCS)).collect()
    assert time.monotonic() - start < 120
    assert {r.doc_id: r.n_hex for r in got} == {1: 0, 2: 0} and len(got) == 2


def test_spans_of_very_long_texts(spark):
    """Spans far into a text are those of its end alone, in time that does not
    grow with the square of the spans."""
    tail = "token=" + "a1B2" * 5 + " q7Zk/AKIA" + "X" * 16 + "/w9Tq3Lm8Rz5Yc2Vb7Nd4 end"
    filler = "key aaa é " * 1000
    many = ("f0" * 12 + " Q9wE7rT5yU3iO1pA8sD6 ") * 20_000
    docs = spark.createDataFrame([(1, tail), (2, filler + tail), (3, many), (4, "ab1/" * 250_000)], "doc_id long, text string")
    model = secrets.train(secrets.labelled_samples(docs.where("doc_id < 3")))
    started = time.monotonic()
    rows = {r["doc_id"]: r for r in secrets.scan(docs, model).select("row.doc_id", "base", "spans").collect()}
    assert time.monotonic() - started < 300
    moved = [(s["start"] - len(filler), s["kind"], s["end"] - len(filler)) for s in rows[2]["spans"]]
    assert moved == [tuple(s) for s in rows[1]["spans"]]
    assert len(rows[3]["base"]) == 20_000
    clean = secrets.redact(docs.where("doc_id = 2")).first()["text"]
    assert clean.startswith(filler) and clean.endswith(" end") and "AKIA" not in clean
