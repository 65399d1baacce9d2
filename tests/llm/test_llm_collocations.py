import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusweave.llm import collocations as co

DOCS = "text string, lang string, word string, ids int, n long, rank string"
CONFIG = co.CollocationConfig(min_count=3, top=40, shard_words=200, block_entries=64)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 2**62)] * 3), min_size=1, max_size=60), st.sampled_from([(3, 7, 0), (3, 21, 5), (3, 40, 3), (2, 13, 2), (4, 15, 4), (3, 1, 6)]))
def test_phrases_survive_packing_permutation_and_filters(rows, shape):
    layout = co.Layout(*shape)
    size = 1 << layout.bits
    words = [np.array([r[k % 3] % size for r in rows], np.uint64) for k in range(layout.words)]
    want = Counter(zip(*(w.tolist() for w in words), strict=True))
    lanes = layout.permute(*layout.pack(words))
    assert [w.tolist() for w in layout.unpack(*layout.restore(*lanes))] == [w.tolist() for w in words]
    half = len(rows) // 2
    found = defaultdict(list)
    for part in (slice(None, half), slice(half, None)):
        for block, f in co.QuotientFilter.of(layout, *(x[part] for x in lanes)).blocks():
            found[block].append(f.pack())
    got = Counter()
    for filters in found.values():
        whole = co.QuotientFilter.merged(layout, [co.QuotientFilter.unpack(layout, f) for f in filters])
        keys = list(zip(whole.high.tolist(), whole.low.tolist(), strict=True))
        assert keys == sorted(set(keys))
        for row, n in zip(zip(*(w.tolist() for w in layout.unpack(*layout.restore(whole.high, whole.low))), strict=True), whole.counts.tolist(), strict=True):
            got[row] += n
    assert got == want


def test_large_counters_and_empty_filters():
    layout = co.Layout(3, 8, 2)
    lanes = layout.permute(*layout.pack([np.repeat(np.uint64([1, 2, 3]), [1, 255, 70_000])]))
    for _, f in co.QuotientFilter.of(layout, *lanes).blocks():
        back = co.QuotientFilter.unpack(layout, f.pack())
        assert back.counts.tolist() == f.counts.tolist() and back.low.tolist() == f.low.tolist() and back.high.tolist() == f.high.tolist()
    none = co.QuotientFilter.of(layout, lanes[0][:0], lanes[1][:0])
    assert list(none.blocks()) == [] and len(co.QuotientFilter.unpack(layout, none.pack()).counts) == 0
    with pytest.raises(ValueError):
        co.Layout(3, 43)


def model(rows, config):
    f, n, best = defaultdict(Counter), Counter(), []
    for text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]", piece) if w]
            n[lang] += len(words)
            for size in range(1, config.max_words + 1):
                f[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= config.min_count}
        rows = []
        for p, a in often.items():
            inside = any(
                100 * b >= config.share * a and len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q))) for q, b in often.items()
            )
            if not inside:
                cut = min((config.scale * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-cut[0], -a, " ".join(p).encode(), counts[p[: cut[1]]], counts[p[cut[1] :]]))
        best += [(lang, k + 1, p.decode(), -a, x, y, n[lang], -s) for k, (s, a, p, x, y) in enumerate(sorted(rows)[: config.top])]
    return sorted(best)


def found(spark, rows, config=CONFIG, parts=3):
    return sorted(map(tuple, co.collocations(spark.createDataFrame(rows, DOCS).repartition(parts), config).collect()))


def texts(seed, docs):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "CITY", "Über", "a b", "x\x01", "x", "of", "the", "é", "İ", "\x1f"]
    rows = []
    for k in range(docs):
        out = []
        for _ in range(rng.choice([0, 3, 40])):
            out += rng.choice([["in", "New", "York"], ["New", "York", "City"], [rng.choice(vocabulary)], [rng.choice(vocabulary)]])
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for w in out)
        rows.append((text, [None, "en", "de", "und", ""][k % 5] if k % 3 else "en", "", 0, 0, ""))
    return rows


@pytest.mark.parametrize("words", [2, 3, 4])
def test_equals_the_model(spark, words):
    rows = texts(words, 160)
    config = co.CollocationConfig(max_words=words, min_count=3, top=40, shard_words=200, block_entries=64)
    assert found(spark, rows, config) == model(rows, config)


def test_long_texts_keep_phrases_across_parts(spark, monkeypatch):
    rows = [("New York, new york " * 400, "en", "", 0, 0, ""), ("w" * 5000, "en", "", 0, 0, "")]
    want = model(rows, CONFIG)
    assert list(co._parts(rows[0][0].encode())) == [rows[0][0].encode()]
    monkeypatch.setattr(co, "_PART", 50)
    assert b"".join(co._parts(rows[0][0].encode())) == rows[0][0].encode() and len(list(co._parts(rows[0][0].encode()))) > 50
    assert list(co._parts(rows[1][0].encode())) == [rows[1][0].encode()]
    assert found(spark, rows) == want


def test_no_words(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None, "", 0, 0, ""), ("", "en", "", 0, 0, ""), (" .,\t", "en", "", 0, 0, "")]) == []
    assert found(spark, [("once only here", "en", "", 0, 0, "")]) == []


def test_products_pass_64_bits(spark):
    words = spark.createDataFrame([(1, "en", "a", 4_000_000_000), (2, "en", "b", 3_000_000_000)], "id long, lang string, word string, f long")
    phrases = spark.createDataFrame([([1, 2], 2_999_999_999)], "ids array<long>, a long")
    (row,) = co._scored(words, phrases, CONFIG).collect()
    assert row.score == 1_000_000 * 2_999_999_999**2 // (4_000_000_000 * 3_000_000_000)
