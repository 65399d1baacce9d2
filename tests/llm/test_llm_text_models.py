import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusweave.llm import bpe, langid, quality
from corpusweave.llm.training import crc_mod

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.MergeList.from_file(PATH))


def ids(encoder, text):
    return np.frombuffer(b"".join(encoder.encode(text)), dtype="<u4").tolist()


def test_random_texts_equal_the_library(encoder, library):
    rnd = random.Random(4)
    alphabet = "aabbeitthnerson  \n\t'sdlvrem109!?.,é漢\U0001f600́  \x1f\x85"
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        if rnd.random() < 0.2:
            text = text.join(["<|endoftext|>"] * 3)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(encoder, text) == want
        assert bpe.decoded(encoder.merges, np.array(want, dtype="<u4").tobytes()) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("alphabet", ["a", "ab", "ehrtnsoi", "=", " ", "漢é", "aA"])
def test_long_pieces_stream_in_bounded_memory(encoder, library, alphabet):
    rnd = random.Random(len(alphabet))
    text = "".join(rnd.choice(alphabet) for _ in range(6000))
    want = library.encode(text, add_special_tokens=False).ids
    assert ids(encoder, text) == want
    stream, found, data = bpe.Transducer(encoder.merges), [], text.encode()
    for at in range(0, len(data), 300):
        found += stream.feed(data[at : at + 300])
        assert len(stream.data) <= encoder.merges.sufficient_lookahead + 300
    assert found + stream.close() == want


def test_lookahead_covers_every_later_reading(encoder):
    """Tokens that end this far behind the reader stay, whatever follows."""
    m, rnd = encoder.merges, random.Random(8)
    for _ in range(200):
        head = "".join(rnd.choice("enrti") for _ in range(m.sufficient_lookahead + 40))
        alone, longer = ids(encoder, head), ids(encoder, head + "".join(rnd.choice("enrtishg") for _ in range(30)))
        at = same = 0
        for a, b in zip(alone, longer, strict=False):
            if a != b:
                break
            at += len(m.bytes[a])
            same += 1
        assert len(head) - at <= m.sufficient_lookahead


def test_small_merge_lists_equal_greedy_merging():
    rnd = random.Random(2)
    for _ in range(60):
        symbols = bpe.byte_symbols()
        tokens, merges = [symbols[b] for b in range(256)], []
        text = [symbols[ord(rnd.choice("ab"))] for _ in range(300)]
        for _ in range(rnd.randint(1, 25)):  # merges as training makes them
            counts = {}
            for p in zip(text, text[1:], strict=False):
                counts[p] = counts.get(p, 0) + 1
            if not counts:
                break
            best = max(sorted(counts), key=lambda p: counts[p] * rnd.random())
            if best[0] + best[1] in tokens:
                continue
            merges.append(best)
            tokens.append(best[0] + best[1])
            text = greedy(text, [best])
        m = bpe.MergeList({t: k for k, t in enumerate(tokens)}, merges)
        e = bpe.Encoder(m)
        for _ in range(30):
            piece = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 25)))
            assert [tokens[k] for k in np.frombuffer(e._piece(piece), dtype="<u4")] == greedy(list(piece), merges)


def greedy(parts, merges):
    rank = {p: k for k, p in enumerate(merges)}
    while True:
        pairs = [(rank[p], k) for k, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank]
        if not pairs:
            return parts
        _, at = min(pairs)
        parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]


def test_parts_join_to_the_text():
    rnd = random.Random(5)
    text = "".join(rnd.choice("ab  \n é") for _ in range(5000))
    assert "".join(bpe.parts_of(text, 64)) == text and "".join(bpe.parts_of("x" * 900, 64)) == "x" * 900


def test_decoder_takes_bytes_as_they_come(encoder, library):
    want = library.encode("\U0001f600漢 x", add_special_tokens=False).ids
    d = bpe.Decoder(encoder.merges)
    assert "".join(d.feed(np.array([i])) for i in want) + d.close() == "\U0001f600漢 x"
    for cut in range(1, len(want)):
        d = bpe.Decoder(encoder.merges)
        assert d.feed(np.array(want[:cut])) + d.close() == library.decode(want[:cut], skip_special_tokens=False)


def test_cuts_are_those_of_the_pattern():
    rnd = random.Random(12)
    alphabet = ["'", "'s", "'re", "'ll", "'v", "S", "t", "e", "l", " ", "  ", "\n", "\t", "\u3000", "\x1f", "\x85", "7", "½", "é", "漢", "\u0301", "\U0001f600", ".", "_"]
    for _ in range(3000):
        texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 9))) for _ in range(rnd.randint(1, 4))]
        begins = np.cumsum([0, *map(len, texts)])
        found = bpe.cuts(np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4"), begins)
        assert found.tolist() == [at + m.start() for at, text in zip(begins, texts, strict=False) for m in regex.finditer(bpe.PATTERN, text)], texts


def test_every_piece_goes_through_the_transducer_and_shared_prefixes_once(monkeypatch):
    read, extend = [], bpe.Transducer._extend
    monkeypatch.setattr(bpe.Transducer, "_extend", lambda self, part: (read.append(part), extend(self, part))[1])
    texts = ["zqtherxin.zqtherxon", "zqtherxon.zqtherxin", "zqtherxinw.zqtherx"]
    found = bpe.Encoder(bpe.MergeList.from_file(PATH)).encode_all(enumerate(texts * 50))
    assert [k for k, _ in found] == list(range(150))
    assert read == [b".", b"zqtherx", b"in", b"w", b"on"]


@pytest.mark.parametrize(("block", "group"), [(40, 100), (300, 300), (1 << 20, 1 << 23)])
def test_blocks_and_groups_do_not_change_the_ids(encoder, library, monkeypatch, block, group):
    monkeypatch.setattr(bpe, "_BLOCK", block)
    monkeypatch.setattr(bpe, "_GROUP", group)
    rnd = random.Random(block)
    words = ["the", "'s", "ther", "Étérnel", "漢字", "<|endoftext|>", " ", "\n\n", "10", "...", "x" * 90, "a.b1" * 60]
    texts = ["", "", *("".join(rnd.choices([*words, " ", " "], k=rnd.randint(0, 30))) for _ in range(300)), "z" * 5000 + "a1" * 400, ""]
    keys = [None if k % 7 == 0 else k // 2 for k in range(len(texts))]  # missing and repeated
    want = [(k, library.encode(t, add_special_tokens=False).ids) for k, t in zip(keys, texts, strict=True)]
    assert [(k, np.frombuffer(i, "<u4").tolist()) for k, i in encoder.encode_all(zip(keys, texts, strict=True))] == want
    assert list(encoder.encode_all([])) == []


def test_a_byte_without_token_leaves_the_transducer_whole():
    symbols = bpe.byte_symbols()
    names = [symbols[b] for b in b"abc"] + [symbols[97] + symbols[98], symbols[99] + symbols[122]]
    t = bpe.Transducer(bpe.MergeList({n: k for k, n in enumerate(names)}, [(names[0], names[1])]))
    assert t.whole(b"abc") == [3, 2]
    for bad in (b"abz", b"czz", b"abcb!"):
        with pytest.raises(ValueError, match="no token"):
            t.whole(bad)
        assert t.whole(b"abca") == [3, 2, 0]


def test_documents_are_encoded_whole(spark, library):
    rows = [(1, "hello world"), (2, None), (3, ""), (None, "x"), (1, "hello world"), (4, "long words " * 40_000 + "z" * 9000), (5, "<|endoftext|>  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(1))
    found = bpe.encode(docs, PATH)
    back = bpe.decode(found, PATH).collect()
    want = sorted(((d, library.encode(t or "", add_special_tokens=False).ids, t or "") for d, t in rows), key=str)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in back), key=str) == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in back)
    assert bpe.digests(docs.where("false"), PATH).collect() == []


def sentences(rnd, words, n):
    return " ".join(rnd.choice(words) for _ in range(n))


def quality_docs(spark, n=600):
    rnd = random.Random(1)
    words = [a + b for a in ("tion", "re", "the", "st", "an", "ou") for b in ("er", "ing", "ly", "ed", "es", "on", "al")]
    rows, labels = [], []
    for k in range(n):
        text, good = sentences(rnd, words, rnd.randint(20, 90)), k % 4 != 0
        if not good:
            text = [text.upper().replace(" ", "!! "), text.replace(" ", " | "), " ".join(w for w in text.split()[:5] for _ in range(12))][k % 3]
        rows.append((k, text, "x"))
        labels.append((k, int(good)))
    rows += [(9001, None, "x"), (9002, "", "x"), (None, "plain words of text", "x"), (1, rows[1][1], "x")]
    labels += [(9001, 1), (2, None), (3, 0), (3, 1), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out string")
    return docs.withColumn("_score", F.lit("mine")), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_on_held_out_documents(spark):
    docs, labels = quality_docs(spark)
    config = quality.QualityConfig(epochs=30)
    got = quality.judge(docs, labels, config).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    truth = {r.doc_id: r.quality for r in labels.where("doc_id < 600 and doc_id > 3").collect()}
    held = {r.doc_id for r in docs.where(crc_mod(F.col("doc_id"), 5) == 0).collect()}
    assert {r.doc_id for r in got if r.held_out} == held
    judged = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in judged]) > 0.95
    kept = quality.accepted(docs, labels, config)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r.doc_id for r in got if r.predicted), key=str)


def test_quality_does_not_learn_from_held_out_labels(spark):
    docs, labels = quality_docs(spark, 300)
    config = quality.QualityConfig(epochs=5)
    held = crc_mod(F.col("doc_id"), 5) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(map(tuple, quality.judge(docs, t, config).collect()), key=str) for t in (labels, turned))
    assert [r[:2] for r in one] == [r[:2] for r in two]
    assert np.allclose([r[2] for r in one], [r[2] for r in two], atol=1e-6)


def test_quality_without_labels_or_rows(spark):
    docs, labels = quality_docs(spark, 20)
    assert {r.score for r in quality.judge(docs, labels.where("false")).collect()} == {0.5}
    assert quality.judge(docs.where("false"), labels).collect() == []
    assert {r.score for r in quality.judge(docs, labels.where("quality = 1")).collect()} == {1.0}


def test_long_texts_are_pooled_in_chunks(monkeypatch):
    model = quality.QualityModel(quality.QualityConfig(), context=np.ones((1, 32), dtype=np.float32))
    text = " ".join(f"w{k % 97}" for k in range(3000))
    whole = quality.features([text], 1, quality._Vocabulary(model))
    monkeypatch.setattr(quality, "_CHUNK", 100)
    assert np.allclose(whole, quality.features([text], 1, quality._Vocabulary(model)))


def test_vocabulary_grows_and_starts_anew(monkeypatch):
    monkeypatch.setattr(quality, "_KEPT", 90_000)
    vocabulary = quality._Vocabulary(quality.QualityModel(quality.QualityConfig()))
    for start in (0, 60_000, 120_000):
        words = [f"w{k}" for k in range(start, start + 60_000)]
        ids = vocabulary.ids(words)
        assert (vocabulary.index[ids[[0, -1]]] == quality.index_vectors([words[0], words[-1]], 32, 4, 5)).all()
        assert len(vocabulary.at) <= 150_000
    many = iter([pa.RecordBatch.from_arrays([pa.array([" ".join(f"x{k}" for k in range(70_000)), None])], ["text"])])
    out = list(quality._contexts(quality.QualityConfig())(many))
    assert out[0].num_rows > 70_000


LANGS = {
    "aa": "the ing tion ther with", "ab": "the und ein ich sch", "ba": "que ment eaux oui leur", "bb": "que cion ado ista los",
}


def language_docs(spark, n=400):
    rnd = random.Random(3)
    rows = []
    for k in range(n):
        lang = sorted(LANGS)[k % 4]
        parts = LANGS[lang].split()
        rows.append((k, " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(8, 60))), lang if k % 11 else None))
    rows += [(900, None, "aa"), (901, "123 !?  ", "aa"), (None, "the with thering", "aa"), (902, "", None), (1, rows[1][1], rows[1][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("mine"))


def test_languages_on_held_out_documents(spark):
    docs = language_docs(spark)
    got = langid.judge(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert {by_id[k].lang_pred for k in (900, 901, 902)} == {"und"}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert held and np.mean([r.lang_pred == sorted(LANGS)[r.doc_id % 4] for r in held]) > 0.95


def test_families_are_found():
    means = np.array([[1, 0.1, 0], [0.1, 0, 1], [1, 0, 0.1], [0, 0.1, 1]])
    assert langid.families(means).tolist() in ([0, 1, 0, 1], [1, 0, 1, 0])


def test_counts_do_not_depend_on_the_chunks(monkeypatch):
    text = "Straße, ÉTÉ 42 and ñandú! " * 40
    whole = langid._counts(text, 512)
    for size in (7, 64, 100):
        monkeypatch.setattr(langid, "_CHUNK", size)
        assert (langid._counts(text, 512) == whole).all()
    assert langid._counts("12 !", 64) is None


def test_language_edge_tables(spark):
    docs = language_docs(spark, 40)
    assert langid.judge(docs.where("false")).collect() == []
    assert {r.lang_pred for r in langid.judge(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    one = {r.lang_pred for r in langid.judge(docs.withColumn("lang", F.lit("zz"))).collect()}
    assert one == {"zz", "und"}


def many_languages(spark, n=230, each=10):
    """``n`` languages, the rarest last, with words of their own letters."""
    rnd, rows = random.Random(6), []
    for k in range(n):
        own = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(5)]
        for _ in range(each + (k < 200)):
            rows.append((len(rows), " ".join("".join(rnd.choice(own) for _ in range(2)) for _ in range(40)), f"l{k:03}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_every_language_is_learned(spark):
    """More than 200 languages, with shards and blocks that split them."""
    docs = many_languages(spark)
    config = langid.LanguageConfig(dim=512, rounds=30, shard_rows=900, block=4)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.judge(docs, config).collect()
    assert {r.lang_pred for r in got} == set(truth.values())
    rare = [r for r in got if r.held_out and truth[r.doc_id] >= "l200"]
    assert rare and np.mean([r.lang_pred == truth[r.doc_id] for r in rare]) > 0.9


def test_families_stay_small_and_merge_the_nearest():
    rng = np.random.default_rng(2)
    near = 1 + 0.01 * rng.random((300, 20))  # all alike
    assert max(np.bincount(langid.families(near))) <= 2 * np.ceil(np.sqrt(300))
    for n in (5, 12, 30):
        means = rng.random((n, 6))
        unit = means / np.linalg.norm(means, axis=1, keepdims=True)
        most, groups = max(4, 2 * np.ceil(np.sqrt(n))), [[k] for k in range(n)]
        while len(groups) > round(np.sqrt(n)):
            fits = [(a, b) for a in range(len(groups)) for b in range(a + 1, len(groups)) if len(groups[a]) + len(groups[b]) <= most]
            if not fits:
                break
            a, b = max(fits, key=lambda p: (unit @ unit.T)[np.ix_(groups[p[0]], groups[p[1]])].mean())
            groups[a] += groups.pop(b)
        found = langid.families(means)
        assert sorted(np.flatnonzero(found == f).tolist() for f in range(found.max() + 1)) == sorted(map(sorted, groups))
