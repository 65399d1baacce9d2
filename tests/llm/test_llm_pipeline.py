"""The pipeline stage by stage against plain Python on the smallest tables."""

import os
import re
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from corpusweave.llm import mixing, quality, secrets, simhash  # noqa: E402
from corpusweave.session import written  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), name)
        out.append((name, before, docs))
    return out


def test_stage_names_and_columns(steps):
    assert [s[0] for s in steps] == ["quality", "dedup", "secrets", "mix", "tokens"]
    for name, before, after in steps[:-1]:
        assert after.columns == before.columns, name


def test_quality_keeps_what_it_scores_well(spark, steps):
    _, before, after = steps[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality.judge(before, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == good
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([truth[d] for d in good if d in truth]) > 0.95


def test_dedup_keeps_the_smallest_of_each_group(steps):
    _, before, after = steps[1]
    rows = sorted((r.doc_id, simhash.fingerprint(r.text) % (1 << 64)) for r in before.collect())
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if bin(a ^ rows[j][1]).count("1") <= 4 and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    assert {r.doc_id for r in after.collect()} == {rows[g][0] for g in set(group)}


def test_secrets_go_and_nothing_else_changes(steps):
    _, before, after = steps[2]
    old, new = ({r.doc_id: r for r in t.collect()} for t in (before, after))
    assert set(old) == set(new)
    spans = {r.doc_id: r.spans for r in secrets.find_secrets(before).collect()}
    for k, r in new.items():
        want, at = "", 0
        for _, a, e in sorted((s.split(":") for s in filter(None, spans[k].split(","))), key=lambda s: int(s[1])):
            if int(a) >= at:
                want, at = want + old[k].text[at : int(a)] + "[secret]", int(e)
            at = max(at, int(e))
        want += old[k].text[at:]
        assert r.text == want and r.n_chars == (len(want) if spans[k] else old[k].n_chars)
        assert not re.search(secrets.ACCESS + "|" + secrets.HEX, r.text)


def test_mix_takes_what_the_report_says(steps):
    _, before, after = steps[3]
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_report(before).collect() if r.size}
    counts = {r.doc_id: r["count"] for r in after.where(mixing.word_count(F.col("text")) > 0).groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in taken.items() if n}


def test_tokens_equal_the_library(steps):
    _, before, after = steps[4]
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    texts = {r.doc_id: r.text for r in before.collect()}
    assert after.count() == before.count()
    for r in after.collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


def test_stages_take_odd_and_empty_tables(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    rows = [(1, None, None, None, None, "a"), (None, "some plain words", "en", "s", 16, None), (2, "", "en", None, 0, "b"),
            (3, "word " * 30_000, "en", "s", 150_000, "c"), (3, "word " * 30_000, "en", "s", 150_000, "c")]
    for docs in (spark.createDataFrame(rows, columns), spark.createDataFrame([], columns)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "tokens" or out.columns == docs.columns
            assert docs.count() or out.count() == 0
            docs = written(out, name)
