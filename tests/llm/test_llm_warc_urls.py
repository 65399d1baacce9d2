import gzip
import hashlib
import io
import os

import pytest

from corpusweave.llm import url_lm, warc

PAGES = "page_id long, url string, html string, digest string"
RULES = (
    url_lm.Rule("allow", "org", "/"), url_lm.Rule("block", "example.org", "/es/"), url_lm.Rule("block", "example.org", "/en/1"),
    url_lm.Rule("allow", "com", "/fr/"), url_lm.Rule("block", "com", "/de/"),
)


def pages(spark):
    rows = [(k, f"https://h{k % 5}.org/{k}", "x" * (50 + k % 120), "mine") for k in range(600)]
    rows += [(1000 + k, None, "hot" * 60, None) for k in range(300)]
    rows += [(9, "http://a/\r\nX: y", None, None), (9, "http://a/\r\nX: y", None, None), (None, "http://n/", "hot" * 60, None), (2000, "u", "", None)]
    rows += [(3000, "long", "\u00e9" * 3_000_000, None), (1000, "again", "hot" * 60, None)]
    return spark.createDataFrame(rows, PAGES), rows


def expected(rows):
    first = {}
    for page_id, _, html, _ in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page_id is not None:
            first[body] = min(first.get(body, page_id), page_id)
    out = []
    for page_id, _, html, _ in rows:
        body = (html or "").encode()
        to = first.get(body)
        revisit = to is not None and to != page_id
        out.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_archive_round_trip(spark, tmp_path):
    df, rows = pages(spark)
    config = warc.WarcConfig(roll_bytes=2000, shard_bytes=20_000)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    warc.write_archive(df, one, config)
    got = warc.read_archive(spark, one)
    found = sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    assert found == expected(rows)
    # Other splits of the same pages give the same bytes.
    warc.write_archive(df.repartition(7, "url"), two, config)
    names = sorted(r.file for r in warc.manifest(spark, one).collect())
    assert len(names) > 5
    read = lambda d: {n: open(os.path.join(d, n), "rb").read() for n in sorted(os.listdir(d)) if n.endswith(".gz")}
    assert read(one) == read(two)
    assert sorted(read(one)) == names  # nothing temporary is left
    for name, data in read(one).items():
        records = list(warc.parse_records(io.BytesIO(data)))
        assert len(gzip.decompress(data)) and all("\r" not in v and "\n" not in v for h, _ in records for v in h.values()), name


def test_uncommitted_and_damaged_files(spark, tmp_path):
    df, _ = pages(spark)
    folder = str(tmp_path / "a")
    warc.write_archive(df.where("page_id < 20"), folder)
    (tmp_path / "a" / "warc-stray.warc.gz").write_bytes(b"not listed")
    assert warc.read_archive(spark, folder).count() == 22
    name = warc.manifest(spark, folder).first().file
    with open(os.path.join(folder, name), "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="manifest"):
        warc.read_archive(spark, folder).count()


def test_empty_archive(spark, tmp_path):
    df, _ = pages(spark)
    warc.write_archive(df.where("false"), str(tmp_path / "e"))
    assert warc.read_archive(spark, str(tmp_path / "e"), payloads=True).collect() == []


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text), default=None)
    return (best.text, best.verdict) if best else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG", "http://EXAMPLE.org/es/x", "https://a.example.org/en/12?q=/es/", "http://org/",
    "http://notexample.org/es/", "http://shop.com/fr/a://b", "http://x.com/de/1", "http://x.com/de", "ftp://x.net/fr/#y", "http://\u00c4.org/\u00e9",
    "http://x.org?/es/", "http://x.org#/", "http://u@h.com:80/de/", "mailto:a@b.com", "http://example.org/en/2", "HTTP://X.COM/FR/",
]


def test_rules_and_parts(spark):
    rows = [(k % 12, u) for k, u in enumerate(URLS + URLS[:6])]
    got = url_lm.judge(spark.createDataFrame(rows, "page_id long, url string"), RULES).collect()
    assert sorted((r.page_id, r.url or "~") for r in got) == sorted((p, u or "~") for p, u in rows)
    for r in got:
        host, path = parts(r.url)
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict in ("allow", "block") and verdict in (None, r.verdict)


def test_the_models_carry_what_the_rules_taught(spark):
    good = [f"http://site{k}.org/library/article-{k}" for k in range(200)]
    bad = [f"http://site{k}.com/de/casino-bonus-{k}" for k in range(200)]
    new = ["http://a.net/library/article-7", "http://b.net/de/casino-bonus-9"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(good + bad + new)], "page_id long, url string")
    got = {r.url: r.verdict for r in url_lm.judge(df, RULES).collect()}
    assert got[new[0]] == "allow" and got[new[1]] == "block"


def test_model_equals_a_sequential_one(spark):
    import math
    from collections import Counter

    labelled = [("ab/a", True), ("aab?", True), ("zzz\u00e9", False), ("az", False), (None, True), ("a", None)]
    model = {r._code: r.ratio for r in url_lm.train(spark.createDataFrame(labelled, "url string, accepted boolean")).collect()}
    n, logs = url_lm.CLASSES, []
    for label in (True, False):
        tri = Counter()
        for url, ok in labelled:
            if ok is label and url:
                codes = [n - 1, n - 1, *(url_lm.SYMBOLS.find(c) + 1 for c in url)]
                tri.update(zip(codes, codes[1:], codes[2:], strict=False))
        pairs, ones = Counter(), Counter()
        for (_, b, c), k in tri.items():
            pairs[b, c] += k
            ones[c] += k

        def p(a, b, c, tri=tri, pairs=pairs, ones=ones):
            low = (ones[c] + 1) / (sum(ones.values()) + n)
            for table, key in ((pairs, (b,)), (tri, (a, b))):
                near = {k: v for k, v in table.items() if k[:-1] == key}
                if near:
                    low = (near.get((*key, c), 0) + len(near) * low) / (sum(near.values()) + len(near))
            return low

        logs.append(p)
    for a, b, c in ((1, 1, 2), (n - 1, n - 1, 1), (26, 26, 0), (5, 6, 7), (1, 2, 38), (3, 1, 26)):
        assert model[(a * n + b) * n + c] == pytest.approx(math.log(logs[0](a, b, c) / logs[1](a, b, c)))


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, rule int, score string")
    assert url_lm.judge(df, RULES).collect() == []
