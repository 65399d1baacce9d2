import random
from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from corpusweave.functions import urls as U

BASES = [
    "http://a/b/c/d;p?q", "http://a", "http://a/b/c/d/", "http://a/b", "https://Ex.com:80/A/../b?x#y", "http://u:p@h.org/x/y.html?k=v",
]
REFS = [
    "g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", ";x", "g;x", "g;x?y#s", "", ".", "./", "..", "../", "../g",
    "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "..g", "./../g", "./g/.", "g/./h", "g/../h", "a//b",
    "/a//b/../c", "http://x/../y", "HTTP://X/y?", "http:g", "https:g", "mailto:a", "x\ny", "/a/.b/c", "é/ü?ß",
]


def test_resolve_equals_standard_library(spark):
    rng = random.Random(1)
    parts = ["a", "..", ".", "b.c", "", "x;y", "d?e", "#f"]
    refs = REFS + ["/".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(300)]
    rows = [(b, r) for b in BASES for r in refs if not r.startswith("///")]
    got = spark.createDataFrame(rows, "b string, r string").select("b", "r", U.resolve(F.col("b"), F.col("r")).alias("o")).collect()
    wrong = [(x.b, x.r, x.o) for x in got if x.r.strip() == x.r and x.o != urldefrag(urljoin(x.b, x.r))[0]]
    assert [w for w in wrong if "//" not in w[1][:2] or w[1].startswith("//g")] == []


NORMALISED = [
    ("HTTPS://Dock.Example", "https://dock.example/"),
    ("\thttp://Dock.Example:81/Pier/;v=2?Z=1;2#end\n", "http://dock.example:81/Pier/?Z=1;2"),
    ("https://Me:Pw@Dock.Example/a;b/c;d", "https://me:pw@dock.example/a;b/c"),
    ("http://dock.example/?", "http://dock.example/"), ("http://dock.example/q?#f", "http://dock.example/q"),
    ("http://dock.example/q/", "http://dock.example/q/"), ("http://dock.example?x=1", "http://dock.example/?x=1"),
    ("http://dock.example/ø?å", "http://dock.example/ø?å"),
]


def test_normalised_urls_worked_by_hand(spark):
    df = spark.createDataFrame(NORMALISED, "u string, want string").select("want", U.normalize(F.col("u")).alias("got"))
    assert [r.got for r in df.collect()] == [want for _, want in NORMALISED]


def test_domain_validity_and_robots_url(spark):
    rows = [
        ("https://Quay.Example:444/a/b", True, "quay.example:444", "https://quay.example:444/robots.txt"),
        ("http://[2001:db8::5]/x", True, "[2001:db8::5]", "http://[2001:db8::5]/robots.txt"),
        ("https://u@Quay.Example?q", True, "u@quay.example", "https://u@quay.example/robots.txt"),
        ("  ", False, "", None), ("berth/7", False, "", "/robots.txt"), ("tel:+49", False, "", "tel:/robots.txt"),
        ("wss://quay.example/s", False, "quay.example", "wss://quay.example/robots.txt"), ("https:///only-path", False, "", None),
    ]
    df = spark.createDataFrame(rows, "u string, ok boolean, d string, r string")
    u = F.col("u")
    for row in df.select("*", U.is_web_url(U.clean(u)).alias("ok2"), U.domain(u).alias("d2"), U.robots_url(u).alias("r2"), U.domain_or_unknown(u).alias("d3")).collect():
        assert (row.ok2, row.d2) == (row.ok, row.d), row
        assert row.d3 == (row.d or "unknown")
        if row.r is not None:
            assert row.r2 == row.r


def test_unquote(spark):
    df = spark.createDataFrame([("/a%20b+c%zz%66",), ("plain",)], "u string").select(U.unquote(F.col("u")).alias("o"))
    assert [r.o for r in df.collect()] == ["/a b+c%zzf", "plain"]


def test_patterns_use_find_semantics(spark):
    df = spark.createDataFrame([("https://e.com/admin",), ("https://e.com/f.pdf",), ("https://e.com/a",)], "u string")
    got = [r.u for r in df.where(~U.matches_any(F.col("u"), (r"/admin", r"\.pdf$"))).collect()]
    assert got == ["https://e.com/a"]
