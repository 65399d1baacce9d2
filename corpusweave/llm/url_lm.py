"""URL filter: host rules, and for the rest a ratio of two character models.

Accepted and rejected URLs each train a smoothed variable-order Markov model
over characters: contexts of two characters, backing off to one and to none by
Witten-Bell weights, so that a context never seen leaves the decision to the
shorter one. A URL's score is the mean over its characters of the difference of
log-likelihoods. The cut lies where the scores of the two labelled classes
separate best under equal priors (middle of their means, in units of their
deviations).

All characters fall into ``SYMBOLS`` plus one class for any other and one for
the start, so a model has at most ``CLASSES ** 3`` entries however large the
corpus: that bound allows broadcasting it. Scoring explodes characters and sums
them again before anything is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.binding import let
from corpusweave.session import written

SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789./:-_?=&#%"
CLASSES = len(SYMBOLS) + 2  # other characters are 0, the start is the last
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lowered; else empty."""
    found = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host_: Column, path_: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits (the first listed among equals), null where none does."""
    chosen = F.lit(None)
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host_ == r.host) | F.endswith(host_, F.lit("." + r.host))) & F.startswith(path_, F.lit(r.path))
        chosen = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen.cast("struct<rule:string,verdict:string>")


def _trigrams(url: Column) -> Column:
    """One number per character: its class and those of the two before it."""
    chars = F.split(F.translate(url, UPPER, LOWER), "")
    codes = F.transform(chars, lambda c: F.instr(F.lit(SYMBOLS), c))
    start = F.lit(CLASSES - 1)
    padded = F.concat(F.array(start, start), codes)
    return F.when(F.length(url) > 0, let(padded, lambda p: F.transform(
        F.sequence(F.lit(3), F.size(p)),
        lambda i: (F.element_at(p, i - 2) * CLASSES + F.element_at(p, i - 1)) * CLASSES + F.element_at(p, i),
    )))


def _grams(pages: DataFrame) -> DataFrame:
    """Rows of pages, one for each character; a URL without any keeps one row."""
    bound = pages.select("page_id", "url", F.explode(F.array(_trigrams(F.col("url")))).alias("_codes"))
    return bound.select("page_id", "url", F.posexplode_outer("_codes").alias("_i", "_code"))


def _witten_bell(counts: DataFrame, label: str) -> DataFrame:
    """Log probability ``lp_<label>`` of every trigram code under the counts ``n_<label>``."""
    spark = counts.sparkSession
    n = F.col(f"n_{label}")
    last, pair = (F.col("_code") % CLASSES).alias("_c"), (F.col("_code") % (CLASSES * CLASSES)).alias("_pair")
    before1, before2 = F.expr(f"int(_code / {CLASSES}) % {CLASSES}").alias("_b1"), F.expr(f"int(_code / {CLASSES})").alias("_b2")
    seen = counts.where(n > 0)
    total = seen.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    ones = seen.groupBy(last).agg(F.sum(n).alias("_n1"))
    twos = seen.groupBy(pair).agg(F.sum(n).alias("_n2"))
    ctx1 = seen.groupBy(before1).agg(F.sum(n).alias("_d1"), F.countDistinct(last).alias("_t1"))
    ctx2 = seen.groupBy(before2).agg(F.sum(n).alias("_d2"), F.count("*").alias("_t2"))
    grid = spark.range(CLASSES**3).select(F.col("id").cast("int").alias("_code"))
    grid = grid.select("_code", last, pair, before1, before2)
    for table, key in ((ones, "_c"), (twos, "_pair"), (ctx1, "_b1"), (ctx2, "_b2"), (seen.select("_code", n.alias("_n3")), "_code")):
        grid = grid.join(F.broadcast(table), key, "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    p1 = (z("_n1") + 1) / F.lit(float(total + CLASSES))
    p2 = F.when(z("_d1") > 0, (z("_n2") + z("_t1") * p1) / (z("_d1") + z("_t1"))).otherwise(p1)
    p3 = F.when(z("_d2") > 0, (z("_n3") + z("_t2") * p2) / (z("_d2") + z("_t2"))).otherwise(p2)
    return grid.select("_code", F.log(p3).alias(f"lp_{label}"))


def train(labelled: DataFrame) -> DataFrame:
    """``(_code, ratio)`` for every trigram code, from ``labelled(url, accepted)``.

    Rows with a null url or label count for neither model. Every labelled URL
    is counted.
    """
    keyed = labelled.where(F.col("accepted").isNotNull()).select(F.col("accepted").alias("page_id"), "url")
    counts = _grams(keyed).where(F.col("_code").isNotNull()).groupBy("_code").agg(
        F.sum(F.col("page_id").cast("long")).alias("n_yes"), F.sum((~F.col("page_id")).cast("long")).alias("n_no")
    )
    counts = written(counts, "url-counts")
    both = _witten_bell(counts, "yes").join(F.broadcast(_witten_bell(counts, "no")), "_code")
    return written(both.select("_code", (F.col("lp_yes") - F.col("lp_no")).alias("ratio")), "url-model")


def scored(pages: DataFrame, model: DataFrame) -> DataFrame:
    """Pages as ``(page_id, url, score)``; score is null for a URL without characters."""
    grams = _grams(pages.select("page_id", "url")).join(F.broadcast(model), "_code", "left")
    # The characters of a page are next to each other: they are summed before the shuffle.
    sums = grams.groupBy("page_id", "url").agg(
        F.avg("ratio").alias("score"), F.sum((F.coalesce("_i", F.lit(0)) == 0).cast("int")).alias("_rows")
    )
    return sums.select("page_id", "url", "score", F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int")))).drop("col")


def judge(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, score`` of every row of pages.

    Rules decide where one fits and label the URLs that train the two models;
    elsewhere the calibrated ratio decides. Without labelled URLs of both kinds,
    and for a null or empty url, nothing speaks against a page: it is allowed.
    Repeated rows stay.
    """
    u = F.col("url")
    pages = pages.select("page_id", "url")
    ruled = F.explode(F.array(rule_for(host(u), path(u), rules))).alias("_rule")
    labelled = pages.select("url", ruled).where(F.col("_rule").isNotNull())
    model = train(labelled.select("url", (F.col("_rule.verdict") == "allow").alias("accepted")))
    scores = written(scored(pages, model).select("page_id", "url", "score", ruled), "url-scores")
    cut = _cut(scores)
    by_model = F.when(F.col("score") < F.lit(cut), "block").otherwise("allow") if cut is not None else F.lit("allow")
    return scores.select(
        "page_id", "url", host(u).alias("host"), path(u).alias("path"), F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", by_model).alias("verdict"), "score",
    )


def _cut(scores: DataFrame) -> float | None:
    """Where the two labelled classes are equally many deviations away."""
    yes = F.col("_rule.verdict") == "allow"
    no = F.col("_rule.verdict") == "block"
    row = scores.agg(
        F.avg(F.when(yes, F.col("score"))), F.stddev_pop(F.when(yes, F.col("score"))),
        F.avg(F.when(no, F.col("score"))), F.stddev_pop(F.when(no, F.col("score"))),
    ).first()
    if row[0] is None or row[2] is None:
        return None
    good, good_sd, bad, bad_sd = row
    if good_sd + bad_sd == 0:
        return (good + bad) / 2
    return (good * bad_sd + bad * good_sd) / (good_sd + bad_sd)
