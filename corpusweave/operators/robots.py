"""Robots files as tables: rules, decisions and delays.

Two readings of the same text exist on purpose. The rule reading ends a group
at an empty raw line; the delay reading also at a line that is blank once its
comment is cut off. A file is one row, so windows hold one file's lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusweave.functions import urls as U
from corpusweave.functions.binding import let

# Line breaks of the text format, numeric delays, rule keys.
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
RULE_KEYS = ("allow", "disallow", "crawl-delay", "request-rate")
DELAY_RULE_KEYS = ("allow", "disallow", "crawl-delay")
BLOCK_REASON = "Blocked by robots.txt for user-agent "


def robots_source(urls: DataFrame, robots: DataFrame) -> DataFrame:
    """One row per base URL of the requested URLs with its robots text, if the
    fetch succeeded (status known and below 400)."""
    bases = urls.select(U.base_url(F.col("url")).alias("base_url")).distinct()
    once = robots.groupBy("base_url").agg(F.min(F.struct("status", "body")).alias("r"))
    joined = bases.join(once, "base_url", "left")
    ok = F.coalesce(F.col("r.body").isNotNull() & (F.col("r.status") < 400), F.lit(False))
    return joined.select(
        "base_url",
        F.concat("base_url", F.lit("/robots.txt")).alias("robots_url"),
        ok.alias("available"),
        F.when(ok, F.col("r.body")).alias("body"),
    )


def _lines(source: DataFrame) -> DataFrame:
    available = source.where("available").select("base_url", F.posexplode(F.split("body", LINE_BREAK)).alias("line_no", "raw"))
    text = U.strip(F.regexp_replace("raw", r"(?s)#.*$", ""))
    colon = F.instr(text, ":")
    return available.select(
        "base_url",
        "line_no",
        (F.col("raw") == "").alias("empty"),
        (text == "").alias("blank"),
        F.when(colon > 0, F.lower(U.strip(F.substr(text, F.lit(1), colon - 1)))).alias("key"),
        F.when(colon > 0, U.strip(F.substr(text, colon + 1))).alias("value"),
    )


def _grouped(lines: DataFrame, ends_group: Column, rule_keys: tuple[str, ...]) -> DataFrame:
    """Number the agent groups and mark the rule lines inside one."""
    kind = (
        F.when(ends_group, "end")
        .when(F.col("key") == "user-agent", "agent")
        .when(F.col("key").isin(*rule_keys), "rule")
    )
    marked = lines.withColumn("kind", kind).where(F.col("kind").isNotNull())
    w = W.partitionBy("base_url").orderBy("line_no")
    opens = (F.col("kind") == "agent") & (F.coalesce(F.lag("kind").over(w), F.lit("end")) != "agent")
    running = w.rowsBetween(W.unboundedPreceding, 0)
    scope = F.last(F.when(F.col("kind") != "rule", F.col("kind")), ignorenulls=True).over(running)
    numbered = marked.withColumn("opens", opens.cast("int")).withColumn("scope", scope)
    numbered = numbered.withColumn("group_no", F.sum("opens").over(running).cast("int"))
    return numbered.where((F.col("kind") == "agent") | ((F.col("kind") == "rule") & (F.col("scope") == "agent")))


def _rule_path(value: Column) -> Column:
    decoded = U.unquote(value)
    return F.regexp_replace(F.regexp_replace(decoded, "#$", ""), r"^([^?#]*)\?(?=#|$)", "$1")


def robots_groups(source: DataFrame) -> DataFrame:
    """(base_url, group_no, agents, is_default, rules) of every group in force.

    A group without any rule line is void, and so is every default group after
    the first. An empty path always allows.
    """
    rows = _grouped(_lines(source), F.col("empty"), RULE_KEYS)
    rule_no = F.col("line_no")
    path = _rule_path(F.col("value"))
    rule = F.when(
        F.col("key").isin("allow", "disallow"),
        F.struct(rule_no.alias("line_no"), ((F.col("key") == "allow") | (path == "")).alias("allow"), path.alias("path")),
    )
    agent = F.when(F.col("kind") == "agent", F.struct("line_no", U.unquote(F.col("value")).alias("agent")))
    groups = rows.groupBy("base_url", "group_no").agg(
        F.transform(F.array_sort(F.collect_list(agent)), lambda a: a["agent"]).alias("agents"),
        F.array_sort(F.collect_list(rule)).alias("rules"),
        F.max((F.col("kind") == "rule").cast("int")).alias("has_rule"),
    )
    groups = groups.where("has_rule = 1").withColumn("is_default", F.array_contains("agents", "*"))
    first_default = F.min(F.when(F.col("is_default"), F.col("group_no"))).over(W.partitionBy("base_url"))
    kept = groups.withColumn("_first", first_default).where(~F.col("is_default") | (F.col("group_no") == F.col("_first")))
    return kept.select("base_url", "group_no", "agents", "is_default", "rules")


def robots_rules(source: DataFrame) -> DataFrame:
    """Flat rule table, agents joined by a comma."""
    groups = robots_groups(source)
    return groups.select(
        "base_url", "group_no", F.array_join("agents", ",").alias("agents"), "is_default",
        F.posexplode("rules").alias("rule_no", "rule"),
    ).select("base_url", "group_no", "agents", "is_default", "rule_no", F.col("rule.allow").alias("allow"), F.col("rule.path").alias("path"))


def rules_for_agent(source: DataFrame, user_agent: str) -> DataFrame:
    """(base_url, rules): the rule list that binds one user agent per site."""
    token = user_agent.split("/")[0].lower()
    named = F.exists("agents", lambda a: F.lit(token).contains(F.lower(a)))
    ranked = robots_groups(source).where(F.col("is_default") | named)
    return ranked.groupBy("base_url").agg(F.min_by("rules", F.struct("is_default", "group_no")).alias("rules"))


def _request_target(url: Column) -> Column:
    rest = F.regexp_replace(U.unquote(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", "")
    target = F.regexp_replace(F.regexp_replace(rest, "#$", ""), r"^([^?#]*)\?(?=#|$)", "$1")
    return F.when(target == "", "/").otherwise(target)


def with_verdict(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``allowed`` under a table of ``rules_for_agent``. The first rule whose
    path is a prefix decides; a site without rules allows. One joined row per
    URL: the site's rules come as an array, so a busy site does not multiply
    its URLs by its rules."""
    by_site = rules.withColumnRenamed("base_url", "_base")
    keyed = urls.withColumn("_base", U.base_url(F.col("url")))
    target = _request_target(F.col("url"))
    hits = let(target, lambda t: F.filter("rules", lambda r: F.startswith(t, r["path"])))
    verdict = F.coalesce(F.try_element_at(hits, F.lit(1))["allow"], F.lit(True))
    allowed = F.when(F.size("rules") > 0, verdict).otherwise(True)
    return keyed.join(by_site, "_base", "left").withColumn("allowed", allowed).drop("_base", "rules")


def with_allowed(urls: DataFrame, source: DataFrame, user_agent: str) -> DataFrame:
    return with_verdict(urls, rules_for_agent(source, user_agent))


def robots_blocked(urls: DataFrame, source: DataFrame, user_agent: str, respect_robots: bool = True) -> DataFrame:
    if not respect_robots:
        return urls.select("url", F.lit("").alias("reason")).where(F.lit(False))
    return with_allowed(urls, source, user_agent).where(~F.col("allowed")).select(
        "url", F.lit(BLOCK_REASON + user_agent).alias("reason")
    )


def robots_delays(source: DataFrame) -> DataFrame:
    """(base_url, agent, position, delay): a later value for an agent replaces
    the earlier one, which keeps its first position."""
    rows = _grouped(_lines(source), F.col("blank"), DELAY_RULE_KEYS)
    number = F.when(F.col("value").rlike(NUMBER), F.col("value").try_cast("double"))
    delay = F.when((F.col("key") == "crawl-delay") & (number >= 0), number)
    agent = F.when((F.col("kind") == "agent") & (F.col("value") != ""), F.struct("line_no", F.lower("value").alias("agent")))
    groups = rows.withColumn("_delay", delay).groupBy("base_url", "group_no").agg(
        F.collect_list(agent).alias("agents"),
        F.min(F.when(F.col("_delay").isNotNull(), F.col("line_no"))).alias("first_line"),
        F.max_by("_delay", F.when(F.col("_delay").isNotNull(), F.col("line_no"))).alias("delay"),
    )
    each = groups.where(F.col("first_line").isNotNull()).select(
        "base_url", "group_no", "first_line", "delay", F.explode("agents").alias("a")
    )
    merged = each.groupBy("base_url", F.col("a.agent").alias("agent")).agg(
        F.min(F.struct("first_line", "a.line_no")).alias("at"), F.max_by("delay", "group_no").alias("delay")
    )
    position = F.row_number().over(W.partitionBy("base_url").orderBy("at")) - 1
    return merged.select("base_url", "agent", position.alias("position"), "delay")


def delay_for_agent(source: DataFrame, user_agent: str) -> DataFrame:
    """(base_url, delay) for every site of ``source``; 0.0 where none applies."""
    agent = user_agent.lower()
    rank = (
        F.when(F.col("agent") == agent, 0)
        .when((F.col("agent") != "*") & F.lit(agent).contains(F.col("agent")), 1)
        .when(F.col("agent") == "*", 2)
    )
    fitting = robots_delays(source).withColumn("_rank", rank).where(F.col("_rank").isNotNull())
    chosen = fitting.groupBy("base_url").agg(F.min_by("delay", F.struct("_rank", "position")).alias("delay"))
    return source.select("base_url").join(chosen, "base_url", "left").select("base_url", F.coalesce("delay", F.lit(0.0)).alias("delay"))
