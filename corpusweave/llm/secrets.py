"""Secret scan: fixed patterns, then a ratio of two character Markov models.

The patterns find keyed assignments, access keys and long hex runs. The models
find what the patterns cannot name: runs of key characters that look more like a
random string than like an ordinary identifier. A run that touches a pattern's
span is judged without it, and a run that is ordinary as a whole by its parts
between / _ = - as well. Both models hold transition
probabilities between the symbols of ``ALPHABET``; they are trained on labelled
samples, by default the values that the patterns found in all documents (random)
and the words of these (ordinary). A model has ``len(ALPHABET) ** 2`` entries, so it is
a literal of fixed size in the scan, which reads each text once and moves none.

Positions are code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.binding import let
from corpusweave.session import written

# The base patterns, in the order in which ties are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# An ordinary identifier: letters, joined by single marks, with nothing of the alphabet around it.
_WORD = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z_-]{4})[A-Za-z]+(?:[_-][A-Za-z]+)*(?![A-Za-z0-9+/_=-])"
# A part of a run between / _ = -.
_PART = "[A-Za-z0-9+]{%d,}"
SPAN = "struct<start:int,kind:int,end:int>"
_BLOCK = 512
_PIECE = 4096


@dataclass(frozen=True)
class SecretConfig:
    """``min_value``: shortest value of an assignment. ``min_run``: shortest run
    the models judge. ``min_ratio``: mean log ratio per transition from which a
    run counts as random. ``uniform``: share of the uniform distribution in the
    random model, ``floor`` in the ordinary one. ``lean``: weight of a symbol's
    own frequency against the transitions seen.
    """

    min_value: int = 6
    min_run: int = 20
    min_ratio: float = 0.5
    uniform: float = 0.5
    floor: float = 0.02
    lean: float = 4.0


def _emitted(xs: Column, state: dict[str, Column], step) -> Column:
    """Spans that a pass over the array ``xs`` gives out, in its order.

    ``step(state, x)`` is the next state, whether a span is given out, and that
    span. The pass goes in blocks, so giving out very many stays cheap.
    """
    nothing = F.array().cast(f"array<{SPAN}>")

    def packed(values, out):
        return F.struct(*(values[k].alias(k) for k in state), out.alias("out"))

    def one(acc, x):
        new, some, span = step(acc, x)
        return packed(new, F.when(some, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]))

    def block(acc, part):
        inner = F.aggregate(part, packed(acc, nothing), one)
        return let(inner, lambda i: packed(i, F.concat(acc["out"], i["out"])))

    blocks = F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(_BLOCK)), lambda k: F.slice(xs, k, _BLOCK))
    return F.aggregate(blocks, packed(state, nothing), block)["out"]


def _matches(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches: lengths of the gaps
    between matches and of the matches add up to positions."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    found = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda m: F.struct(F.length(m).alias("n"), (keep(m) if keep else F.lit(True)).alias("keep")),
    )

    def step(acc, x):
        start = acc["at"] + x["gaps"]
        end = start + x["found"]["n"]
        return {"at": end}, x["found"]["keep"], F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))

    pairs = let(found, lambda f: F.arrays_zip(F.slice(gaps, 1, F.size(f)).alias("gaps"), f.alias("found")))
    spans = let(pairs, lambda xs: _emitted(xs, {"at": F.lit(0)}, step))
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _long_enough(match: Column, config: SecretConfig) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 2)) >= config.min_value


def base_spans(text: Column, config: SecretConfig = SecretConfig()) -> Column:
    """Pattern spans by (start, kind). A run that a bounded pattern accepts is
    the whole run: it starts at the run's first possible character."""
    return F.array_sort(F.concat(
        _matches(text, ASSIGN, 0, lambda m: _long_enough(m, config)), _matches(text, ACCESS, 1), _matches(text, HEX, 2)
    ))


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(3).alias("kind"), end.alias("end"))


def _rests(base: Column, runs: Column, shortest: int) -> Column:
    """What the pattern spans leave of the runs: pieces of ``shortest`` or more.

    One pass over both, by start: ``at`` is the first place of the open run that
    no pattern span holds, ``end`` the run's end, ``free`` the end of the pattern
    spans so far.
    """
    beyond = F.lit(2**31 - 1)

    def step(acc, x):
        run, stop = x["kind"] == 3, F.least(x["start"], acc["end"])
        new = {
            "at": F.when(run, F.greatest(x["start"], acc["free"])).otherwise(F.greatest(acc["at"], x["end"])),
            "end": F.when(run, x["end"]).otherwise(acc["end"]),
            "free": F.when(run, acc["free"]).otherwise(F.greatest(acc["free"], x["end"])),
        }
        return new, stop - acc["at"] >= shortest, _span(acc["at"], stop)

    ordered = F.array_append(F.array_sort(F.concat(base, runs)), _span(beyond, beyond))
    rests = let(ordered, lambda xs: _emitted(xs, {"at": F.lit(0), "end": F.lit(0), "free": F.lit(0)}, step))
    return F.when(F.size(runs) > 0, rests).otherwise(F.array().cast(f"array<{SPAN}>"))


def _pieces(text: Column) -> Column:
    """A text in pieces of ``_PIECE`` characters. Counting characters from a long
    text's start for every span would take time in the square of its length."""
    return F.when(F.length(text) <= _PIECE, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % _PIECE), 0))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` up to ``end`` of a text in pieces."""
    first, last = F.floor(start / _PIECE).cast("int"), F.floor((end - 1) / _PIECE).cast("int")

    def part(k):
        begin = F.greatest(start - k * _PIECE, F.lit(0))
        return F.substring(F.element_at(pieces, k + 1), begin + 1, end - k * _PIECE - begin)

    return F.when(end > start, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise("")


def _run_pattern(shortest: int) -> str:
    return "[A-Za-z0-9+/_=-]{%d,}" % shortest


def labelled_samples(documents: DataFrame, config: SecretConfig = SecretConfig()) -> DataFrame:
    """``(token, secret)`` from every document: pattern values, and words of
    letters that no pattern touches, each once. Tasks drop repetitions before
    the tokens move."""
    text = F.col("text")
    found = [F.regexp_extract_all(text, F.lit(p), 0) for p in (ASSIGN, ACCESS, HEX)]
    found[0] = F.filter(found[0], lambda m: _long_enough(m, config))
    secrets = F.transform(F.concat(*found), lambda m: F.regexp_replace(m, r"^.*[\s:=\"']", ""))
    words = F.regexp_extract_all(F.regexp_replace(text, ASSIGN + "|" + ACCESS + "|" + HEX, " "), F.lit(_WORD), 0)
    # Strings are told apart by hash, structs one by one.
    labelled = F.concat(
        F.transform(F.array_distinct(secrets), lambda t: F.struct(t.alias("token"), F.lit(True).alias("secret"))),
        F.transform(F.array_distinct(words), lambda t: F.struct(t.alias("token"), F.lit(False).alias("secret"))),
    )
    return documents.select(F.inline(labelled)).distinct()


def _codes(token: Column) -> Column:
    """Places in ``ALPHABET``, -1 for other characters; the token is cut up once."""
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def train(samples: DataFrame, config: SecretConfig = SecretConfig()) -> list[float]:
    """Log ratio of every transition, row by row of ``ALPHABET``.

    Tokens with other characters contribute the transitions they have; nulls
    none. A class without samples leaves its model uniform. At most
    ``len(ALPHABET) ** 2`` sums come to the driver.
    """
    size = len(ALPHABET)
    pairs = samples.where(F.length("token") > 1).select("secret", F.explode(F.array(_codes(F.col("token")))).alias("c"))
    pairs = pairs.select("secret", F.explode(F.transform(
        F.sequence(F.lit(2), F.size("c")), lambda i: F.struct(F.element_at("c", i - 1).alias("a"), F.element_at("c", i).alias("b"))
    )).alias("p")).where("p.a >= 0 and p.b >= 0")
    counts = pairs.groupBy("p.a", "p.b").agg(
        F.sum(F.col("secret").cast("long")).alias("yes"), F.sum((~F.col("secret")).cast("long")).alias("no")
    )
    grid = samples.sparkSession.range(size * size).select(
        F.expr(f"int(id / {size})").alias("a"), (F.col("id") % size).cast("int").alias("b")
    )
    filled = written(grid.join(F.broadcast(counts), ["a", "b"], "left").fillna(0), "secret-counts")
    rows = filled.groupBy("a").agg(F.sum("yes").alias("yes_a"), F.sum("no").alias("no_a"))
    single = filled.groupBy("b").agg(F.sum("yes").alias("yes_b"), F.sum("no").alias("no_b"))
    total = filled.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).first()

    def mixed(label, share):
        """Transitions lean on the symbol's own frequency, and that on the uniform distribution."""
        alone = (F.col(f"{label}_b") + 1) / F.lit(float(total[label] + size))
        known = (F.col(label) + config.lean * alone) / (F.col(f"{label}_a") + config.lean)
        return (1 - share) * known + share / size

    ratio = F.log(mixed("yes", config.uniform)) - F.log(mixed("no", config.floor))
    out = filled.join(F.broadcast(rows), "a").join(F.broadcast(single), "b").select("a", "b", ratio.alias("r")).orderBy("a", "b")
    return [row["r"] for row in out.collect()]


def _ratio(token: Column, model: list[float]) -> Column:
    """Mean log ratio per transition of a run of ``ALPHABET``."""
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(f"{r:.6f}" for r in model)), ",").cast("array<double>")
    total = let(_codes(token), lambda c: F.aggregate(
        F.sequence(F.lit(2), F.size(c)), F.lit(0.0),
        lambda acc, i: acc + F.element_at(table, F.element_at(c, i - 1) * size + F.element_at(c, i) + 1),
    ))
    return total / (F.length(token) - 1)


def scan(documents: DataFrame, model: list[float], config: SecretConfig = SecretConfig()) -> DataFrame:
    """``row, base, spans``: the document as a struct, and arrays of (start, kind, end).

    ``spans`` are the pattern spans and what the models add in the runs beside
    them: what is left of a run without its pattern spans, or else the parts of
    that between / _ = - that look random by themselves. Null texts are read as
    empty and have none.
    """
    text = F.coalesce("text", F.lit(""))
    runs = _matches(text, _run_pattern(config.min_run), 3)
    found = F.explode(F.array(F.struct(base_spans(text, config).alias("base"), runs.alias("runs")))).alias("found")
    rows = documents.select(F.struct("*").alias("row"), found)
    base, text = F.col("found.base"), F.col("row.text")
    random = lambda token: _ratio(token, model) >= config.min_ratio

    def judged(pieces, rest):
        """A rest of a run, or its random parts."""
        def parts(cut):
            inner = _pieces(cut)
            found = let(inner, lambda ps: F.filter(
                _matches(cut, _PART % config.min_run, 3), lambda p: random(_between(ps, p["start"], p["end"]))
            ))
            return F.transform(found, lambda p: _span(rest["start"] + p["start"], rest["start"] + p["end"]))

        cut = _between(pieces, rest["start"], rest["end"])
        return let(cut, lambda c: F.when(random(c), F.array(_span(rest["start"], rest["end"]))).otherwise(parts(c)))

    rests = _rests(base, F.col("found.runs"), config.min_run)
    nothing = F.array().cast(f"array<{SPAN}>")
    added = let(rests, lambda xs: F.when(
        F.size(xs) > 0, let(_pieces(text), lambda ps: F.flatten(F.transform(xs, lambda x: judged(ps, x))))
    ).otherwise(nothing))
    return rows.select("row", base.alias("base"), F.explode(F.array(F.array_sort(F.concat(base, added)))).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, in the order of the array."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def find_secrets(documents: DataFrame, config: SecretConfig = SecretConfig()) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans
    and all spans. Repeated rows and null doc_ids stay; extra columns go."""
    docs = documents.select("doc_id", "text")
    model = train(labelled_samples(docs, config), config)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return scan(docs, model, config).select(
        "row.doc_id", count(0), count(1), count(2), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redact(documents: DataFrame, config: SecretConfig = SecretConfig(), mark: str = "[secret]") -> DataFrame:
    """``documents`` with each secret replaced by ``mark``; overlapping spans
    become one. ``n_chars`` follows where it is a column. Texts without a secret
    are unchanged, null ones stay null."""
    model = train(labelled_samples(documents.select("doc_id", "text"), config), config)
    text, some = F.col("row.text"), F.size("spans") > 0
    # One pass over the spans: the text before each that does not begin inside an earlier one.
    def step(acc, x):
        gap = F.struct(acc["at"].alias("start"), F.lit(3).alias("kind"), x["start"].alias("end"))
        return {"at": F.greatest(acc["at"], x["end"])}, x["start"] >= acc["at"], gap

    def joined(pieces):
        gaps = _emitted(F.col("spans"), {"at": F.lit(0)}, step)
        kept = F.transform(gaps, lambda g: F.concat(_between(pieces, g["start"], g["end"]), F.lit(mark)))
        tail = F.array_max(F.transform("spans", lambda x: x["end"]))
        return F.concat(F.array_join(kept, ""), _between(pieces, tail, F.length(text)))

    clean = F.when(some, let(_pieces(text), joined)).otherwise(text)
    rows = scan(documents, model, config).select("row", some.alias("some"), F.explode(F.array(clean)).alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(F.col("some"), F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))
    return rows.select(*((new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in documents.columns))
