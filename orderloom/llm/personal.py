"""Personal data by weak supervision, all in Spark's own functions.

Patterns propose spans: strict ones, which always stay, and loose ones. Labelers vote on each span
(form, checksum, gazetteer, context, borders): yes, no or nothing. Expectation-maximisation over the
counts of all vote patterns estimates how reliable each labeler is and how likely each pattern is
personal data; these likelihoods train a logistic span classifier, compiled into one expression,
that decides on the loose spans. Only counts per pattern reach the driver: their number is bounded
by the votes, not by the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import columns_of, fresh, let, numbered, saved

# Kinds in the order of the result; spans that start together are listed in this order.
KINDS = ["email", "ip", "card", "phone", "national_id"]
BASE_KINDS = KINDS[:4]

_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
_AT, _DOT = r"[\[(](?:at|AT)[\])]", r"[\[(](?:dot|DOT)[\])]"
# Kind, pattern, and a pattern found in all its matches: texts without it are not searched.
# Matches begin only where a longer one could not have begun, and repetitions give nothing back, so
# the time is in proportion to the text.
GENERATORS = {
    "email": ("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++", "@"),
    "ip": ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"\."),
    "card": (
        "card",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
        "[0-9]",
    ),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+"),
    "plain_phone": (
        "phone",
        r"(?<![0-9+().-])(?<![0-9][ ])(?:\([0-9]{3}\)[ ]?|[0-9]{3}[-. ])"
        r"[0-9]{3}[-. ][0-9]{4}(?![0-9])",
        "[0-9]",
    ),
    "spelt_email": (
        "email",
        rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+[ ]?{_AT}[ ]?"
        rf"[{_HOST}]{{1,64}}+(?:[ ]?(?:{_DOT}|\.)[ ]?[{_HOST}]{{1,64}}+){{1,8}}",
        _AT,
    ),
    "national_id": ("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
}

# Fixed values of the labelers.
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu"]
CONTEXT = {
    "email": r"(?i)e-?mail|contact|write|correo|courriel|schreib",
    "ip": r"(?i)\bip\b|host|server|address|adresse|client",
    "card": r"(?i)card|visa|credit|carte|karte|tarjeta|pay",
    "phone": r"(?i)phone|\btel|call|mobile|fax|appel|anruf|llam",
    "national_id": r"(?i)ssn|social|security|insurance",
}
AGAINST = r"(?i)version|isbn|issn|order|invoice|\bno\.|build|release|figure|page|\bid\b|[#=/]\s*$"
VOTES = ["form", "check", "gazetteer", "context", "borders"]
BEFORE, AFTER = 30, 12


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass Luhn's test."""

    def add(total: Column, i: Column, d: Column) -> Column:
        one = F.substring(d, i, F.lit(1)).cast("int")
        twice = F.when(one > 4, one * 2 - 9).otherwise(one * 2)
        odd = F.pmod(F.length(d) - i, F.lit(2)) == 1
        return total + F.when(odd, twice).otherwise(one)

    return let(
        _digits(value),
        lambda d: F.pmod(
            F.aggregate(
                F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))),
                F.lit(0),
                lambda total, i: total + F.coalesce(add(F.lit(0), i, d), F.lit(0)),
            ),
            F.lit(10),
        )
        == 0,
    )


def _proposed(text: Column, name: str) -> Column:
    """All matches of a pattern with their order, the length of the gap before and what is around."""
    _, pattern, hint = GENERATORS[name]
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    around = F.transform(
        gaps,
        lambda g: F.struct(
            F.length(g).alias("length"),
            F.right(g, F.lit(BEFORE)).alias("tail"),
            F.left(g, F.lit(AFTER)).alias("head"),
        ),
    )
    spans = let(
        around,
        lambda g: F.transform(
            found,
            lambda match, i: F.struct(
                F.lit(name).alias("generator"),
                i.alias("number"),
                match.alias("match"),
                F.get(g, i)["length"].alias("gap"),
                F.get(g, i)["tail"].alias("before"),
                F.get(g, i + 1)["head"].alias("after"),
            ),
        ),
    )
    return F.when(text.rlike(hint), spans)


def _votes(spans: DataFrame) -> DataFrame:
    """Add ``kind``, ``strict`` and the labelers' votes: 1, -1 or 0."""
    match, generator = F.col("match"), F.col("generator")
    digits = F.length(_digits(match))
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    valid_ip = match.rlike(rf"^{octet}(?:\.{octet}){{3}}$")
    phone_size = digits.between(10, 15)
    strict = (
        F.when(generator == "email", True)
        .when(generator == "ip", valid_ip)
        .when(generator == "card", (digits >= 14) & _luhn(match))
        .when(generator == "phone", phone_size)
        .otherwise(False)
    )
    kind = F.coalesce(*[F.when(generator == g, F.lit(k)) for g, (k, _, _) in GENERATORS.items()])

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    dotted = F.regexp_replace(match, rf"[ ]?(?:{_DOT}|\.)[ ]?", ".")
    domain = F.lower(F.substring_index(dotted, ".", -1))
    first = F.substring(_digits(match), 1, 1)
    check = (
        F.when(F.col("kind") == "email", vote(domain.rlike("^[a-z]{2,}$"), domain.rlike("[0-9]")))
        .when(F.col("kind") == "ip", vote(valid_ip, ~valid_ip))
        .when(F.col("kind") == "card", vote(_luhn(match), ~_luhn(match)))
        .when(F.col("kind") == "phone", vote(phone_size, ~phone_size))
        .otherwise(vote(~match.rlike("^(?:000|666|9)|-00-|-0000$"), match.rlike("^(?:000|666|9)|-00-|-0000$")))
    )
    private = match.rlike(r"^(?:0|10|127|255)\.|^192\.168\.|^172\.(?:1[6-9]|2[0-9]|3[01])\.")
    gazetteer = (
        F.when(F.col("kind") == "email", vote(domain.isin(TOP_DOMAINS), F.lit(False)))
        .when(F.col("kind") == "ip", vote(F.lit(False), private))
        .when(F.col("kind") == "card", vote(first.isin("3", "4", "5", "6"), ~first.isin("3", "4", "5", "6")))
        .when(F.col("kind") == "phone", vote(match.rlike(r"^\+(?:1|33|34|44|49)|^\(?[2-9]"), match.rlike(r"^\+0|^\(?[01]")))
        .otherwise(0)
    )
    near = F.col("before")
    context = vote(
        F.coalesce(*[F.when(F.col("kind") == k, near.rlike(p)) for k, p in CONTEXT.items()]),
        near.rlike(AGAINST),
    )
    open_ = ~F.col("before").rlike(r"[A-Za-z0-9]$") & ~F.col("after").rlike(r"^[A-Za-z0-9]")
    return (
        spans.withColumn("kind", kind)
        .withColumn("strict", F.coalesce(strict, F.lit(False)))
        .withColumn("form", F.when(F.col("strict"), 1).otherwise(-1))
        .withColumn("check", F.coalesce(check, F.lit(0)))
        .withColumn("gazetteer", F.coalesce(gazetteer, F.lit(0)))
        .withColumn("context", F.coalesce(context, F.lit(0)))
        .withColumn("borders", F.when(open_, 1).otherwise(-1))
        .withColumn("digits", F.least(digits, F.lit(20)))
    )


@dataclass(frozen=True)
class Classifier:
    """Weights of a span's kind, votes and number of digits."""

    bias: float
    weights: dict[tuple[str, object], float]

    def accepts(self) -> Column:
        total = F.lit(self.bias)
        by: dict[str, list] = {}
        for (feature, value), weight in sorted(self.weights.items(), key=str):
            by.setdefault(feature, []).append((value, weight))
        for feature, pairs in by.items():
            part = None
            for value, weight in pairs:
                hit = F.col(feature) == F.lit(value)
                part = F.when(hit, weight) if part is None else part.when(hit, weight)
            total = total + part.otherwise(0.0)
        return total >= 0


def estimate(patterns: list[tuple[dict, int]], rounds: int = 40) -> list[float]:
    """Likelihood of each vote pattern by expectation-maximisation.

    Every kind has its share of personal data; every labeler has a chance of each vote for personal
    data and for other text. The first guess is the sum of votes.
    """
    likely = [1 / (1 + math.exp(-2.0 * sum(p[v] for v in VOTES))) for p, _ in patterns]
    for _ in range(rounds):
        share: dict[str, list[float]] = {}
        seen = {(v, y, x): 1.0 for v in VOTES for y in (0, 1) for x in (-1, 0, 1)}
        for (p, n), q in zip(patterns, likely, strict=True):
            total = share.setdefault(p["kind"], [1.0, 1.0])
            total[1] += n * q
            total[0] += n * (1 - q)
            for v in VOTES:
                seen[v, 1, p[v]] += n * q
                seen[v, 0, p[v]] += n * (1 - q)
        sums = {(v, y): sum(seen[v, y, x] for x in (-1, 0, 1)) for v in VOTES for y in (0, 1)}
        after = []
        for p, _ in patterns:
            odds = math.log(share[p["kind"]][1] / share[p["kind"]][0])
            for v in VOTES:
                odds += math.log(seen[v, 1, p[v]] / sums[v, 1])
                odds -= math.log(seen[v, 0, p[v]] / sums[v, 0])
            after.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        likely = after
    return likely


def train(patterns: list[tuple[dict, int]], steps: int = 400) -> Classifier:
    """A logistic span classifier fitted to the estimated likelihoods, weighted by log counts."""
    if not patterns:
        return Classifier(-1.0, {})
    likely = estimate(patterns)
    features = ["kind", *VOTES, "digits"]
    keys = sorted({(f, p[f]) for p, _ in patterns for f in features}, key=str)
    place = {k: i for i, k in enumerate(keys)}
    rows = [[place[f, p[f]] for f in features] for p, _ in patterns]
    amount = [math.log1p(n) for _, n in patterns]
    total = sum(amount)
    w, b, rate = [0.0] * len(keys), 0.0, 1.0
    for _ in range(steps):
        slope, push = [0.0] * len(keys), 0.0
        for row, q, n in zip(rows, likely, amount, strict=True):
            e = n * (1 / (1 + math.exp(-b - sum(w[i] for i in row))) - q) / total
            push += e
            for i in row:
                slope[i] += e
        w = [x - rate * (s + 1e-3 * x) for x, s in zip(w, slope, strict=True)]
        b -= rate * push
    return Classifier(b, dict(zip(keys, w, strict=True)))


def proposals(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``proposed``: the matches of all patterns in order of the patterns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = F.concat(
        *[
            F.coalesce(_proposed(text, g), F.array().cast(_PROPOSED))
            for g in GENERATORS
        ]
    )
    return docs.select(*keep, every.alias("proposed"))


_PROPOSED = (
    "array<struct<generator:string,number:int,match:string,gap:int,before:string,after:string>>"
)


def find(rows: DataFrame, key: str) -> DataFrame:
    """Spans of rows with ``key`` and ``proposed``: ``key, kind, strict, start, end``.

    Strict spans, and loose ones that the classifier accepts and that overlap no strict one.
    """
    spans = rows.select(key, F.inline("proposed"))
    in_order = Window.partitionBy(key, "generator").orderBy("number")
    until = in_order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("gap").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(
        F.sum(F.length("match")).over(until), F.lit(0)
    )
    placed = saved(
        _votes(spans.withColumn("start", start))
        .withColumn("end", F.col("start") + F.length("match"))
        .select(key, "kind", "strict", "start", "end", *VOTES, "digits"),
        "spans",
    )
    # At most one row per kind, votes and number of digits.
    counts = placed.groupBy("kind", *VOTES, "digits").count().collect()
    names = ["kind", *VOTES, "digits"]
    patterns = sorted(
        (({n: r[n] for n in names}, r["count"]) for r in counts), key=lambda x: str(x[0])
    )
    by_start = Window.partitionBy(key).orderBy("start", F.desc("strict"))
    reach = F.max(F.when(F.col("strict"), F.col("end"))).over(
        by_start.rowsBetween(Window.unboundedPreceding, 0)
    )
    ahead = F.min(F.when(F.col("strict"), F.col("start"))).over(
        by_start.rowsBetween(0, Window.unboundedFollowing)
    )
    apart = F.coalesce(reach <= F.col("start"), F.lit(True)) & F.coalesce(
        ahead >= F.col("end"), F.lit(True)
    )
    return (
        placed.withColumn("apart", apart)
        .where(F.col("strict") | (train(patterns).accepts() & F.col("apart")))
        .select(key, "kind", "strict", "start", "end")
    )


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every document.

    Returns ``doc_id``, the number of strict spans per kind (``n_email, n_ip, n_card, n_phone``),
    ``base_sha256`` of the strict spans and ``spans``, all of them: ``kind:start:end`` in code points
    from 0, the end exclusive, ordered by start and kind, joined by commas. Null texts are empty.
    Null ids and repeated rows come back as they are; an empty table gives no rows; other columns
    are ignored. Whole texts are read once; their spans, not the texts, are shuffled.
    """
    rows = saved(
        proposals(
            docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .withColumn("row", F.monotonically_increasing_id()),
            "text", ["row", "doc_id"],
        ),
        "proposals",
    )
    order = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    listed = (
        find(rows.where(F.size("proposed") > 0), "row")
        .groupBy("row")
        .agg(
            *[F.count_if(F.col("strict") & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE_KINDS],
            F.sort_array(
                F.collect_list(F.struct("start", order.alias("order"), "end", "kind", "strict"))
            ).alias("all"),
        )
    )

    def joined(spans: Column) -> Column:
        named = F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.coalesce(F.array_join(named, ","), F.lit(""))

    return (
        rows.select("row", "doc_id")
        .join(listed, "row", "left")
        .select(
            "doc_id",
            *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
            F.sha2(joined(F.filter("all", lambda s: s["strict"])), 256).alias("base_sha256"),
            joined(F.col("all")).alias("spans"),
        )
    )


def mask(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets, ``[EMAIL]``.

    Overlapping spans become one, named after the first. Null texts stay null; other rows and
    columns, null ids and repeated rows too, stay as they are.
    """
    rows, row = numbered(docs, id_col)
    (cover,) = fresh(rows, "cover")
    proposed = proposals(rows.select(F.col(row).alias("row"), text_col), text_col, ["row"])
    proposed = saved(proposed.where(F.size("proposed") > 0), "proposals")
    by_start = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    merged = (
        find(proposed, "row")
        .withColumn("new", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
        .withColumn("part", F.sum("new").over(by_start))
        .groupBy("row", "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"),
             F.min(F.struct("start", "kind"))["kind"].alias("kind"))
        .groupBy(F.col("row").alias(row))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias(cover))
    )

    def pieces(spans: Column) -> Column:
        def piece(i: Column) -> Column:
            begin = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["end"])
            span = F.get(spans, i)
            return F.concat(
                F.substring(text_col, begin + 1, (span["start"] - begin).cast("int")),
                F.lit("["), F.upper(span["kind"]), F.lit("]"),
            )

        rest = F.substring(
            text_col, F.element_at(spans, -1)["end"] + 1, F.length(text_col)
        )
        parts = F.transform(F.sequence(F.lit(0), F.size(spans) - 1), piece)
        return F.concat(F.array_join(parts, ""), rest)

    masked = F.when(F.col(cover).isNull(), F.col(text_col)).otherwise(pieces(F.col(cover)))
    return rows.join(merged, row, "left").withColumn(text_col, masked).select(*columns_of(docs))
