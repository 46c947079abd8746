"""Personal data by weak supervision, in DataFrame functions only.

Spans of four base kinds follow fixed patterns and always stay. Further kinds
(``MORE``) are candidates only: labelers of three sorts vote on each (its
format, gazetteers of cue words beside it, its context), and nobody knows which
labeler is right. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is; the posteriors it gives to all
candidates, base ones included, then train a logistic span classifier over the
votes and the candidate's shape, and it decides the further spans.

Only counts by vote pattern leave the executors: at most 3 ** labelers patterns
per kind and shape, whatever the number of documents. Everything else is a
column expression over one scan of the texts, without any shuffle of them.

Cases: null and empty texts have no spans; matches may touch but never overlap
within a kind, and further kinds never overlap a base span; repeated rows each get a row; other columns are ignored; an
empty table gives an empty result, with the classifier's start values unused.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the base kinds in the order of the contract. Groups are possessive and starts are tied to the
# start of a run, which finds the same matches without trying a long run again from each of its places.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# fixed values: kinds that the method adds
MORE = {
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "tel": r"(?<![0-9+.(-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ /-])[0-9]{3,4}[ -][0-9]{3,5}(?![0-9-])",
    "person": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?",
}
# characters without which a kind can't occur
NEEDS = {"email": "@", "phone": "+"}
KINDS = [*BASE, *MORE]
# fixed values: cue words of the gazetteer labelers, in the four languages
CUES = {
    "email": "e-?mail|mail|contact|correo|courriel|kontakt|write|send",
    "ip": "ip|host|address|addr|server|login|client|adresse|direcci[oó]n",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|t[eé]l[eé]phone|tel[eé]fono|handy|whatsapp",
    "ssn": "ssn|social|security|tax|versicherung|s[eé]curit[eé]|seguridad",
    "iban": "iban|bank|account|konto|compte|cuenta|transfer",
    "tel": "phone|tel|call|mobile|cell|fax|telefon|t[eé]l[eé]phone|tel[eé]fono|handy|whatsapp",
    "person": "name|dear|contact|from|signed|liebe|lieber|cher|ch[eè]re|estimado|estimada",
}
AGAINST = "version|release|isbn|issn|order|invoice|item|sku|part|example|sample|test|dummy|section|page|figure"
BESIDE = 24
ROUNDS = 60
ACCEPT = 0.9


def _matches(text: Column, kind: str) -> Column:
    """Array of (start, end, value, left, right) of the pattern's matches, in code points.

    The text between matches gives their places, and what stands beside them.
    """
    pattern = (BASE | MORE)[kind]
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    rest = F.transform(zipped, lambda z: F.struct(z["gap"].alias("gap"), z["value"].alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string,left:string>>")
    placed = F.aggregate(
        rest, F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda done, z: F.struct(
            (done["at"] + F.length(z["gap"]) + F.coalesce(F.length(z["value"]), F.lit(0))).alias("at"),
            F.when(z["value"].isNull(), done["found"]).otherwise(F.concat(done["found"], F.array(F.struct(
                (done["at"] + F.length(z["gap"])).alias("start"),
                (done["at"] + F.length(z["gap"]) + F.length(z["value"])).alias("end"),
                z["value"].alias("value"), F.right(z["gap"], F.lit(BESIDE)).alias("left"))))).alias("found")),
        lambda done: done["found"])
    there = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike(pattern)
    return F.when(there, placed).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    back = F.reverse(_digits(value))
    doubled = F.transform(F.split(back, ""), lambda c, i: F.try_to_number(c, F.lit("9")).cast("int") * (1 + i % 2))
    total = F.aggregate(F.filter(doubled, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return total % 10 == 0


def _octets(value: Column) -> Column:
    short = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(short, lambda p: F.when(F.length(p) <= 3, p.try_cast("int") <= 255).otherwise(False))


def _valid(kind: str, value: Column) -> Column:
    """What the contract keeps of a base kind's matches; for other kinds the strict format, which is a vote."""
    n = F.length(_digits(value))
    checks: dict[str, Callable[[], Column]] = {
        "email": lambda: F.lit(True),
        "ip": lambda: _octets(value),
        "card": lambda: F.when((n >= 12) & (n <= 19), _luhn(value)).otherwise(False),
        "phone": lambda: (n >= 9) & (n <= 15),
        "ssn": lambda: ~value.rlike("^(000|666|9)|-00-|-0000$"),
        "iban": lambda: F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34),
        "tel": lambda: (n >= 9) & (n <= 13),
        "person": lambda: value.rlike(r" \p{Lu}\p{Ll}{2,} \p{Lu}\p{Ll}{2,}$"),
    }
    return checks[kind]()


VOTES = ("format", "cue", "against", "context", "variety")


def _votes(kind: str, span: Column) -> list[Column]:
    """1 for, -1 against, 0 no opinion."""
    value, left = span["value"], F.lower(span["left"])
    yes, no, abstain = F.lit(1), F.lit(-1), F.lit(0)
    return [
        F.when(_valid(kind, value), yes).otherwise(no),
        F.when(left.rlike(rf"(?:^|[^\p{{L}}])(?:{CUES[kind]})[^\p{{L}}]*$"), yes).otherwise(abstain),
        F.when(left.rlike(rf"(?:^|[^\p{{L}}])(?:{AGAINST})[^\p{{L}}]*$"), no).otherwise(abstain),
        # stands in running text, or in the midst of numbers and code
        F.when(left.rlike(r"\p{L}[.,:;]?\s*$"), yes).when(left.rlike(r"[0-9=/_#][\s]*$"), no).otherwise(abstain),
        F.when(F.size(F.array_distinct(F.split(_digits(value), ""))) <= 3, no).otherwise(abstain)
        if kind not in ("email", "person") else abstain,
    ]


def candidates(docs: DataFrame) -> DataFrame:
    """The rows with ``__spans``: (start, rank, kind, end, base, votes) of all base spans and candidates."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.withColumn("__text", text)
    # most texts have no digit, which all numeric kinds need
    numeric = F.col("__text").rlike("[0-9]")
    columns = {}
    for kind in KINDS:
        matches = _matches(F.col("__text"), kind)
        columns[f"__{kind}"] = F.when(numeric, matches) if kind not in ("email", "person") else matches
    found = found.withColumns(columns)
    parts = [_voted(kind, F.col(f"__{kind}")) for kind in KINDS]
    return found.withColumn("__spans", F.array_sort(F.concat(*parts))).drop("__text", *columns)


def _voted(kind: str, matches: Column) -> Column:
    spans = F.coalesce(matches, F.array())
    if kind in BASE:
        spans = F.filter(spans, lambda s: _valid(kind, s["value"]))
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
        s["end"].alias("end"), F.lit(kind in BASE).alias("base"), F.array(*_votes(kind, s)).alias("votes")))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict[int, tuple[float, float]]], list[float]]:
    """Expectation-maximisation for conditionally independent labelers over (votes, count).

    Returns the share of true candidates, per labeler each vote's chance among
    true and false ones, and the posterior of each pattern. Starts from the
    majority's opinion; counts are smoothed, so unseen votes stay possible.
    """
    posterior = [_sigmoid(1.5 * sum(votes)) for votes, _ in patterns]
    total = sum(n for _, n in patterns)
    share, tables = 0.5, []
    for _ in range(ROUNDS):
        true = sum(p * n for p, (_, n) in zip(posterior, patterns))
        share = (true + 1) / (total + 2)
        tables = []
        for k in range(len(VOTES)):
            table = {}
            for vote in (-1, 0, 1):
                of = [(p, n) for p, (votes, n) in zip(posterior, patterns) if votes[k] == vote]
                table[vote] = (
                    (sum(p * n for p, n in of) + 1) / (true + 3), (sum((1 - p) * n for p, n in of) + 1) / (total - true + 3))
            tables.append(table)
        posterior = []
        for votes, _ in patterns:
            score = math.log(share / (1 - share)) + sum(
                math.log(tables[k][v][0] / tables[k][v][1]) for k, v in enumerate(votes))
            posterior.append(_sigmoid(score))
    return share, tables, posterior


def logistic(rows: list[tuple[list[float], float, float]], rounds: int = 400, rate: float = 0.5) -> list[float]:
    """Weights of a logistic model over (features, soft label, count), by descent on the mean loss with a ridge."""
    if not rows:
        return []
    weights, total = [0.0] * len(rows[0][0]), sum(n for *_, n in rows)
    for _ in range(rounds):
        slope = [1e-3 * w for w in weights]
        for x, y, n in rows:
            error = (_sigmoid(sum(a * b for a, b in zip(weights, x))) - y) * n / total
            for k, value in enumerate(x):
                slope[k] += error * value
        weights = [w - rate * s for w, s in zip(weights, slope)]
    return weights


def _features(kind: str, votes: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(kind == k) for k in KINDS), *map(float, votes)]


def span_classifier(found: DataFrame) -> list[float]:
    """Weights learned from the vote patterns of all candidates of all documents."""
    counted = (
        found.select(F.explode("__spans").alias("s")).groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n")))
    rows = sorted((r.kind, tuple(r.votes), r.n) for r in counted.collect())
    patterns: dict[tuple[int, ...], int] = {}
    for _, votes, n in rows:
        patterns[votes] = patterns.get(votes, 0) + n
    listed = sorted(patterns.items())
    posterior = dict(zip((v for v, _ in listed), reliabilities(listed)[2])) if listed else {}
    return logistic([(_features(kind, votes), posterior[votes], n) for kind, votes, n in rows])


def _accepted(span: Column, weights: list[float]) -> Column:
    kinds = reduce(lambda a, b: a + b, (
        F.when(span["kind"] == kind, F.lit(weights[1 + k])).otherwise(F.lit(0.0)) for k, kind in enumerate(KINDS)))
    votes = reduce(lambda a, b: a + b, (
        F.get(span["votes"], F.lit(k)) * F.lit(weights[1 + len(KINDS) + k]) for k in range(len(VOTES))))
    return F.lit(weights[0]) + kinds + votes >= math.log(ACCEPT / (1 - ACCEPT))


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, spans: array of (start, rank, kind, end, base, votes), by start and then kind."""
    found = candidates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")
    weights = span_classifier(found)
    if not weights:
        return found.select("doc_id", F.col("__spans").alias("spans"))
    base = F.filter("__spans", lambda s: s["base"])

    def stays(s: Column) -> Column:
        apart = ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return s["base"] | (_accepted(s, weights) & apart)

    return found.select("doc_id", F.filter("__spans", stays).alias("spans"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as one string."""
    base = F.filter("spans", lambda s: s["base"])

    def listed(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select("doc_id", *map(count, BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
