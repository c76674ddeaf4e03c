"""Personal data by weak supervision, in DataFrame functions only.

Known shapes (``BASE``) are reported as they stand.  Further candidates (``EXTRA``) are looser shapes:
local telephone numbers, identity numbers, spelled-out addresses.  Five labelers vote on every span,
base or not: for (1), against (-1) or not at all (0).  They are the strict shape, a gazetteer,
words around it, a test for filler values, and its borders.

``fit`` counts the vote patterns of the whole corpus (at most 3^5 per kind), estimates by
expectation-maximisation how reliable each labeler is without any label, and trains a logistic
regression on votes and kind with the estimated labels.  Candidates that it gives 1/2 or more are reported.

Documents are scanned once, without a shuffle; what is shuffled are pattern counts.

Defined results: a null text is empty and has no spans; repeated rows are judged alike; with no
candidate at all nothing is learnt or added; very long texts are handled whole, and patterns are
written so that no text makes them backtrack or recurse without bound; other columns do not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import staged
from rowloom.llm.spans import NO_MATCHES, let, matches_of

#: Kinds in the order in which spans that start together are listed.
BASE = ("email", "ip", "card", "phone")
EXTRA = ("tel", "id", "spelled")
KINDS = BASE + EXTRA
LABELERS = ("shape", "known", "context", "filler", "border")

#: A local part starts where a run of its characters starts, or behind the last match: looking
#: further inside a run without "@" would find nothing.  Possessive parts do not recurse.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
#: Runs of fewer than 14 digits fail anyway.
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Not what follows a country code: that is a phone already.
TEL = r"(?<![0-9+.(-])(?<!\+[0-9]{1,3}[\x20.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SPELLED = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[(]dot[\])]\x20?|\.)[A-Za-z]{2,24}"
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, TEL, ID, SPELLED), strict=True))

#: Gazetteers (fixed values): top-level domains, country calling codes, documentation numbers.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|nl|uk|ch|at|be|eu|us|ca|au|jp"
CALLING_CODES = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|54|55|56|57|60|61|62|63|64|65|66|81|82|84|86|90|91|92|98"
SAMPLE_IDS = ("078-05-1120", "123-45-6789", "219-09-9999")
LOCAL_NETWORKS = r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|2[2-5][0-9])\."
#: Words before a span that speak for it, and against any personal data.
FOR = {
    "email": "mail|contact|write|schreib|courriel|correo",
    "ip": "ip|host|server|address|login|from",
    "card": "card|visa|master|amex|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobil|contact|ring|anruf",
    "tel": "phone|tel|call|fax|mobil|contact|ring|anruf",
    "id": "ssn|social|security|identity|id no|tax",
    "spelled": "mail|contact|write|schreib|courriel|correo",
}
AGAINST = "version|release|isbn|issn|order|invoice|serial|part no|page|section|example"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, F.lit("[^0-9]"), F.lit(""))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check of card numbers."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: let(d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)),
    )
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return let(_digits(match), lambda d: F.when(F.length(d) <= 19, luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _votes(kind: str, m: Column) -> tuple[Column, ...]:
    """Votes of ``LABELERS`` on a match of ``kind`` with its surroundings."""
    text, never = m["match"], F.lit(False)
    digits, before = _digits(text), F.lower(m["before"])
    shapes = {
        "email": (r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,24}$", r"\.[0-9]+$|\.\.|^[.%+-]"),
        "ip": (r"^(?:[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$", r"(?:^|\.)0[0-9]"),
        "card": (r"^[3-6][0-9]{3}(?:([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,4})$", r"^[0-2789]"),
        "phone": (r"^\+[1-9][0-9]{0,2}[\x20.-]?\(?[0-9]{1,4}\)?(?:[\x20.-]?[0-9]{2,4}){1,4}$", r"\+0|[(][^)]*$"),
        "tel": (r"^\([2-9][0-9]{2}\)\x20[2-9][0-9]{2}-[0-9]{4}$|^[2-9][0-9]{2}([.-])[2-9][0-9]{2}\1[0-9]{4}$", r"^\(?[01]|^[^()]*\)"),
        "id": (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$", r"^(?:000|666|9)|-00-|-0000$"),
        "spelled": (r"(?i)[\[(]at[\])].*(?:[\[(]dot[\])]|\.)", r"^[.%+-]"),
    }
    known = {
        "email": (text.rlike(rf"(?i)\.(?:{DOMAINS})$"), never),
        "ip": (never, text.rlike(LOCAL_NETWORKS)),
        "card": (digits.rlike("^(?:4|5[1-5]|3[47]|6011|2[2-7])"), never),
        "phone": (digits.rlike(f"^(?:{CALLING_CODES})"), never),
        "tel": (never, digits.rlike("^[0-9]{3}555(?:01[0-9]{2}|1212)$")),
        "id": (never, text.isin(*SAMPLE_IDS)),
        "spelled": (text.rlike(rf"(?i)(?:{DOMAINS})$"), never),
    }
    return (
        _vote(*map(text.rlike, shapes[kind])),
        _vote(*known[kind]),
        _vote(before.rlike(rf"(?:{FOR[kind]})[^a-z]{{0,6}}(?:[a-z]{{1,12}}[^a-z]{{1,3}}){{0,2}}$"), before.rlike(rf"(?:{AGAINST})\W*$")),
        _vote(F.lit(False), digits.rlike(r"^([0-9])\1{6,}|0{6}|123456")),
        _vote(
            m["before"].rlike(r"(?:^|[\s(<:\[,;\"'])$") & m["after"].rlike(r"^(?:$|[\s)>\],;.\"'])"),
            m["before"].rlike(r"[\p{L}\p{N}_/=]$") | m["after"].rlike(r"^[\p{L}\p{N}_/=]"),
        ),
    )


#: A candidate: where, what, and the votes on it.
NO_CANDIDATES = "array<struct<start:int,rank:int,end:int,kind:string,votes:array<int>>>"


#: A character without which there is no match.
NEEDED = {"email": "@", "phone": "+"}


def _of_kind(text: Column, kind: str) -> Column:
    found = matches_of(text, PATTERNS[kind])
    if kind in NEEDED:
        found = F.when(F.contains(text, F.lit(NEEDED[kind])), found).otherwise(F.array().cast(NO_MATCHES))
    return F.transform(
        F.filter(found, lambda m: _valid(kind, m["match"])),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.array(*_votes(kind, m)).alias("votes"),
        ),
    )


def candidates(text: Column) -> Column:
    """All base spans and further candidates of a text with their votes, sorted."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[_of_kind(text, kind) for kind in KINDS]).cast(NO_CANDIDATES))


@dataclass
class LabelModel:
    """What expectation-maximisation finds: the share of true spans, and each labeler's votes given the truth."""

    share: float
    votes: list[dict[tuple[int, bool], float]]

    def posterior(self, votes: tuple[int, ...]) -> float:
        odds = math.log(self.share) - math.log(1 - self.share)
        for table, v in zip(self.votes, votes, strict=True):
            odds += math.log(table[v, True]) - math.log(table[v, False])
        return 1 / (1 + math.exp(-max(min(odds, 500), -500)))


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 50) -> LabelModel:
    """Expectation-maximisation over counts of vote patterns; starts from labelers that are mostly right."""
    start = {(1, True): 0.6, (0, True): 0.3, (-1, True): 0.1, (1, False): 0.1, (0, False): 0.3, (-1, False): 0.6}
    model = LabelModel(0.5, [dict(start) for _ in LABELERS])
    for _ in range(rounds):
        true = {p: n * model.posterior(p) for p, n in patterns.items()}
        total, n_true = sum(patterns.values()), sum(true.values())
        tables = []
        for j in range(len(LABELERS)):
            table = {}
            for v in (-1, 0, 1):
                yes = sum(t for p, t in true.items() if p[j] == v)
                no = sum(n - true[p] for p, n in patterns.items() if p[j] == v)
                # The start counts as five spans, so that no vote is ever impossible.
                table[v, True] = (yes + 5 * start[v, True]) / (n_true + 5)
                table[v, False] = (no + 5 * start[v, False]) / (total - n_true + 5)
            tables.append(table)
        model = LabelModel((n_true + 2) / (total + 4), tables)
    return model


@dataclass
class SpanClassifier:
    """A logistic regression over kind and votes."""

    intercept: float
    weights: dict[str, float]

    def probability(self, kind: Column, votes: Column) -> Column:
        score = F.lit(self.intercept)
        for name, weight in self.weights.items():
            of, value = name.rsplit(":", 1)
            test = kind == value if of == "kind" else F.get(votes, F.lit(LABELERS.index(of))) == int(value)
            score = score + F.when(test, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-score))


def fit(found: DataFrame) -> SpanClassifier | None:
    """Learn from ``found`` (candidates): pattern counts, label model, classifier."""
    counts = found.select(F.explode_outer("candidates").alias("c")).where("c IS NOT NULL")
    counts = counts.groupBy(F.col("c.kind").alias("kind"), F.col("c.votes").alias("votes")).count()
    counts = staged(counts, "pii-patterns")
    patterns: dict[tuple[int, ...], int] = {}
    rows = counts.collect()  # at most 3^5 patterns of each kind
    for r in rows:
        patterns[tuple(r.votes)] = patterns.get(tuple(r.votes), 0) + r["count"]
    if not patterns:
        return None
    model = reliabilities(patterns)
    names = [f"kind:{k}" for k in KINDS] + [f"{n}:{v}" for n in LABELERS for v in (1, -1)]

    def features() -> list[Column]:
        kinds = [(F.col("kind") == k).cast("double").alias(f"kind:{k}") for k in KINDS]
        votes = [
            (F.get("votes", F.lit(j)) == v).cast("double").alias(f"{n}:{v}") for j, n in enumerate(LABELERS) for v in (1, -1)
        ]
        return kinds + votes

    true = F.lit(0.0)
    for pattern in patterns:
        true = F.when(F.col("votes") == F.array(*map(F.lit, pattern)), F.lit(model.posterior(pattern))).otherwise(true)
    weighed = counts.select("count", true.alias("true"), *features())
    parts = [
        weighed.withColumns({"label": F.lit(label), "weight": F.col("count") * share})
        for label, share in ((1.0, F.col("true")), (0.0, 1 - F.col("true")))
    ]
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(parts[0].unionByName(parts[1]))
    trained = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=30, standardization=False).fit(rows.coalesce(1))
    return SpanClassifier(float(trained.intercept), dict(zip(names, map(float, trained.coefficients), strict=True)))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` (start, rank, end, kind) of every document: base spans, and what the classifier adds."""
    found = staged(docs.select("doc_id", candidates(F.col("text")).alias("candidates")), "pii-candidates")
    classifier = fit(found)

    def kept(c: Column) -> Column:
        if classifier is None:
            return c["kind"].isin(*BASE)
        return c["kind"].isin(*BASE) | (classifier.probability(c["kind"], c["votes"]) >= 0.5)

    spans = F.filter("candidates", kept)
    spans = F.transform(spans, lambda c: F.struct(*[c[n].alias(n) for n in ("start", "rank", "end", "kind")]))
    return found.select("doc_id", spans.alias("spans"))
