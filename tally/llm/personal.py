"""Personal data by weak supervision, in built-in expressions only.

Candidates come from exact base patterns and from wider ones. Four labelers vote on every
candidate (1 personal, 0 not, or no vote): the pattern's own check (digits, checksum), a
gazetteer of cue words and endings, the characters around it, and its shape. Votes are
counted over the whole corpus by pattern of votes; expectation-maximisation on those counts
estimates how reliable each labeler is for each kind. The votes' posteriors then train the
final span classifier, a naive Bayes model over features of the span, again from counts over
the whole corpus. A span stays if it is a base span, or if its own check holds (a failed
checksum is a veto), the classifier gives it 0.5 or more, and it overlaps no base span and no accepted span that begins earlier.

Null and empty texts have no spans. Rows are never merged: equal rows and equal numbers each
give a row. The driver holds counts by vote and feature pattern only, whose number does not
depend on the data's size. Positions are code points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.session import store

KINDS = ["email", "ip", "card", "phone", "id", "secret"]  # the first four are base kinds
PRIOR, ROUNDS, SMOOTH = 0.5, 50, 1.0

# Patterns are written so that Java's matcher neither recurses by length nor scans a run twice:
# a match starts where a run does or where the last match ended, and runs are possessive.
_LOCAL = r"[A-Za-z0-9._%+-]"
_SEPARATED = "\x01"  # stands for a blank or hyphen without a digit after it, which ends a card number

#: name, kind, whether it is a base pattern, pattern, and a quick test of the text.
PATTERNS = [
    ("email", "email", True, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", "ip", True, r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    ("card", "card", True, r"[0-9][0-9\x20-]*+", r"[0-9](?:[\x20-]?[0-9]){12}"),
    ("phone", "phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    ("email_spelt", "email", False, r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,63}\x20?[\[(]\x20?dot\x20?[\])]\x20?[a-z]{2,10}\b", r"[\[(]\x20?at\x20?[\])]"),
    ("card_run", "card", False, r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])", r"[0-9]{4}(?:[\x20-]?[0-9]{4}){3}"),
    ("phone_group", "phone", False, r"(?:\+[0-9]{1,3}[\x20.-])?(?:\([0-9]{3}\)\x20?|(?<![0-9])[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])", r"[0-9]{3}[.-][0-9]{4}"),
    ("id_number", "id", False, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]"),
    ("secret_pair", "secret", False, r"(?i)\b(?:password|passwd|pwd|api_?key|secret|token)\x20?[=:]\x20?[^\s,;\"']{6,}+", r"[=:]"),
    ("secret_key", "secret", False, r"\bAKIA[0-9A-Z]{16}\b", "AKIA"),
]
BASE = [p[0] for p in PATTERNS if p[2]]

#: Cue words before a span, by kind, and words that speak against it. Fixed values.
CUES = {
    "email": "mail|contact|write to|correo|courriel",
    "ip": r"\bip\b|host|server|address|client",
    "card": "card|visa|master|credit|tarjeta|carte|karte",
    "phone": "phone|tel|call|mobile|fax|whatsapp|telefon",
    "id": "ssn|social security|passport|identity",
    "secret": "password|passwd|pwd|key|secret|token|credential",
}
AGAINST = r"version|isbn|issn|order|invoice|page|chapter|release|build|section|serial"
ENDINGS = r"\.(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|ch|at|it|nl)$"


def spans_of(text: Column, pattern: Column) -> Column:
    """For every match: the match, how much text lies before it since the last one, and both contexts."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    around = F.transform(pieces, lambda p: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(24)).alias("left"), F.substring(p, 1, 1).alias("first")))
    return F.transform(matches, lambda m, i: F.struct(
        i.alias("i"), m.alias("span"), around[i]["gap"].alias("gap"), around[i]["left"].alias("left"), around[i + 1]["first"].alias("right")))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for every candidate span, and one with a null ``name`` for every document."""
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # Each blank or hyphen without a digit after it becomes another character, so that positions stay.
    by_name = {"card": F.regexp_replace("text", r"[\x20-](?![0-9])", _SEPARATED)}
    kind = "array<struct<i:int,span:string,gap:int,left:string,right:string>>"
    found = [F.struct(F.lit(name).alias("name"),
                      F.when(F.col("text").rlike(test), spans_of(by_name.get(name, F.col("text")), F.lit(pattern))).otherwise(F.array().cast(kind)).alias("spans"))
             for name, _, _, pattern, test in PATTERNS]
    one = F.struct(F.lit(None).cast("string").alias("name"), F.array(F.lit(None).cast("struct<i:int,span:string,gap:int,left:string,right:string>")).alias("spans"))
    groups = plain.select("row", "key", F.explode(F.array(one, *found)).alias("g"))
    rows = groups.select("row", "key", F.col("g.name").alias("name"), F.explode("g.spans").alias("s")).select("row", "key", "name", "s.*")
    by = Window.partitionBy("row", "key", "name").orderBy("i")
    before = F.sum(F.col("gap") + F.length("span")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("end", before.cast("long")).withColumn("start", F.col("end") - F.length("span"))


def voted(rows: DataFrame) -> DataFrame:
    """Adds the kind, whether the span is a valid base span, the four votes, and the classifier's features."""
    name, span = F.col("name"), F.col("span")
    kind = F.expr("CASE name " + " ".join(f"WHEN '{n}' THEN '{k}'" for n, k, *_ in PATTERNS) + " END")
    digits = F.regexp_replace(span, "[^0-9]", "")
    n_digits = F.length(digits)
    parts = F.forall(F.split(span, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    check = (F.when(kind == "card", n_digits.between(13, 19) & luhn(digits))
             .when(kind == "ip", parts).when(kind == "phone", n_digits.between(9, 15))
             .when(kind == "id", ~span.rlike("^(?:000|666|9)") & ~span.rlike("-00-") & ~span.rlike("0000$"))
             .when(kind == "secret", span.rlike("[0-9]") & span.rlike("[A-Za-z]")).otherwise(F.lit(True)))
    left, right = F.lower(F.coalesce("left", F.lit(""))), F.coalesce("right", F.lit(""))
    cue = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN lleft RLIKE '{c}'" .replace("\\", "\\\\") for k, c in CUES.items()) + " END")
    cue = cue | ((F.col("kind") == "email") & span.rlike(ENDINGS))
    before_class = F.when(left == "", "edge").when(left.rlike(r"[\s(\[{<\"':;,]$"), "open").when(left.rlike("[0-9]$"), "digit").when(left.rlike(r"\p{L}$"), "letter").otherwise("other")
    after_class = F.when(right == "", "edge").when(right.rlike(r"^[\s)\]}>\"':;,.!?]"), "open").when(right.rlike("^[0-9]"), "digit").when(right.rlike(r"^\p{L}"), "letter").otherwise("other")
    shape = (F.when(kind == "card", digits.rlike("^[3-6]") & (n_digits >= 14))
             .when(kind == "phone", span.rlike(r"^\+") | span.rlike(r"[().-]"))
             .when(kind == "ip", ~span.rlike(r"^[0-9]\.[0-9]\.[0-9]\.[0-9]$")).when(kind == "email", F.length(span) <= 254)
             .when(kind == "secret", F.length(span) >= 10).otherwise(F.lit(True)))
    return (rows.withColumn("kind", kind).withColumn("lleft", left)
            .withColumns({"checked": check, "before": before_class, "after": after_class,
                          "v_gazetteer": F.when(cue, 1).when(F.col("lleft").rlike(AGAINST), 0), "v_shape": shape.cast("int")})
            .withColumns({"v_check": F.col("checked").cast("int"), "base": name.isin(BASE) & F.col("checked"),
                          "v_context": (F.col("before").isin("edge", "open") & F.col("after").isin("edge", "open")).cast("int"),
                          "size": F.when(F.length(span) < 12, "short").when(F.length(span) < 20, "middle").otherwise("long")})
            .select("row", "key", "name", "kind", "start", "end", "base", "v_check", "v_gazetteer", "v_context", "v_shape", "before", "after", "size",
                    F.coalesce(F.col("lleft").rlike(AGAINST), F.lit(False)).alias("against")))


VOTES = ["v_check", "v_gazetteer", "v_context", "v_shape"]
FEATURES = ["v_check", "v_shape", "before", "after", "size", "against"]


def reliabilities(patterns: list[tuple], prior: float = PRIOR, rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]], dict]:
    """Expectation-maximisation over (votes, count): the share of personal spans, each labeler's chance
    to vote 1 on personal and on other spans, and the posterior of every vote pattern."""
    m = len(VOTES)
    share, rate = prior, [(0.8, 0.2)] * m
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for votes, _ in patterns:
            yes, no = math.log(share), math.log(1 - share)
            for (p1, p0), v in zip(rate, votes, strict=True):
                if v is not None:
                    yes, no = yes + math.log(p1 if v else 1 - p1), no + math.log(p0 if v else 1 - p0)
            post[votes] = 1 / (1 + math.exp(min(700, no - yes)))
        total = sum(n for _, n in patterns)
        share = (sum(post[v] * n for v, n in patterns) + SMOOTH) / (total + 2 * SMOOTH)
        rate = []
        for k in range(m):
            # Each labeler begins as better than chance, with the weight of a few votes.
            seen = [(v, n) for v, n in patterns if v[k] is not None]
            yes = sum(post[v] * n for v, n in seen), sum(post[v] * n for v, n in seen if v[k] == 1)
            no = sum((1 - post[v]) * n for v, n in seen), sum((1 - post[v]) * n for v, n in seen if v[k] == 1)
            rate.append(((yes[1] + 8) / (yes[0] + 10), (no[1] + 2) / (no[0] + 10)))
    return share, rate, post


def classifier(spans: DataFrame) -> dict[str, tuple[float, dict[tuple[str, str], float]]]:
    """For every kind: the log odds of personal data, and what each feature value adds to them."""
    counted = (spans.where("name IS NOT NULL").groupBy("kind", *dict.fromkeys([*VOTES, *FEATURES])).agg(F.count("*").alias("n")).collect())
    models = {}
    for kind in KINDS:
        rows = [r for r in counted if r["kind"] == kind]
        if not rows:
            continue
        patterns: dict[tuple, int] = {}
        for r in rows:
            votes = tuple(r[v] for v in VOTES)
            patterns[votes] = patterns.get(votes, 0) + r["n"]
        share, _, post = reliabilities(sorted(patterns.items(), key=str))
        weights = {}
        for f in FEATURES:
            values = {str(r[f]) for r in rows}
            sums = {v: [SMOOTH, SMOOTH] for v in values}
            for r in rows:
                p = post[tuple(r[v] for v in VOTES)]
                sums[str(r[f])][0] += p * r["n"]
                sums[str(r[f])][1] += (1 - p) * r["n"]
            yes, no = sum(s[0] for s in sums.values()), sum(s[1] for s in sums.values())
            weights |= {(f, v): math.log(s[0] / yes) - math.log(s[1] / no) for v, s in sums.items()}
        models[kind] = (math.log(share / (1 - share)), weights)
    return models


def scored(spans: DataFrame, models: dict) -> DataFrame:
    """Adds ``score``, the classifier's probability."""
    cases = []
    for kind, (odds, weights) in models.items():
        terms = [f"{odds!r}D"]
        for f in FEATURES:
            values = " ".join(f"WHEN '{v}' THEN {w!r}D" for (g, v), w in weights.items() if g == f)
            terms.append(f"CASE CAST({f} AS STRING) {values} ELSE 0D END")
        cases.append(f"WHEN '{kind}' THEN 1 / (1 + exp(-({' + '.join(terms)})))")
    return spans.withColumn("score", F.expr(f"CASE kind {' '.join(cases)} END") if cases else F.lit(None).cast("double"))


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``base``, ``spans``) for every row: arrays of (``kind_no``, ``start``, ``end``, ``kind``, ``score``), in order.

    ``spans`` holds the base spans and those that the classifier adds.
    """
    found = store(voted(candidates(docs, key, text)), "spans")
    rows = scored(found, classifier(found)).where("name IS NULL OR base OR (v_check = 1 AND score >= 0.5)")
    kind_no = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END")
    entry = F.struct(kind_no.alias("kind_no"), "start", "end", "kind", "score")
    by_doc = rows.groupBy("row", "key").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), entry))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.col("name").isNotNull() & ~F.col("base"), entry))).alias("more"))
    free = F.filter("more", lambda a: ~F.exists("base", lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"])))
    single = F.filter(F.col("free"), lambda a: ~F.exists(F.col("free"), lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"]) & (
        (b["start"] < a["start"]) | ((b["start"] == a["start"]) & ((b["end"] > a["end"]) | ((b["end"] == a["end"]) & (b["kind_no"] < a["kind_no"])))))))
    return (by_doc.withColumn("free", free).withColumn("spans", F.array_sort(F.array_distinct(F.concat("base", single))))
            .select(F.col("key").alias(key), "base", "spans"))


def span_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
