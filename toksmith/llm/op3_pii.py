"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans of four kinds come from patterns: the base ones, whose checked
matches always stay, and looser ones (obfuscated mail addresses, national and
``00`` phone numbers, IPv6 addresses, cards in dotted, slashed or wide groups);
matches of a base pattern that fail its check are candidates too.
Three labelers vote on each (-1, 0, 1): the pattern with its check (base and
loose patterns each have one), a gazetteer (top-level domains, issuer prefixes,
reserved ranges, area codes) and the cue words before the span.  Expectation-maximisation over the counts of vote
patterns (at most 27 a kind, all that reaches the driver) estimates the
labelers' reliabilities; its posteriors train the final span classifier, a naive
Bayes model over votes and span shape, whose counts are one aggregation over all
candidates.  Another span is added if the classifier accepts it and it overlaps no
base span.  Where base matches are almost all candidates of a kind, the fitted prior
alone would accept anything, so ``MIN_LEAD`` more votes for it than against are
asked for too: two labelers are enough, a cue word is not necessary.

Offsets are code points, ends exclusive; a kind's matches are leftmost and do not
overlap.  Defined cases: a null text is empty and has no span; every input row
gives one row, repeated rows and null ids included; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toksmith.session import cut_lineage

KINDS = "email", "ip", "card", "phone"
# The base patterns, written so that no position is tried twice: a match can only start where its
# first run of characters starts (or where the last match ended), and runs are taken whole.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]++(?:(?: ?[(\[]dot[)\]] ?| dot )[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][./_])[0-9]{4}(?:(?:[./_]|  | - )[0-9]{4}){3}(?![./_]?[0-9])",
    "phone": r"(?<![0-9+(])(?:\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|00[1-9][0-9 ().-]{7,16}[0-9])(?![0-9])",
}
#: what a text must hold for a pattern to be tried at all
HINT = {("email", 1): "@", ("email", 0): "dot", ("phone", 1): "+", ("ip", 0): ":"}

# Gazetteers and cue words (fixed values)
TLDS = "com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn ru br in ch at be se no pl pt mx ar".split()
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65|64[4-9]|35|62)"
CUES = {
    "email": r"mail|contact|write to|reach|courriel|correo|schreib",
    "ip": r"\bip\b|address|host|server|login|adresse|direcci",
    "card": r"card|visa|master|amex|credit|payment|carte|tarjeta|karte",
    "phone": r"phone|\btel|call|mobile|cell|fax|whatsapp|anruf|appel|llam",
}
AGAINST = r"version|isbn|issn|serial|order|invoice|ticket|section|chapter|\bv\.?$|release|build|sku|part no"
CONTEXT = 40

LABELERS = "check", "gazetteer", "context"
SHAPES = "grouped", "size"
ROUNDS = 30
MIN_LEAD = 2
PRIOR = 8.0  # pseudo-votes behind "a labeler is right in four of five votes"


def _find(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, value>>``: offsets from the pieces between the matches."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    step = F.aggregate(
        F.zip_with(hits, F.split(text, pattern, -1), lambda hit, gap: F.struct(hit.alias("hit"), F.length(gap).alias("gap"))),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
            F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + F.length(x["hit"])).alias("end"), x["hit"].alias("value"))))).alias("out")))
    return step["out"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda c: c.cast("int"))
    twice = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(F.filter(twice, lambda d: d.isNotNull()), F.lit(0), lambda a, b: a + b) % 10 == 0


def _octets(value: Column) -> Column:
    plain = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(plain, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


def check(kind: str, value: Column) -> Column:
    """The base rule of a kind, for a match of its base pattern."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return _octets(value)
    n = F.length(_digits(value))
    return luhn(value) if kind == "card" else (n >= 9) & (n <= 15)


def loose_check(kind: str, value: Column) -> Column:
    """What a match of the loose pattern of a kind must hold to be voted for."""
    if kind == "email":
        return value.rlike("[A-Za-z]{2}$")
    if kind == "ip":
        return F.size(F.array_distinct(F.split(F.lower(value), ":"))) > 2
    if kind == "card":
        return luhn(value)
    n = F.length(F.regexp_replace(_digits(value), "^00", ""))
    return (n >= 9) & (n <= 15)


def _gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        known = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1)).isin(TLDS)
    elif kind == "card":
        known = _digits(value).rlike(ISSUERS)
    elif kind == "ip":
        known = ~value.rlike(r"^(0+|127|22[4-9]|2[3-5][0-9])\.|^(0+:){7}")
    else:
        known = ~F.regexp_replace(_digits(value), "^(00)?1?(?=[0-9]{10}$)", "").rlike("^[01]")
    return F.when(known, 1).otherwise(F.lit(0) if kind == "email" else F.lit(-1))


def _candidates(text: Column, kind: str, strict: bool) -> Column:
    """``array<struct<kind, start, end, base, check, gazetteer, context, grouped, size>>``"""

    def judge(x: Column) -> Column:
        value, before = x["value"], F.lower(F.substring(text, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT))))
        good = check(kind, value) if strict else loose_check(kind, value)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), (good if strict else F.lit(False)).alias("base"), F.when(good, 1).otherwise(-1).alias("check"),
            _gazetteer(kind, value).alias("gazetteer"), F.when(before.rlike(CUES[kind]), 1).when(before.rlike(AGAINST), -1).otherwise(0).alias("context"),
            value.rlike(r"[ ()\[\]-]").cast("int").alias("grouped"), F.least(F.length(value) / 6, F.lit(9)).cast("int").alias("size"))

    found = F.transform(_find(text, (BASE if strict else LOOSE)[kind]), judge)
    none = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean,check:int,gazetteer:int,context:int,grouped:int,size:int>>")
    # numbers need a run of four characters that start and end numbers; the rest a sign of their own
    hint = HINT.get((kind, int(strict)))
    return F.when(text.contains(hint) if hint else text.rlike("[0-9][0-9. -][0-9]|[0-9][.][0-9]"), found).otherwise(none)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans)``: one row per input row with all its candidate spans and their votes."""
    t = F.coalesce(F.col("t"), F.lit(""))
    parts = [_candidates(t, k, True) for k in KINDS] + [_candidates(t, k, False) for k in KINDS if k in LOOSE]
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).select("doc_id", F.flatten(F.array(*parts)).alias("spans"))


def reliabilities(counts: list[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Probability that a span is one, per vote pattern, from the pattern counts of one kind: EM for
    a two-class model with independent labelers; the prior makes a labeler more right than wrong."""
    values = (-1, 0, 1)
    belief = {v: min(0.95, max(0.05, 0.5 + 0.25 * sum(v))) for v, _ in counts}
    for _ in range(ROUNDS):
        yes = sum(n * belief[v] for v, n in counts) + 1
        no = sum(n * (1 - belief[v]) for v, n in counts) + 1
        table = []
        for j in range(len(LABELERS)):
            one = {x: PRIOR * w for x, w in zip(values, (0.1, 0.5, 0.4), strict=True)}
            nil = {x: PRIOR * w for x, w in zip(values, (0.4, 0.5, 0.1), strict=True)}
            for v, n in counts:
                one[v[j]] += n * belief[v]
                nil[v[j]] += n * (1 - belief[v])
            table.append({x: math.log(one[x] / sum(one.values())) - math.log(nil[x] / sum(nil.values())) for x in values})
        belief = {v: 1 / (1 + math.exp(-max(-50.0, min(50.0, math.log(yes / no) + sum(t[x] for t, x in zip(table, v, strict=True)))))) for v, _ in counts}
    return belief


def _lookup(table: dict[str, float], key: Column) -> Column:
    pairs = [F.lit(x) for kv in sorted(table.items()) for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(0.0)) if pairs else F.lit(0.0)


def fit(found: DataFrame) -> dict[str, float]:
    """Log-odds of the span classifier: ``"kind"`` (prior) and ``"kind|feature|value"``."""
    spans = found.select(F.explode("spans").alias("s")).select("s.*")
    votes = spans.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 27 rows a kind
    belief: dict[str, float] = {}
    for kind in range(len(KINDS)):
        own = [(tuple(r[x] for x in LABELERS), r["n"]) for r in sorted(votes) if r["kind"] == kind]
        belief |= {f"{kind}|" + "|".join(map(str, v)): p for v, p in reliabilities(own).items()}
    p = _lookup(belief, F.concat_ws("|", "kind", *LABELERS))
    names = LABELERS + SHAPES
    flat = spans.select("kind", p.alias("p"), F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in names))).alias("x"))
    sums = flat.groupBy("kind", "x.f", "x.v").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()  # a few hundred rows
    odds: dict[str, float] = {}
    for kind in range(len(KINDS)):
        total = [(r["yes"], r["no"]) for r in sums if r["kind"] == kind and r["f"] == LABELERS[0]]
        yes, no = sum(a for a, _ in total) + 1, sum(b for _, b in total) + 1
        odds[str(kind)] = math.log(yes / no)
        for r in sorted(r for r in sums if r["kind"] == kind):
            odds[f"{kind}|{r['f']}|{r['v']}"] = math.log((r["yes"] + 0.5) / (yes + 1)) - math.log((r["no"] + 0.5) / (no + 1))
    return odds


def classify(found: DataFrame, odds: dict[str, float]) -> DataFrame:
    """``(doc_id, base, added)``: spans ``<kind, start, end>`` in order of kind and start."""

    def accepted(s: Column) -> Column:
        score = _lookup(odds, s["kind"].cast("string"))
        for f in LABELERS + SHAPES:
            score = score + _lookup(odds, F.concat_ws("|", s["kind"].cast("string"), F.lit(f), s[f].cast("string")))
        return (score > 0) & (sum(s[f] for f in LABELERS) >= MIN_LEAD)

    def free(s: Column) -> Column:
        return ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))

    plain = lambda a: F.array_sort(F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    base = found.select("doc_id", plain(F.filter("spans", lambda s: s["base"])).alias("base"),
                        F.filter("spans", lambda s: ~s["base"] & accepted(s)).alias("more"))
    return base.select("doc_id", "base", plain(F.filter("more", free)).alias("added"))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    found = cut_lineage(candidates(docs, doc_id, text))
    return classify(found, fit(found))


def mask(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts with every span of ``spans (doc_id, base, added)`` replaced by its kind in brackets;
    ids must be unique.  Of overlapping spans the one that starts first names the replacement."""
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))
    whole = F.col(text)
    step = F.aggregate(every, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
        F.greatest(s["end"], a["at"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring(whole, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"]))).alias("out"))))
    done = F.concat(step["out"], F.substring(whole, step["at"] + 1, F.length(whole)))
    return docs.join(spans.select(F.col("doc_id").alias(doc_id), "base", "added"), doc_id, "left").withColumn(
        text, F.when(F.size("base") + F.size("added") > 0, done).otherwise(whole)).drop("base", "added")


def op3_pii(spark, sf_dir: str) -> DataFrame:
    out = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    names = F.array(*map(F.lit, KINDS))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    of = lambda i: F.filter("base", lambda s: s["kind"] == i)
    counts = [F.size(of(i)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", "added"))).alias("spans"))
