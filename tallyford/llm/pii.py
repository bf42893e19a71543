"""Personal data: high-recall generators propose spans, boosted trees decide, in DataFrame operations only.

Four kinds are found by rule (`email`, `ip`, `card`, `phone`): the leftmost, non-overlapping matches of a pattern that
pass the kind's test. Five generators propose further spans, which may overlap: assigned secrets, long keys,
grouped digits, numbers of national format and spelled-out addresses. Boosted trees score these by format
(length, shares of digits, letters and capitals, variety, separators) and by context (words before, assignment,
quotes). They learn from weak labels: spans that a rule confirms are positive, digit groups and keys that no rule
and no context supports are negative. The threshold is the lowest at which a held-out part of the labelled spans has
the wanted precision. A span under the threshold, or that overlaps a rule's span or a better one, is left out.

The trees are fitted on all labelled candidates but a quarter, which sets the threshold; all documents are scored. Features lie on
a grid, so the fit counts every row for the places where it may split and these stay few.
A null text is empty. Places are code points, the end is exclusive. Equal rows are separate documents, other
columns are not read. Without labelled candidates of both classes nothing is added to the rules' spans.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table
from .work import Work, result

# Labelled candidates that a task of the fit holds, about.
FITTED_TOGETHER = 100_000
PRECISION = 0.98
# Steps of a share, and of a length when it doubles; counts end at 4 * STEPS.
STEPS = 32
CONTEXT = 24

# Possessive and anchored forms of the kinds' patterns: they find the same matches in time linear in the text.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "secret": r"(?i)(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9+/_.-]{6,}",
    "key": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{0,12}[0-9])[A-Za-z0-9+/_-]{20,}+",
    "digits": r"(?<![0-9.])[0-9](?:[\x20.-]?[0-9]){6,}+",
    "national": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}",
    "spelled": r"(?i)(?<![a-z0-9._-])[a-z0-9._-]++\x20?[\[(]at[\])]\x20?[a-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[a-z0-9-]++)++",
}
# A text without one of these, in either case, cannot hold the kind; a plain search is cheaper than the pattern.
NEEDS = {"email": "@", "phone": "+", "spelled": "at"}
FEATURES = [
    "length", "digits", "letters", "capitals", "variety", "separators", "at", "dots", "plus", "equals", "luhn", "octets", "hex",
    "word_before", "mark_before", *[f"is_{k}" for k in PROPOSED]]


def spans(text: Column, kind: str, pattern: str) -> Column:
    """The matches of a pattern as an array of `(kind, start, end, found)`."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    # The pieces between the matches give their places; there is one more piece than matches.
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("found"))
    placed = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add)["out"]
    some = F.when(F.size(found) > 0, placed).otherwise(none)
    return F.when(F.contains(F.lower(text), F.lit(NEEDS[kind])), some).otherwise(none) if kind in NEEDS else some


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes Luhn's test."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (F.lit(1) + F.pmod(i, F.lit(2)))
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.pmod(F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add), F.lit(10)) == 0


def octets(found: Column) -> Column:
    """Whether all dotted parts are at most 255, however many digits they have."""
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(found, r"\."), small)


def passes(kind: str, found: Column) -> Column:
    digits = digits_of(found)
    return {
        "email": F.lit(True), "ip": octets(found),
        "card": F.length(digits).between(16, 19) & luhn(digits), "phone": F.length(digits).between(8, 15),
    }[kind]


def confirmed(kind: str):
    return lambda s: passes(kind, s["found"])


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def features(found: Column, before: Column, kind: Column) -> dict[str, Column]:
    def share(pattern: str) -> Column:
        return F.regexp_count(found, F.lit(pattern)) / F.length(found)

    digits = digits_of(found)
    values = {
        "length": F.length(found), "digits": share("[0-9]"), "letters": share("[A-Za-z]"), "capitals": share("[A-Z]"),
        "variety": F.size(F.array_distinct(F.split(found, ""))) / F.length(found), "separators": share(r"[\x20.\-()/]"),
        "at": F.contains(found, F.lit("@")), "dots": F.regexp_count(found, F.lit(r"\.")), "plus": F.startswith(found, F.lit("+")),
        "equals": F.rlike(found, F.lit("[=:]")), "luhn": F.length(digits).between(12, 19) & luhn(F.concat(F.lit("0"), digits)),
        "octets": F.rlike(found, F.lit(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")), "hex": F.rlike(found, F.lit("[0-9a-f]{16}")),
        "word_before": F.rlike(before, F.lit(r"(?i)(pass|pwd|secret|token|key|mail|phone|tel|call|card|iban|ssn|account|address)[^A-Za-z]*[A-Za-z]{0,4}[^A-Za-z]*$")),
        "mark_before": F.rlike(before, F.lit("[=:\"'(]\\s?$")),
        **{f"is_{k}": kind == k for k in PROPOSED},
    }
    # On a grid: whole steps of the length's logarithm and of shares, small counts and flags.
    values["length"] = F.round(F.log2(values["length"]) * STEPS / 4)
    for name in ("digits", "letters", "capitals", "variety", "separators"):
        values[name] = F.round(values[name] * STEPS)
    values["dots"] = F.least(values["dots"], F.lit(4 * STEPS))
    return {name: value.cast("double") for name, value in values.items()}


def _candidates(found: DataFrame) -> DataFrame:
    """A row for each proposed span, with its features and weak label (null: none)."""
    one = found.select("rid", "id", F.explode("proposed").alias("c"))
    named = one.select("rid", "id", F.col("c.kind").alias("kind"), F.col("c.start").alias("start"), F.col("c.end").alias("end"),
                       F.col("c.found").alias("found"), F.col("c.before").alias("before"), "c.rule")
    f = features(F.col("found"), F.col("before"), F.col("kind"))
    with_features = named.select("rid", "id", "kind", "start", "end", "rule", *[F.coalesce(f[x], F.lit(0.0)).alias(x) for x in FEATURES])
    assigned = (F.col("kind") == "secret") & (F.col("equals") > 0) & (F.col("digits") > 0.15 * STEPS)
    unsupported = F.col("kind").isin("digits", "key", "national") & (F.col("word_before") + F.col("mark_before") + F.col("luhn") == 0)
    return with_features.withColumn("label", F.when(F.col("rule") | assigned, 1.0).when(unsupported, 0.0))


def _held() -> Column:
    return F.pmod("h", F.lit(4)) == 0


def fit(candidates: DataFrame, work: Work):
    """Trees and threshold from all labelled candidates; None if they are all of one class."""
    labelled = candidates.where("label is not null").withColumn("h", F.xxhash64("id", "start", "end", "kind"))
    seen = {r.label: r.n for r in labelled.where(~_held()).groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        return None
    n = sum(seen.values())
    # By the id, not the row number: the order of the sums is the same however the input is split.
    labelled = work.keep(labelled.repartition(n // FITTED_TOGETHER + 2, "h").sortWithinPartitions("h", "id", "start"), "labelled")
    together = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # The library looks for places to split in maxBins squared rows: with the root of the rows, in all of them.
    trees = GBTClassifier(maxIter=8, maxDepth=4, seed=7, labelCol="label", maxBins=max(32, math.isqrt(n) + 1)).fit(
        together.transform(labelled.where(~_held())))

    def scored(df: DataFrame) -> DataFrame:
        return trees.transform(together.transform(df)).withColumn("score", F.round(vector_to_array("probability")[1], 6))

    steps = scored(labelled.where(_held())).groupBy("score").agg(F.sum("label").alias("good"), F.count("*").alias("n"))
    above = Window.orderBy(F.desc("score"))
    good = steps.select("score", (F.sum("good").over(above) / F.sum("n").over(above)).alias("precision")).where(F.col("precision") >= PRECISION)
    threshold = good.agg(F.min("score")).first()[0]
    return None if threshold is None else (scored, threshold)


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document `(id_col, base, spans)`: arrays of `(kind, start, end, found)`, the rules' spans and all spans."""
    spark = docs.sparkSession
    with Work(spark, "pii") as work:
        rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        base = F.concat(*[F.filter(spans(F.col("text"), k, p), confirmed(k)) for k, p in BASE.items()])
        plain = F.concat(*[spans(F.col("text"), k, p) for k, p in PROPOSED.items()])
        found = rows.select("id", "text", base.alias("base"), plain.alias("plain"))
        proposed = F.transform("plain", lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"),
            F.substring(F.col("text"), F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))).alias("before"),
            F.exists("base", lambda b: overlaps(s, b)).alias("rule")))
        kept = work.keep(found.select("id", "base", proposed.alias("proposed")).withColumn("rid", F.monotonically_increasing_id()), "found")
        some = work.keep(_candidates(kept), "candidates")
        fitted = fit(some, work)
        all_spans = "array<struct<kind:string,start:int,end:int,found:string>>"
        if fitted is None:
            return result(kept.select(F.col("id").alias(id_col), "base", F.col("base").alias("spans")))
        scored, threshold = fitted
        chosen = (
            scored(some.where("not rule")).where(F.col("score") >= threshold)
            .groupBy("rid").agg(F.collect_list(F.struct((-F.col("score")).alias("score"), "start", "end", "kind")).alias("better")))

        def choose(out: Column, s: Column) -> Column:
            one = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
            return F.when(F.exists(out, lambda o: overlaps(o, s)), out).otherwise(F.concat(out, F.array(one)))

        empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
        more = F.sort_array(F.aggregate(F.sort_array("better"), empty, choose))
        joined = kept.join(chosen, "rid", "left").withColumn("more", F.coalesce(more, empty))
        text_of = F.transform("more", lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.filter("proposed", lambda p: (p["kind"] == s["kind"]) & (p["start"] == s["start"]))[0]["found"].alias("found")))
        return result(joined.select(
            F.col("id").alias(id_col), "base", F.concat(F.col("base"), text_of).cast(all_spans).alias("spans")))


def redacted(text: Column, found: Column) -> Column:
    """A text with its spans replaced by their kinds; overlapping spans of several kinds are replaced together."""
    def step(state: Column, s: Column) -> Column:
        begin = F.greatest(state["at"], s["start"])
        more = F.concat(state["out"], F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0))),
                        F.when(s["end"] > state["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit("")))
        return F.struct(F.greatest(begin, s["end"]).alias("at"), more.alias("out"))

    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    last = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.concat(last["out"], F.substring(text, last["at"] + 1, F.length(text)))


@query("op10_pii")
def op10(spark, sf_dir):
    def joined(found: str) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    counted = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id", *counted, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
