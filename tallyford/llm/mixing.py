"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Every source gets a target of words from its weight; a target stops at `most` times the source's size and the
excess is shared again by weight. A document's expected number of copies is `target / source size`. Within a
source these are summed up in one order, a random offset per source is added, and a document is taken once for
each whole number that its part of the sum crosses. So a document is taken the expected number of times,
rounded down or up, and the words taken come near the target, because the order runs from short to long texts.

The sum over a source is not one task's work: the order is (class of size, salt, size, id, hash of the text), rows are
counted by (source, class, salt), and only these counts, kept once, are summed up ahead, first over classes, then over
the 4,096 salts of a class. Rows are numbered within one (source, class, salt). The salt comes from the id, without one
from the text. Texts are read twice: for the counts and for the numbers.

A null text has size 0, a null source is a source of its own and comes last. Documents of size 0 are numbered
like others and take no words; texts of any length count whole. Equal rows are taken separately. All columns of the input are kept whatever
their names. An empty table gives an empty mix. The offset comes from the source's name, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table
from .work import result

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def _hex(text: Column, begin: int, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), begin, digits), 16, 10).cast("long")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep: list[str]) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    tie = F.coalesce(_hex(F.col(text_col), 1, 8), F.lit(0).cast("long"))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        size.alias("size"), tie.alias("tie"),
    ).withColumns({"step": F.floor(F.sqrt("size")), "salt": F.coalesce(_hex(F.col("id").cast("string"), 1, 3), F.col("tie") % 4096)})


def targets(sizes: DataFrame, share: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    """`(source, source_size, target, rate)` from `(source, source_size)`: one row for each source."""
    named = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    full = (
        sizes.withColumn("rank", F.row_number().over(named))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("wanted", F.sum("source_size").over(every) * F.lit(float(share))))
    # Sources reach their cap in the order of cap / weight; the level is what a weight of 1 gets if all before are capped.
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    level = (
        full.withColumn("before", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("wanted") - F.col("before")) / F.col("left"))
        .withColumn("open", F.col("weight") * F.col("level") < F.col("cap")))
    first = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("c"), "rank", "level"))).over(every)["level"]
    target = F.when(F.col("open"), F.col("weight") * first).otherwise(F.col("cap"))
    return level.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = 1.5,
    most: int = 2, weights: tuple[int, ...] = WEIGHTS, keep: list[str] | None = None,
) -> DataFrame:
    """`(row, size, source_size, target, copies)`: `row` has the columns `keep` of the document, all if not given."""
    sized = _sized(docs, id_col, text_col, source_col, docs.columns if keep is None else keep)
    counts = result(
        sized.groupBy("source", "step", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    per_step = counts.groupBy("source", "step").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    rates = targets(per_step.groupBy("source").agg(F.sum("words").alias("source_size")), share, most, weights)

    zero = F.lit(0).cast("long")
    steps = per_step.select("source", "step", F.coalesce(F.sum("n").over(
        Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), zero).alias("earlier"))
    salts = counts.select("source", "step", "salt", F.coalesce(F.sum("n").over(
        Window.partitionBy("source", "step").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), zero).alias("within"))

    # A null source takes part in the joins under a key of its own.
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("missing", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))

    plan = (
        keyed(salts).join(keyed(steps), ["missing", "source", "step"])
        .join(keyed(rates), ["missing", "source"])
        .withColumn("offset", _hex(F.concat(F.lit("mix:"), F.col("missing").cast("string"), F.lit(":"), "source"), 1, 8) / F.lit(4294967296.0)))
    numbered = keyed(sized).withColumn("number", F.row_number().over(
        Window.partitionBy("missing", "source", "step", "salt").orderBy("size", "id", "tie")))
    place = F.col("earlier") + F.col("within") + F.col("number")
    crossed = F.floor(place * F.col("rate") + F.col("offset")) - F.floor((place - 1) * F.col("rate") + F.col("offset"))
    return numbered.join(plan, ["missing", "source", "step", "salt"]).select(
        "row", "size", "source_size", "target", F.least(crossed, F.lit(most).cast("long")).alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    taken = copies(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         coalesce(('0x' || substr(md5(text), 1, 8))::BIGINT, 0) AS tie,
         coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 3))::BIGINT, tie % 4096) AS salt FROM documents),
sums AS (SELECT source, sum(size)::DOUBLE AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sums),
weighed AS (SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, source_size * 2.0::DOUBLE AS cap,
                   sum(source_size) OVER () * 1.5::DOUBLE AS wanted FROM ranked),
levels AS (SELECT *, (wanted - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
opened AS (SELECT *, weight * level < cap AS open FROM levels),
rates AS (SELECT source, source_size, CASE WHEN open THEN weight * first_level ELSE cap END AS target FROM (
  SELECT *, (SELECT level FROM opened WHERE open ORDER BY cap / weight, rank LIMIT 1) AS first_level FROM opened)),
placed AS (
  SELECT doc_id, size, r.source_size, r.target, CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0.0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY floor(sqrt(size)), salt, size, doc_id, tie) AS place,
         ('0x' || substr(md5('mix:' || (s.source IS NULL)::VARCHAR || ':' || coalesce(s.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * least(floor(place * rate + u) - floor((place - 1) * rate + u), 2))::BIGINT AS taken FROM placed
"""


@query("op9_source_mix", SQL)
def op9(spark, sf_dir):
    mixed = copies(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
