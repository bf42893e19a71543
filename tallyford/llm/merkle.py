"""A Merkle manifest of a dataset: one digest for all rows, and for each row the siblings that lead to it.

Rows are leaves of their source's tree by ascending id; the roots of the sources are the leaves of the dataset's tree, null
source first, then by UTF-8 bytes. In both, every `fan` consecutive nodes become one digest until one is left; the last run
of a level may be shorter, even one node. All digests are lowercase hex SHA-256 of the joined inputs, digests as text.

Levels are worked out in place. In a block of `fan ** depth` rows, the node of level k stands in the row of its first leaf:
`fan ** k` rows from its neighbours. So per level, lag and lead columns at fixed offsets, masked by the node's slot in
its run and by the run's length, are its siblings, and the row of a run's first child hashes the parent. A running
`last` hands a node's siblings to the rows below it. All levels of a block share one exchange; the blocks' digests are the next
table, `fan ** depth` times smaller. Siblings above a block join back by block, so no source's rows ever meet in one task.

Nulls in any column are leaves like others (`-` for a value); a null source is a source of its own, null ids come first.
Texts may be of any length, only their digest moves. Equal ids are ordered by leaf; equal rows take neighbouring places
and each is a leaf. Columns not named in `fields` are left alone, whatever their names. An empty table has no rows and
no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import numbered
from .registry import query, table
from .work import Work, result

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Rows of a block: 3 ** 6 = 729.
DEPTH = 6
NO_PATH = "array<struct<left:string,right:string>>"


def leaf(*values: Column) -> Column:
    """The digest of a row: each value as `bytes:value`, or `-` if it is null."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, at: F.sha2(F.concat(at["left"], node, at["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings from the leaf's level to the root's, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda at: F.concat(at["left"], at["right"]))), 256)


def _levels(nodes: DataFrame, keys: list[str], fan: int, depth: int) -> DataFrame:
    """`nodes` `(keys, idx, n, digest)` with their `block`, `path` within it and, in a block's first row, the block's `top`."""
    nodes = nodes.withColumn("block", F.expr(f"idx div {fan ** depth}"))
    rows = Window.partitionBy(*keys, "block").orderBy("idx")
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df, paths = nodes.withColumn("at0", F.col("digest")), []
    for k in range(depth):
        step, node = fan ** k, F.col(f"at{k}")
        place = F.expr(f"idx div {step}")
        level_n = F.expr(f"(n + {step - 1}) div {step}")
        slot = place % fan
        run = F.least(F.lit(fan).cast("long"), level_n - (place - slot))
        lags = [F.when(slot >= j, F.lag(node, j * step).over(rows)) for j in range(fan - 1, 0, -1)]
        leads = [F.when(slot + j < run, F.lead(node, j * step).over(rows)) for j in range(1, fan)]
        df = df.withColumn(f"left{k}", F.concat_ws("", *lags)).withColumn(f"right{k}", F.concat_ws("", *leads))
        open_, first = level_n > 1, F.col("idx") % (step * fan) == 0
        df = df.withColumn(f"at{k + 1}", F.when(
            first, F.when(open_, F.sha2(F.concat(node, F.col(f"right{k}")), 256)).otherwise(node)))
        siblings = F.when(open_ & (F.col("idx") % step == 0), F.struct(F.col(f"left{k}").alias("left"), F.col(f"right{k}").alias("right")))
        paths.append(F.last(siblings, ignorenulls=True).over(so_far) if k else siblings)
    path = F.filter(F.array(*paths), lambda at: at.isNotNull())
    return df.select(*nodes.columns, path.alias("path"), F.col(f"at{depth}").alias("top"))


def _tree(leaves: DataFrame, keys: list[str], fan: int, depth: int, work: Work, name: str) -> tuple[DataFrame, DataFrame]:
    """One tree for each key: the leaves with their path inside it, and a row `(keys, digest)` for each root.

    The first frame is a function of the paths above the roots: it takes `(keys, path)` and joins it from the top down.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    stages, nodes, left = [], leaves, most
    while True:
        made = _levels(nodes, keys, fan, depth)
        stages.append(made)
        left = -(-left // fan ** depth)
        nodes = work.keep(made.where(F.col("top").isNotNull()).select(
            *keys, F.col("block").alias("idx"), F.expr(f"(n + {fan ** depth - 1}) div {fan ** depth}").alias("n"),
            F.col("top").alias("digest")), f"{name}-nodes")
        if left <= 1:
            break

    def joined(above: DataFrame) -> DataFrame:
        above = above.withColumn("block", F.lit(0).cast("long"))
        for i, made in reversed(list(enumerate(stages))):
            above = made.join(above.withColumnRenamed("path", "higher"), [*keys, "block"]).withColumn("path", F.concat("path", "higher"))
            if i:
                above = work.keep(above.select(*keys, F.col("idx").alias("block"), "path"), f"{name}-paths")
        return above.drop("block", "higher", "top")

    return joined, nodes.select(*keys, "digest")


def manifest(
    docs: DataFrame, work: Work, *, id_col: str = "doc_id", source_col: str = "source", fields: tuple[str, ...] = FIELDS,
    more: dict[str, Column] | None = None, fan: int = 3, depth: int = DEPTH,
) -> DataFrame:
    """`(id, source, position, leaf, subroot, root, path)` for each row, and the columns of `more`.

    `path` holds the siblings of each level from the leaf to the root, as `left` and `right` texts; `fold(leaf, path)` is the root.
    """
    more = more or {}
    keys = ["known", "src"]
    leaves = work.keep(docs.select(
        F.col(f"`{source_col}`").isNotNull().cast("int").alias("known"), F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("src"),
        F.col(f"`{id_col}`").alias("id"), leaf(*[F.col(f"`{c}`") for c in fields]).alias("digest"),
        F.struct(F.lit(0).alias("none"), *[c.alias(name) for name, c in more.items()]).alias("more"),
        F.monotonically_increasing_id().alias("tie")), "leaves")
    placed = work.keep(numbered(leaves, keys, ["id", "digest", "tie"], work).drop("tie"), "placed")
    rows, subroots = _tree(placed, keys, fan, depth, work, "source")

    named = subroots.withColumnsRenamed({"known": "of_known", "src": "of_src"}).withColumn("all", F.lit(0))
    named = work.keep(numbered(named, ["all"], ["of_known", "of_src"], work), "subroots")
    tops, root = _tree(named, ["all"], fan, depth, work, "root")
    nothing = root.select("all", F.array().cast(NO_PATH).alias("path"))
    top_paths = work.keep(tops(nothing).join(root.withColumnRenamed("digest", "root"), "all").select(
        F.col("of_known").alias("known"), F.col("of_src").alias("src"), F.col("digest").alias("subroot"), "root", "path"), "top-paths")
    # Only the rows of the highest stage, one for each source, meet the sources' paths; roots ride along as a last path entry.
    ride = F.concat("path", F.array(F.struct(F.col("subroot").alias("left"), F.col("root").alias("right"))))
    whole = rows(top_paths.select(*keys, ride.alias("path")))
    end = F.element_at("path", -1)
    return whole.select(
        "id", F.when(F.col("known") == 1, F.col("src")).alias("source"), F.col("idx").alias("position"), F.col("digest").alias("leaf"),
        end["left"].alias("subroot"), end["right"].alias("root"), F.slice("path", 1, F.size("path") - 1).alias("path"),
        *[F.col(f"more.{name}").alias(name) for name in more])


SQL = r"""
WITH RECURSIVE rows_ AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER () AS rid
  FROM (SELECT doc_id, source,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
         ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS changed
    FROM (SELECT *,
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
      xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda r, b: xor(xor(r, b) // 2, 3988292384 * (xor(r, b) % 2)))) AS crc
      FROM documents))),
tree AS (
  SELECT source, 0 AS lvl, i, n, leaf AS d FROM rows_
  UNION ALL
  SELECT source, lvl + 1, i // 3, max((n + 2) // 3), sha256(string_agg(d, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY source, lvl, i // 3),
subs AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, i, n, d FROM subs
  UNION ALL
  SELECT lvl + 1, i // 3, max((n + 2) // 3), sha256(string_agg(d, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lvl, i // 3),
sib AS (
  SELECT source, lvl, i, coalesce(lag(d, 2) OVER w, '') || coalesce(lag(d) OVER w, '') AS l,
         coalesce(lead(d) OVER w, '') || coalesce(lead(d, 2) OVER w, '') AS r
  FROM tree WHERE n > 1 WINDOW w AS (PARTITION BY source, lvl, i // 3 ORDER BY i)),
top_sib AS (
  SELECT lvl, i, coalesce(lag(d, 2) OVER w, '') || coalesce(lag(d) OVER w, '') AS l,
         coalesce(lead(d) OVER w, '') || coalesce(lead(d, 2) OVER w, '') AS r
  FROM top WHERE n > 1 WINDOW w AS (PARTITION BY lvl, i // 3 ORDER BY i)),
walk AS (
  SELECT rid, source, 0 AS lvl, i, changed AS v, '' AS proof FROM rows_
  UNION ALL
  SELECT rid, w.source, w.lvl + 1, w.i // 3, sha256(l || v || r), proof || l || r
  FROM walk w JOIN sib s ON w.source IS NOT DISTINCT FROM s.source AND w.lvl = s.lvl AND w.i = s.i),
at_sub AS (SELECT rid, arg_max(source, lvl) AS source, arg_max(v, lvl) AS v, arg_max(proof, lvl) AS proof FROM walk GROUP BY rid),
climb AS (
  SELECT rid, 0 AS lvl, i, v, proof FROM at_sub a JOIN subs s ON a.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT rid, w.lvl + 1, w.i // 3, sha256(l || v || r), proof || l || r FROM climb w JOIN top_sib s ON w.lvl = s.lvl AND w.i = s.i),
at_root AS (SELECT rid, arg_max(v, lvl) AS v, arg_max(proof, lvl) AS proof FROM climb GROUP BY rid)
SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(proof) AS proof_sha256, v AS folded_root, v = t.d AS verified
FROM rows_ r JOIN subs s ON r.source IS NOT DISTINCT FROM s.source JOIN at_root USING (rid), (SELECT d FROM top WHERE n = 1) t
"""


@query("op12_merkle_manifest", SQL)
def op12(spark, sf_dir):
    """Every second row by the checksum of its id is looked at without its line ends, the others as they are."""
    docs = table(spark, sf_dir, "documents")
    pick = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    seen = [F.when(pick, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")) if c == "text" else F.col(c) for c in FIELDS]
    with Work(spark, "op12") as work:
        rows = manifest(docs, work, more={"seen": leaf(*seen)})
        folded = fold(F.col("seen"), F.col("path"))
        return result(rows.select(
            F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
            folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root")))
