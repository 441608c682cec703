"""A Merkle manifest of a table: a digest for each row, a tree for each group, a tree over the groups.

Rows of a group are numbered by their order, and every ``RUN`` = 2 consecutive nodes become the digest
of their children; a run at the end may hold one. A block of 2**BITS aligned positions is a subtree of
its own. Within a block a level needs no grouping: the node of a level sits on the row of its first
leaf, so its sibling is a fixed number of rows away, by lead on even slots and by lag on odd ones, and
the row of an even slot hashes the parent. The nodes at the top of all blocks are the next round's rows.

Numbering sorts by range and adds up the sizes of the sorted pieces, so no group, however large, meets
in one task; blocks hold at most 2**BITS rows whatever the data.

Nulls: a null field is hashed as ``-``, a null group is a group of its own, before all others, and a row
with a null order value comes first in its group. Rows of equal order value are ordered by their digest;
rows equal in all fields are interchangeable. Long texts are hashed whole, once, and leave the plan
there. An empty table gives no rows. Other columns of the table are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: Levels of a block, whose rows meet in one window.
BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_PART = 7


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def row_digest(*fields: Column) -> Column:
    """Each field as its length in bytes, a colon and its text, or ``-``; hashed together."""
    texts = [field.cast("string") for field in fields]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return digest(*sized)


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``position``, from 0 in each ``bucket`` by ``order``, and the bucket's ``count``."""
    keys = ["bucket", *order]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = saved(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered")
    # the identifier holds the task in its upper bits and the row's place there in the lower 33
    kept = kept.withColumn("piece", F.shiftright("place", 33))
    pieces = kept.groupBy("bucket", "piece").agg(F.min("place").alias("start"), F.count("*").alias("size"))
    bucket = Window.partitionBy("bucket")
    before = F.sum("size").over(bucket.orderBy("piece")) - F.col("size")
    pieces = pieces.select(
        "bucket", "piece", (before - F.col("start")).alias("shift"), F.sum("size").over(bucket).alias("count")
    )
    placed = kept.join(pieces, ["bucket", "piece"])
    return placed.withColumn("position", F.col("place") + F.col("shift")).drop("place", "piece", "shift")


def climb(nodes: DataFrame, node: str = "digest") -> DataFrame:
    """``nodes`` with ``top``, on the first row of each block, and each row's ``path`` of siblings there.

    A step of the path holds whether the sibling comes before and its digest, empty where there is none.
    """
    position, count = F.col("position"), F.col("count")
    window = Window.partitionBy("bucket", "block").orderBy("position")
    rows = nodes.withColumn("block", F.shiftright("position", BITS)).withColumn("top", F.col(node))
    steps = []
    for level in range(BITS):
        wide = 1 << level
        right = F.shiftright("position", level).bitwiseAND(F.lit(1)) == 1
        # a node sits on its first leaf's row; a level counts while the group has several nodes
        here = (position.bitwiseAND(F.lit(wide - 1)) == 0) & (F.shiftright(count - 1, level) > 0)
        sibling = F.when(right, F.lag("top", wide).over(window)).otherwise(F.lead("top", wide).over(window))
        step, other = f"step_{level}", f"other_{level}"
        rows = rows.withColumn(other, F.coalesce(F.when(here, sibling), F.lit("")))
        rows = rows.withColumns(
            {
                step: F.when(here, F.struct(right.alias("before"), F.col(other).alias("digest"))),
                "top": F.when(here & ~right, digest(F.col("top"), F.col(other))).when(~here, F.col("top")),
            }
        ).drop(other)
        steps.append(step)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    # the last step so far on a level is that of the row's own ancestor
    path = F.array_compact(F.array(*(F.last(step, ignorenulls=True).over(so_far) for step in steps)))
    return rows.withColumn("path", path).drop(*steps)


def levels(nodes: DataFrame, node: str = "digest") -> list[DataFrame]:
    """``nodes`` climbed, then the nodes over their blocks climbed, up to one node a bucket."""
    most = nodes.agg(F.max("count")).first()[0] or 0
    rounds = []
    while True:
        climbed = climb(nodes, node)
        rounds.append(climbed)
        tops = climbed.where(F.col("position").bitwiseAND(F.lit((1 << BITS) - 1)) == 0).select(
            "bucket",
            F.col("block").alias("position"),
            (F.shiftright(F.col("count") - 1, BITS) + 1).alias("count"),
            F.col("top").alias("digest"),
        )
        nodes, node = saved(tops, "blocks"), "digest"
        most = ((most - 1) >> BITS) + 1
        if most <= 1:
            return [*rounds, nodes]


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The rows of the lowest round with the columns of ``above`` (bucket, path, ...) of their bucket.

    ``path`` goes from the row up through ``above``. Every join is on a bucket's block, never on a bucket.
    """
    more = [name for name in above.columns if name not in ("bucket", "path")]
    upper = above.withColumn("block", F.lit(0).cast("long"))
    for climbed in reversed(rounds[:-1]):
        lower = climbed.withColumnRenamed("path", "own").join(upper, ["bucket", "block"])
        lower = lower.withColumn("path", F.concat("own", "path")).drop("own", "block", "top")
        upper = lower.select("bucket", F.col("position").alias("block"), "path", *more)
    return lower


def manifest(rows: DataFrame, order: str, node: str = "leaf") -> DataFrame:
    """``rows`` (bucket, ``order``, ``node``, others) with ``subroot``, ``root`` and ``path``."""
    leaves = levels(numbered(rows, order, node), node)
    subroots = leaves[-1].select(F.lit("").alias("bucket"), F.col("bucket").alias("group"), "digest")
    groups = levels(numbered(subroots, "group"))
    root = groups[-1].select("bucket", F.array().cast("array<struct<before:boolean,digest:string>>").alias("path"),
                             F.col("digest").alias("root"))
    above = descend(groups, root).select(
        F.col("group").alias("bucket"), "path", F.col("digest").alias("subroot"), "root"
    )
    return descend(leaves, above).drop("bucket", "position", "count")


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: step["digest"]), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` lead to."""
    return F.aggregate(
        path,
        leaf,
        lambda node, step: F.when(step["before"], digest(step["digest"], node)).otherwise(digest(node, step["digest"])),
    )


def tampered_manifest(docs: DataFrame, part: int = TAMPER_PART) -> DataFrame:
    """The manifest of ``docs`` by language, and what proofs say of rows whose n_chars grew by one.

    Rows are changed where ``part`` divides crc32 of the id; a null id or a null n_chars stays.
    """
    fields = {name: F.col(name) for name in FIELDS}
    chosen = F.crc32(F.col("doc_id").cast("string")) % part == 0
    raised = fields | {"n_chars": F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    rows = docs.select(
        group_key(F.col("lang")).alias("bucket"),
        "doc_id",
        row_digest(*fields.values()).alias("leaf"),
        F.when(chosen, row_digest(*raised.values())).alias("changed"),
    )
    found = manifest(saved(rows, "leaves"), "doc_id")
    found = found.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _field_sql(name: str, value: str | None = None) -> str:
    text = f"CAST({value or name} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _row_sql(**changed: str) -> str:
    return "sha256(" + " || ".join(_field_sql(name, changed.get(name)) for name in FIELDS) + ")"


# crc32 bit by bit: the register before the first byte and after the last is inverted
_SHIFT = "CASE WHEN (r & 1) = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END"
_CRC = reduce(
    lambda inner, _: f"list_reduce([{inner}, 0], lambda r, z: {_SHIFT})", range(8), "xor(c, CAST(b AS BIGINT))"
)

SQL = f"""
WITH RECURSIVE d AS (
  SELECT *, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda c, b: {_CRC}, CAST(4294967295 AS BIGINT)) AS crc FROM documents),
leaves AS (
  SELECT doc_id, lang, {_row_sql()} AS leaf,
    CASE WHEN xor(crc, 4294967295) % {TAMPER_PART} = 0 THEN {_row_sql(n_chars="n_chars + 1")} END AS changed
  FROM d),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY level, pos // 2),
below AS (
  SELECT p.doc_id, p.lang, p.pos AS leaf_pos, a.level, a.pos AS spot, s.h AS sibling
  FROM placed p JOIN nodes a ON a.lang IS NOT DISTINCT FROM p.lang AND a.pos = p.pos >> a.level AND a.n > 1
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM a.lang AND s.level = a.level AND s.pos = xor(a.pos, 1)),
above AS (
  SELECT r.lang, a.level, a.pos AS spot, s.h AS sibling
  FROM subroots r JOIN tops a ON a.pos = r.pos >> a.level AND a.n > 1
  LEFT JOIN tops s ON s.level = a.level AND s.pos = xor(a.pos, 1)),
lower AS (
  SELECT lang, leaf_pos, list(struct_pack(before := (spot & 1) = 1, h := coalesce(sibling, '')) ORDER BY level) AS path
  FROM below GROUP BY lang, leaf_pos),
upper AS (
  SELECT lang, list(struct_pack(before := (spot & 1) = 1, h := coalesce(sibling, '')) ORDER BY level) AS path
  FROM above GROUP BY lang),
paths AS (
  SELECT p.doc_id, p.leaf, r.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, coalesce(p.changed, p.leaf) AS start,
    list_concat(coalesce(l.path, []), coalesce(u.path, [])) AS path
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN lower l ON l.lang IS NOT DISTINCT FROM p.lang AND l.leaf_pos = p.pos
  LEFT JOIN upper u ON u.lang IS NOT DISTINCT FROM p.lang),
ends AS (
  SELECT *, list_reduce(path, lambda x, s: struct_pack(before := false,
    h := sha256(CASE WHEN s.before THEN s.h || x.h ELSE x.h || s.h END)), struct_pack(before := false, h := start)).h AS folded_root
  FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.h), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM ends
"""
