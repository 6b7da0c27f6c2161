"""Mixing sources to target weights with a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]: a straight
line from ``a`` to ``b``. Its integral, (a + b) / 2, is the source's share of
the word budget. Shares above ``max_passes`` times what the source holds stop
there and the excess is shared again by weight among the rest, in closed form
(sorted by the level at which each source fills up).

Within a source, documents are laid end to end in a seeded order, pass after
pass, until the source's target is used up; the document on the border is cut
there. The cumulative word number of a placement is turned into its training
position by inverting the source's cumulative demand, and the placements are
range-sorted by position.

Everything is DataFrame and SQL functions. The running sum is two-level: the
order key's first three hex digits cut each source into 4,096 cells, cell sums
become offsets, and only the rows of one cell are sorted together, so a source
with a third of all rows is spread over 4,096 groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.llm.queries import register
from sparkcast.llm.shared import n_words, read_table

#: Weight schedules (start, end) by rank of the source; integrals 3, 1, 2.
SCHEDULES = ((4.5, 1.5), (0.5, 1.5), (2.0, 2.0))
BUDGET = 1.5
MAX_PASSES = 2


def _line(index, values: Sequence[float]):
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), index)


def source_targets(
    sizes: DataFrame,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    budget: float = BUDGET,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """Targets per source from (``_src``, ``source_size``), one row a source.

    The windows run over the table of sources, one row each. ``_src`` is the
    source with a prefix that puts NULL last.
    """
    by_name = Window.orderBy("_src")
    by_level = Window.orderBy("_ratio", "_rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    t = (
        sizes.withColumn("_rank", F.row_number().over(by_name))
        .withColumn("_slot", (F.col("_rank") - 1) % len(schedules) + 1)
        .withColumn("_a", _line(F.col("_slot"), [a for a, _ in schedules]))
        .withColumn("_b", _line(F.col("_slot"), [b for _, b in schedules]))
        .withColumn("_weight", (F.col("_a") + F.col("_b")) / 2)
        .withColumn("_cap", F.col("source_size").cast("double") * max_passes)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_words", F.sum("source_size").over(whole))
        .withColumn("_all_weight", F.sum("_weight").over(whole))
        .withColumn("_cap_before", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_weight_before", F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
        .withColumn(
            "_level",
            (F.col("_words") * F.lit(float(budget)) - F.col("_cap_before"))
            / (F.col("_all_weight") - F.col("_weight_before")),
        )
        .withColumn("_full", F.col("_ratio") <= F.col("_level"))
    )
    # The level of the first source that does not fill up holds for the rest.
    level = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return t.withColumn("_common", level).select(
        "_src",
        "source_size",
        "_a",
        "_b",
        F.when(F.col("_full"), F.col("_cap"))
        .otherwise(F.col("_common") * F.col("_weight"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    budget: float = BUDGET,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """Give every document its words in the mix and its training positions.

    Adds ``size``, ``source_size``, ``target``, ``taken`` (words over all
    passes) and ``placements``: an array of (pass, words, position), one for
    each pass that takes words. Rows keep all their other columns; columns of
    the same names as those added are replaced.

    NULL text is empty: size 0, nothing taken. A NULL source is a source of
    its own, last in order. Repeated rows count each; rows that are equal in
    id and text are interchangeable. An empty table gives an empty table.
    """
    ours = {"size", "source_size", "target", "taken", "placements"}
    keep = [c for c in docs.columns if c not in ours or c in (id_col, text_col, source_col)]
    order = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.col(text_col)).cast("binary"))
    base = docs.select(*[F.col(f"`{c}`") for c in keep]).withColumns(
        {
            "size": n_words(F.col(text_col)),
            "_src": F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t")),
            "_key": order,
        }
    ).withColumn("_cell", F.substring("_key", 1, 3))

    cells = base.groupBy("_src", "_cell").agg(F.sum("size").alias("_cell_size")).checkpoint()
    targets = source_targets(
        cells.groupBy("_src").agg(F.sum("_cell_size").alias("source_size")),
        schedules,
        budget,
        max_passes,
    )
    cell_order = Window.partitionBy("_src").orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    plan = (
        cells.withColumn("_offset", F.coalesce(F.sum("_cell_size").over(cell_order), F.lit(0)))
        .join(targets, "_src")
        .drop("_cell_size")
    )

    in_cell = (
        Window.partitionBy("_src", "_cell")
        .orderBy("_key", id_col, "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        base.join(plan, ["_src", "_cell"])
        .withColumn("_before", F.col("_offset") + F.coalesce(F.sum("size").over(in_cell), F.lit(0)))
        .withColumn("_goal", F.round("target").cast("long"))
    )

    def placement(p: int):
        at = F.col("_before") + F.lit(p) * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("_goal") - at))
        share = at / F.col("_goal")
        a, b = F.col("_a"), F.col("_b")
        # t with  a t + (b - a) t^2 / 2 = share (a + b) / 2
        position = F.try_divide(
            share * (a + b), a + F.sqrt(a * a + (b - a) * (a + b) * share)
        )
        return F.when(
            words > 0,
            F.struct(
                F.lit(p + 1).alias("pass"),
                words.alias("words"),
                F.coalesce(position, F.lit(0.0)).alias("position"),
            ),
        )

    return (
        placed.withColumn(
            "placements", F.array_compact(F.array(*[placement(p) for p in range(max_passes)]))
        )
        .withColumn(
            "taken",
            F.aggregate("placements", F.lit(0).cast("long"), lambda acc, x: acc + x["words"]),
        )
        .select(*[F.col(f"`{c}`") for c in keep if c != "size"],
                "size", "source_size", "target", "taken", "placements")
    )


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per placement, range-sorted by training position."""
    cols = [c for c in mixed.columns if c not in ("placements", "pass", "words", "position")]
    return (
        mixed.select(*[F.col(f"`{c}`") for c in cols], F.inline("placements"))
        .orderBy("position", id_col, "pass")
    )


def cut_words(text, words):
    """The first ``words`` words of a text, single-spaced."""
    parts = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.array_join(F.slice(parts, 1, words.cast("int")), " ")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as a table of documents, in training order.

    A document taken twice has two rows; the one on its source's border is
    cut to the words taken. Columns are those of ``docs``.
    """
    names = {k: options.pop(f"{k}_col", d) for k, d in (("id", "doc_id"), ("text", "text"), ("source", "source"))}
    rest = [c for c in docs.columns if c != names["text"]]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"),
        *[F.col(f"`{names[k]}`").alias(f"_{k}") for k in names],
    )
    mixed = mix_sources(base, "_id", "_text", "_source", **options)
    cut = F.when(F.col("words") < F.col("size"), cut_words(F.col("_text"), F.col("words")))
    out = training_order(mixed, "_id").withColumn("_text", F.coalesce(cut, F.col("_text")))

    def column(c):
        if c == names["text"]:
            return F.col("_text").alias(c)
        if c == "n_chars":
            return F.length("_text").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"_row.`{c}`")

    return out.select(*[column(c) for c in docs.columns])


SQL = r"""
WITH base AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat_ws(':', CAST(doc_id AS VARCHAR), text)) AS k
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS slot,
         row_number() OVER (ORDER BY source NULLS LAST) AS rk,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS words FROM src),
weighed AS (
  SELECT *, CASE slot WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         CASE slot WHEN 0 THEN 4.5::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE 2.0::DOUBLE END AS a,
         CASE slot WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.5::DOUBLE ELSE 2.0::DOUBLE END AS b,
         CAST(source_size AS DOUBLE) * 2 AS cap FROM ranked),
levels AS (
  SELECT *, (words - coalesce(sum(cap) OVER before, 0::DOUBLE))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0::DOUBLE)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, a, b,
         CASE WHEN cap / w <= level THEN cap
              ELSE (SELECT arg_min(level, rk2) FROM
                     (SELECT level, row_number() OVER (ORDER BY cap / w, rk) AS rk2, cap, w
                      FROM levels) x WHERE x.cap / x.w > x.level) * w END AS target
  FROM levels),
laid AS (
  SELECT doc_id, size, source_size, target, a, b, CAST(round(target) AS BIGINT) AS goal,
         CAST(sum(size) OVER (PARTITION BY base.source ORDER BY k, doc_id, size
              ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS bef
  FROM base JOIN targets ON base.source IS NOT DISTINCT FROM targets.source),
passes AS (
  SELECT *, greatest(0, least(size, goal - bef)) AS p1,
            greatest(0, least(size, goal - bef - source_size)) AS p2,
            CASE WHEN goal > 0 THEN bef / CAST(goal AS DOUBLE) END AS u
  FROM laid)
SELECT doc_id, size, source_size, target, CAST(p1 + p2 AS BIGINT) AS taken,
       CASE WHEN p1 > 0 THEN u * (a + b) / (a + sqrt(a * a + (b - a) * (a + b) * u)) END
         AS first_position
FROM passes
"""


@register("op6_mix_sources", SQL)
def op6_mix_sources(spark, sf_dir):
    mixed = mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.try_element_at("placements", F.lit(1))["position"].alias("first_position"),
    ).orderBy(F.col("first_position").asc_nulls_last(), "doc_id")
