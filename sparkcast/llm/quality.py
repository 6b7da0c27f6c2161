"""Quality rules with thresholds read from mergeable quantile sketches.

Per document: word, character, symbol, line and repetition counts of the whole
text. Two fixed rules (too few words, too much repetition) come first; the
other rules compare a document with its own language and source. Each of their
features is an integer (per mille, or hundredths of a character) of any size,
so a histogram over that grid (of the leading ``BIN_BITS`` bits, for large
values) is a quantile sketch without a top that merges by adding counts:
``groupBy(group, feature, bin).count()``, combined before the shuffle. From it
come the limits (quartile +- 3 x interquartile range, and a margin for groups
without spread) of each (language, source) and of each language. A source
of n documents is judged by a blend of its own limits, with weight n, and its
language's, with a fixed weight: no size switches, and no other language
counts. The blended limits are joined back and filter the documents.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.llm.queries import register
from sparkcast.llm.shared import numbered, read_table, restored
from sparkcast.llm.words import (
    IS_SPACE,
    Hasher,
    blocks,
    combine,
    gram_hashes,
    gram_starts,
    mix64,
    split_lines,
    split_words,
    text_bytes,
)

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Weight of the language's limits, in documents, beside a source's own.
MIN_GROUP = 100
FENCE = 3
#: Bits of a value that name its bin: exact below 2^13, to 1 / 4096 above.
BIN_BITS = 13
#: Last bin of the SQL text; larger values share it there.
TOP_BIN = 5000
#: feature -> (numerator, denominator, scale, margin, two-sided)
RULES = {
    "symbols": ("n_symbols", "word_chars", 1000, 30, False),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 500, False),
    "repeats": ("n_repeat_words", "n_words", 1000, 300, False),
    "word_length": ("word_chars", "n_words", 100, 100, True),
}

FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_row(flags: np.ndarray, rows: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[rows[1:]] - sums[rows[:-1]]


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys that occur more than once."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def _features(text: pa.Array) -> dict[str, np.ndarray]:
    data, rows = text_bytes(text)
    w = split_words(data, rows)
    n_rows = len(rows) - 1
    salt = mix64(np.arange(n_rows, dtype=np.uint64))
    inside = ~IS_SPACE[data]
    word_chars = _per_row(inside & ((data & 0xC0) != 0x80), rows)

    starts, ends, row = split_lines(data, rows)
    ink = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    real = ink[ends] > ink[starts]
    starts, ends, row = starts[real], ends[real], row[real]
    n_lines = np.bincount(row, minlength=n_rows)
    hashes = Hasher(data)
    key = combine(hashes(starts, ends), salt[row])
    later = np.ones(len(key), dtype=bool)
    later[np.unique(key, return_index=True)[1]] = False
    n_dup = np.bincount(row[later], minlength=n_rows)

    at = gram_starts(w.first, WINDOW)
    covered = np.zeros(len(w) + 1, dtype=np.int64)
    if len(at):
        grams = gram_hashes(hashes(w.start, w.end), WINDOW)[at]
        hit = at[_repeated(combine(grams, salt[w.row_of()[at]]))]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + WINDOW, -1)
    return {
        "n_words": w.counts,
        "word_chars": word_chars,
        "n_symbols": _per_row(_SYMBOL[data], rows),
        "n_lines": n_lines,
        "n_dup_lines": n_dup,
        "n_repeat_words": _per_row(np.cumsum(covered[:-1]) > 0, w.first),
    }


def with_features(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the counts of ``FEATURES``; input columns of those names go."""
    keep = [c for c in (keep or docs.columns) if c not in FEATURES]
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in FEATURES]])
    width, at = len(keep), keep.index(text_col) if text_col in keep else len(keep)

    def run(batches):
        for b in batches:
            text = b.column(at)
            found = [_features(text.slice(i, j - i)) for i, j in blocks(text)]
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns[:width],
                    *[
                        pa.array(np.concatenate([x[c] for x in found] or [[]]).astype(np.int64))
                        for c in FEATURES
                    ],
                ],
                names=[*keep, *FEATURES],
            )

    cols = [F.col(f"`{c}`") for c in keep]
    if at == width:
        cols.append(F.col(f"`{text_col}`").alias("_text"))
    return docs.select(*cols).mapInArrow(run, schema)


def _value(rule: str):
    top, below, scale, _, _ = RULES[rule]
    return F.floor(F.col(top) * scale / F.greatest(F.col(below), F.lit(1))).cast("long")


def _dropped_bits(value):
    return F.greatest(F.length(F.bin(value)) - BIN_BITS, F.lit(0))


def _bin(value):
    """Least value of a value's bin."""
    bits = _dropped_bits(value)
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def _bin_end(least):
    """Largest value of the bin with this least value."""
    return least + F.call_function("shiftleft", F.lit(1).cast("long"), _dropped_bits(least)) - 1


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )


def quantile_sketch(feats: DataFrame, groups: list[str]) -> DataFrame:
    """Counts by (groups, rule, bin) over the documents the base rules pass."""
    values = F.array(
        *[F.struct(F.lit(r).alias("rule"), _bin(_value(r)).alias("bin")) for r in RULES]
    )
    return (
        feats.where(~_base_failed())
        .select(*groups, F.inline(values))
        .groupBy(*groups, "rule", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def sketch_limits(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, rule, total, low, high) of each group.

    Windows are over the bins of one group: at most 2^13 rows, and 2^12 for
    each doubling of the largest value beyond.
    """
    merged = sketch.groupBy(*groups, "rule", "bin").agg(F.sum("n").alias("n"))
    by_bin = Window.partitionBy(*groups, "rule").orderBy("bin")
    whole = Window.partitionBy(*groups, "rule")
    ranked = merged.withColumn("cum", F.sum("n").over(by_bin)).withColumn(
        "total", F.sum("n").over(whole)
    )

    def q(k: int):
        return F.min(F.when(F.col("cum") * 4 >= F.col("total") * k, F.col("bin")))

    margin = reduce(
        lambda e, r: e.when(F.col("rule") == r, RULES[r][3]), RULES, F.when(F.lit(False), 0)
    )
    two_sided = F.col("rule").isin([r for r in RULES if RULES[r][4]])
    spread = (F.col("q3") - F.col("q1")) * FENCE + margin
    return (
        ranked.groupBy(*groups, "rule")
        .agg(q(1).alias("q1"), _bin_end(q(3)).alias("q3"), F.max("total").alias("total"))
        .select(
            *groups,
            "rule",
            "total",
            F.when(two_sided, F.col("q1") - spread).otherwise(-1).alias("low"),
            (F.col("q3") + spread).alias("high"),
        )
    )


def limits_by_group(feats: DataFrame, lang_col="lang", source_col="source", min_group=MIN_GROUP) -> DataFrame:
    """One row per (language, source) seen: ``low_<rule>`` and ``high_<rule>``."""
    fine = quantile_sketch(feats, ["_lang", "_source"]).checkpoint()
    own = sketch_limits(fine, ["_lang", "_source"])
    by_lang = sketch_limits(fine, ["_lang"]).select(
        "_lang", "rule", F.col("low").alias("wide_low"), F.col("high").alias("wide_high")
    )

    def blend(side):
        both = F.col(side) * F.col("total") + F.col(f"wide_{side}") * min_group
        return F.floor(both / (F.col("total") + min_group)).cast("long").alias(side)

    picked = own.join(by_lang, ["_lang", "rule"]).select(
        "_lang", "_source", "rule", F.struct(blend("low"), blend("high")).alias("l")
    )
    return picked.groupBy("_lang", "_source").agg(
        *[
            F.max(F.when(F.col("rule") == r, F.col("l")[side])).alias(f"_{side}_{r}")
            for r in RULES
            for side in ("low", "high")
        ]
    )


def _keyed(feats: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    def key(c):
        return F.coalesce(F.concat(F.lit("s"), F.col(f"`{c}`").cast("string")), F.lit("t"))

    return feats.withColumn("_lang", key(lang_col)).withColumn("_source", key(source_col))


def judge(feats: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to keyed features."""
    inside = reduce(
        lambda a, b: a & b,
        [
            _value(r).between(
                F.coalesce(F.col(f"_low_{r}"), F.lit(-1)),
                F.coalesce(F.col(f"_high_{r}"), _value(r)),
            )
            for r in RULES
        ],
    )
    # A few limits columns a group: Spark broadcasts them when small and
    # splits a hot group's rows otherwise (a plain equi-join).
    return (
        feats.join(limits, ["_lang", "_source"], "left")
        .withColumn("base_failed", _base_failed())
        .withColumn("kept", ~F.col("base_failed") & inside)
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """Counts and verdict of every document: id, ``FEATURES``, ``base_failed``, ``kept``.

    NULL or empty text has no words and fails the base rule. A NULL language
    or source is a group of its own. Repeated rows are judged each. An empty
    table gives an empty table.
    """
    keep = list(dict.fromkeys([id_col, lang_col, source_col]))
    feats = _keyed(with_features(docs, text_col, keep), lang_col, source_col).checkpoint()
    return judge(feats, limits_by_group(feats, lang_col, source_col, min_group)).select(
        f"`{id_col}`", *FEATURES, "base_failed", "kept"
    )


def quality_filter(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = MIN_GROUP,
) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, columns unchanged.

    The texts are read twice (sketch, then filter) and never shuffled.
    """
    narrow = _keyed(with_features(docs, text_col, list(dict.fromkeys([lang_col, source_col]))), lang_col, source_col)
    limits = limits_by_group(narrow, lang_col, source_col, min_group).checkpoint()
    whole, names = numbered(docs)
    feats = _keyed(with_features(whole, names[text_col]), names[lang_col], names[source_col])
    return restored(judge(feats, limits).where("kept"), names)


def _sql() -> str:
    """DuckDB text of the same rules, from the same constants."""
    values = ", ".join(
        f"{{'rule': '{r}', 'bin': least({top} * {scale} // greatest({below}, 1), {TOP_BIN})}}"
        for r, (top, below, scale, _, _) in RULES.items()
    )
    margin = " ".join(f"WHEN '{r}' THEN {RULES[r][3]}" for r in RULES)
    two = ", ".join(f"'{r}'" for r in RULES if RULES[r][4])

    def limits(name: str, keys: str, least: int) -> str:
        part = f"{keys}, rule" if keys else "rule"
        return f"""
{name} AS (
  SELECT {part}, CASE WHEN rule IN ({two}) THEN q1 - w ELSE -1 END AS low, q3 + w AS high FROM (
    SELECT {part}, q1, q3, (q3 - q1) * {FENCE} + CASE rule {margin} END AS w FROM (
      SELECT {part}, min(bin) FILTER (cum * 4 >= total) AS q1,
             min(bin) FILTER (cum * 4 >= total * 3) AS q3, max(total) AS total
      FROM (SELECT {part}, bin, sum(n) OVER (PARTITION BY {part} ORDER BY bin) AS cum,
                   sum(n) OVER (PARTITION BY {part}) AS total
            FROM (SELECT {part}, bin, count(*) AS n FROM sketch GROUP BY {part}, bin) a) b
      GROUP BY {part}) c
    WHERE total >= {least}) d)"""

    inside = " AND ".join(
        f"least({top} * {scale} // greatest({below}, 1), {TOP_BIN}) BETWEEN "
        f"coalesce(l.low_{r}, -1) AND coalesce(l.high_{r}, {TOP_BIN})"
        for r, (top, below, scale, _, _) in RULES.items()
    )
    sides = ", ".join(
        f"max(CASE WHEN rule = '{r}' THEN {side} END) AS {side}_{r}"
        for r in RULES
        for side in ("low", "high")
    )
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM docs),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM split) x),
hits AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) x WHERE c > 1),
covered AS (
  SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM hits) x GROUP BY rid),
feats AS (
  SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed
  FROM feats),
sketch AS (
  SELECT lang, source, v.rule AS rule, v.bin AS bin
  FROM (SELECT lang, source, unnest([{values}]) AS v FROM judged WHERE NOT base_failed) x),
{limits("own", "lang, source", MIN_GROUP)},{limits("by_lang", "lang", MIN_GROUP)},{limits("of_all", "", 1)},
picked AS (
  SELECT p.lang, p.source, r.rule, coalesce(o.low, b.low, a.low) AS low, coalesce(o.high, b.high, a.high) AS high
  FROM (SELECT DISTINCT lang, source FROM sketch) p
  CROSS JOIN (SELECT unnest([{", ".join(f"'{r}'" for r in RULES)}]) AS rule) r
  LEFT JOIN own o ON o.lang IS NOT DISTINCT FROM p.lang AND o.source IS NOT DISTINCT FROM p.source AND o.rule = r.rule
  LEFT JOIN by_lang b ON b.lang IS NOT DISTINCT FROM p.lang AND b.rule = r.rule
  LEFT JOIN of_all a ON a.rule = r.rule),
l AS (SELECT lang, source, {sides} FROM picked GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {inside} AS kept
FROM judged j LEFT JOIN l ON j.lang IS NOT DISTINCT FROM l.lang AND j.source IS NOT DISTINCT FROM l.source
"""


@register("op8_quality_rules", _sql())
def op8_quality_rules(spark, sf_dir):
    return quality_rules(read_table(spark, sf_dir, "documents"))
