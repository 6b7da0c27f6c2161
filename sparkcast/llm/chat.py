"""Chat formatting of reply trees.

Turns are nodes of reply trees (a parent id, or NULL at the root). Iterative
self-joins by pointer doubling give every node its root, depth and summed
score: after k joins a node has looked 2^k ancestors up, so a tree of depth d
takes log2(d) + 1 joins. Leaves are ranked within their tree by mean score
along the path, the chosen leaves' ancestors are enumerated by doubling again,
and each chosen root-to-leaf path becomes one formatted conversation.

Template: ``<|role|>`` line, text, ``<|end|>`` line for each turn, between
``<s>`` and ``</s>`` lines. Control strings inside roles and texts are made
harmless by a backslash after their first character; a control string that
already holds n backslashes there gets n + 1, so unescaping is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.llm.queries import register
from sparkcast.llm.shared import partitions, read_table

#: Control strings of this template and of common others, without their first
#: character, as patterns.
_CONTROL = r"(?:\||/?s>|/?INST\]|</?SYS>>)"
_ESCAPE = rf"([<\[])(\\*)({_CONTROL})"
_UNESCAPE = rf"([<\[])\\(\\*)({_CONTROL})"

OPEN, CLOSE = "<s>\n", "</s>\n"
END = "<|end|>\n"
#: The role whose texts are trained on.
LEARNED = "assistant"


def escape(text):
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text):
    return F.regexp_replace(text, _UNESCAPE, r"$1$2$3")


def escape_role(role):
    """Roles also lose the end of their own mark."""
    return F.regexp_replace(escape(role), r"(\|)(\\*)(>)", r"$1\\$2$3")


def unescape_role(role):
    return unescape(F.regexp_replace(role, r"(\|)\\(\\*)(>)", r"$1$2$3"))


def chain_nodes(
    turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"
) -> DataFrame:
    """Rows by turn as reply trees without branches.

    Turns follow one another by (turn, role, text), NULL first; a repeated
    row is a turn of its own. A NULL conversation id is one conversation.
    """
    order = Window.partitionBy(conv_col).orderBy(turn_col, role_col, text_col)
    return turns.select(
        F.col(conv_col).alias("tree"),
        (F.row_number().over(order) - 1).cast("long").alias("node"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
        F.lit(1.0).alias("score"),
    ).withColumn("parent", F.when(F.col("node") > 0, F.col("node") - 1))


def _same(a: str, b: str, *cols: str):
    cond = F.lit(True)
    for c in cols:
        x, y = c.split("=") if "=" in c else (c, c)
        cond = cond & F.col(f"{a}.{x}").eqNullSafe(F.col(f"{b}.{y}"))
    return cond


def node_paths(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, depth, path_score, leaf), and the 2^k-step pointers found.

    ``depth`` is 0 at a root. A parent that is not in the table makes the node
    a root; nodes on a cycle never reach a root and are left out.
    """
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("_known"))
    ptr = (
        nodes.alias("n")
        .join(known.alias("k"), _same("n", "k", "tree") & (F.col("n.parent") == F.col("k.parent")), "left")
        .select(
            "n.tree",
            "n.node",
            F.when(F.col("k._known"), F.col("n.parent")).alias("up"),
            F.coalesce(F.col("n.score"), F.lit(0.0)).alias("total"),
        )
        .withColumn("dist", F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long"))
        .withColumn("parent", F.col("up"))
        .checkpoint()
    )
    levels: list[DataFrame] = []
    size = None
    while True:
        active = ptr.where(F.col("up").isNotNull())
        left = active.count()
        if left in (0, size):  # all at their root, or only cycles left
            break
        size = left
        levels.append(active.select("tree", "node", "up"))
        above = ptr.select("tree", "node", "up", "total", "dist")
        # only nodes still below their root are joined again
        moved = (
            active.alias("a")
            .join(above.alias("b"), _same("a", "b", "tree") & (F.col("a.up") == F.col("b.node")))
            .select(
                "a.tree",
                "a.node",
                "a.parent",
                F.col("b.up").alias("up"),
                (F.col("a.total") + F.col("b.total")).alias("total"),
                (F.col("a.dist") + F.col("b.dist")).alias("dist"),
            )
        )
        ptr = moved.unionByName(ptr.where(F.col("up").isNull()).select(*moved.columns)).checkpoint()
    inner = ptr.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    out = (
        ptr.where(F.col("up").isNull())
        .alias("p")
        .join(inner.withColumn("_inner", F.lit(True)).alias("i"), _same("p", "i", "tree") & (F.col("p.node") == F.col("i.node")), "left")
        .select("p.tree", "p.node", F.col("p.dist").alias("depth"), F.col("p.total").alias("path_score"),
                F.col("i._inner").isNull().alias("leaf"))
    )
    return out, levels


def chosen_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, node): the nodes of each tree's ``best`` branches.

    Branches rank by mean score along the path, then length (longer first),
    then leaf id.
    """
    paths, levels = node_paths(nodes)
    rank = F.row_number().over(
        Window.partitionBy("tree").orderBy(
            (F.col("path_score") / (F.col("depth") + 1)).desc(), F.col("depth").desc(), "node"
        )
    )
    leaves = (
        paths.where("leaf").withColumn("rank", rank).where(F.col("rank") <= best)
    )
    on_path = leaves.select("tree", F.col("node").alias("leaf"), "rank", "node")
    # From 2^k-step pointers, largest first: every node found so far adds the
    # one 2^k above it, and so each ancestor is met exactly once.
    for level in reversed(levels):
        more = (
            on_path.alias("a")
            .join(level.alias("b"), _same("a", "b", "tree") & (F.col("a.node") == F.col("b.node")))
            .select("a.tree", "a.leaf", "a.rank", F.col("b.up").alias("node"))
        )
        on_path = on_path.unionByName(more).checkpoint()
    return on_path.alias("o").join(
        paths.alias("p"), _same("o", "p", "tree") & (F.col("o.node") == F.col("p.node"))
    ).select("o.tree", "o.leaf", "o.rank", "o.node", "p.depth")


def format_trees(nodes: DataFrame, best: int = 1) -> DataFrame:
    """One conversation per chosen path: (tree, rank, n_turns, formatted, loss_spans).

    ``nodes`` has tree, node, parent, role, text, score. NULL roles and texts
    are empty, NULL scores 0. ``loss_spans`` are (start, length) code-point
    ranges of the learned turns' texts in ``formatted``. One path is one row;
    nothing larger than a path is ever gathered. Repeated (tree, node) ids are
    not allowed. An empty table gives an empty table.
    """
    turns = nodes.select(
        "tree",
        "node",
        escape_role(F.coalesce(F.col("role"), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    )
    path = Window.partitionBy("tree", "rank").orderBy("depth")
    piece = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n" + END))
    before = F.sum("size").over(path.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)) + len(OPEN) + F.length("role") + len("<||>\n")
    rows = (
        chosen_paths(nodes, best)
        .alias("p")
        .join(turns.alias("t"), _same("p", "t", "tree") & (F.col("p.node") == F.col("t.node")))
        .select("p.tree", "p.rank", "p.depth", "t.role", "t.text")
        .withColumn("piece", piece)
        .withColumn("size", F.length("piece").cast("long"))
        .withColumn("start", start.cast("long"))
        .withColumn("length", F.length("text").cast("long"))
        .withColumn("learned", F.col("role") == LEARNED)
    )
    return (
        rows.groupBy("tree", "rank")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("depth", "piece", "learned", "start", "length"))
            ).alias("turns")
        )
        .select(
            "tree",
            "rank",
            F.size("turns").cast("long").alias("n_turns"),
            F.concat(F.lit(OPEN), F.array_join("turns.piece", ""), F.lit(CLOSE)).alias("formatted"),
            F.transform(
                F.filter("turns", lambda t: t["learned"]),
                lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
            ).alias("loss_spans"),
        )
    )


def parse_turns(formatted):
    """Array of (role, text), unescaped, read from a formatted conversation."""
    inner = F.substring(
        formatted, F.lit(len(OPEN) + 1), F.length(formatted) - len(OPEN) - len(CLOSE)
    )
    parts = F.split(inner, r"\n<\|end\|>\n")  # the last part is empty
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(p):
        cut = F.locate("|>\n", p)
        return F.struct(
            unescape_role(F.substring(p, F.lit(3), cut - 3)).alias("role"),
            unescape(F.substring(p, cut + 3, F.length(p))).alias("text"),
        )

    return F.transform(parts, turn)


def loss_text(formatted, spans):
    """Everything under the loss mask, unescaped span by span."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )


SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         role AS r0, text AS t0 FROM conversations
  UNION ALL VALUES
    (-7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'),
    (-7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]')),
pieces AS (
  SELECT *, length(regexp_replace(regexp_replace(role, '{_ESCAPE}', '\1\\\2\3', 'g'),
                                  '(\|)(\\*)(>)', '\1\\\2\3', 'g'))
            + length(regexp_replace(text, '{_ESCAPE}', '\1\\\2\3', 'g'))
            + {len("<||>" + chr(10) * 2 + END)} AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, t0 NULLS FIRST) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
       CAST(sum(chars) + {len(OPEN + CLOSE)} AS BIGINT) AS formatted_chars
FROM pieces GROUP BY conv_id
"""


@register("op9_reply_trees", SQL)
def op9_reply_trees(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)], turns.schema
    )
    out = format_trees(chain_nodes(turns.unionByName(extra)))
    read = out.select(
        F.col("tree").alias("conv_id"),
        parse_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    flat = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
