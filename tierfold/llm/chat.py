"""Reply trees to chat text.

Messages point at the message they answer. Self-joins that double the distance of these pointers
find all ancestors of every leaf in a number of joins that grows with the logarithm of the depth;
they carry keys only. A path from root to leaf is ranked by the mean score of its messages, and each
chosen path becomes one conversation in a template that marks turns.

Texts may hold the template's own control strings. They are escaped in a way that can be undone, and
spans tell which characters the loss is taken over.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierfold.llm.common import name_of, text_of, written

START, END = "<|im_start|>", "<|im_end|>"
#: What each escaped string becomes, in the order of escaping.
ESCAPES = [("%", "%25"), ("<|", "%3C|")]
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _role(text: Column) -> Column:
    return F.replace(escaped(text), F.lit("\n"), F.lit("%0A"))


def _role_back(text: Column) -> Column:
    return unescaped(F.replace(text, F.lit("%0A"), F.lit("\n")))


def messages_from_turns(turns: DataFrame) -> DataFrame:
    """(tree, id, parent, role, text, score): rows (conv_id, turn, role, text) as trees of one
    branch, each turn an answer to the one before. Equal turns are ordered by role, then text;
    null turns come first, and rows without conv_id are one conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("n", F.row_number().over(order))
    return rows.select(
        F.col("conv_id").alias("tree"),
        F.col("n").cast("string").alias("id"),
        F.when(F.col("n") > 1, (F.col("n") - 1).cast("string")).alias("parent"),
        "role",
        "text",
        F.lit(1.0).alias("score"),
    )


def _paths(nodes: DataFrame) -> DataFrame:
    """(t, leaf, id, above): every message on the way from each leaf to its root."""
    known = nodes.select("t", F.col("id").alias("up"))
    step = written(nodes.select("t", "id", F.col("parent").alias("up")).join(known, ["t", "up"], "left_semi"), "replies")
    leaves = nodes.select("t", "id").join(step.select("t", F.col("up").alias("id")), ["t", "id"], "left_anti")
    most = nodes.groupBy("t").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    steps = []
    while not step.isEmpty():
        if 1 << len(steps) > most:
            raise ValueError("messages answer each other in a circle")
        steps.append(step)
        further = step.select("t", F.col("id").alias("up"), F.col("up").alias("further"))
        step = written(step.join(further, ["t", "up"]).select("t", "id", F.col("further").alias("up")), "replies")
    paths = leaves.select("t", F.col("id").alias("leaf"), "id", F.lit(0).alias("above"))
    for k in reversed(range(len(steps))):
        higher = paths.join(steps[k], ["t", "id"]).select("t", "leaf", F.col("up").alias("id"), F.col("above") + (1 << k))
        paths = written(paths.union(higher), "paths")
    return paths


def format_conversations(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, leaf, score, formatted, loss_spans) of the best ``per_tree`` paths of each tree.

    ``messages`` has tree, id, parent, role, text and score. A message whose parent is null or
    missing is a root. Of messages that repeat tree and id, one stays, the least by its other
    columns. Null texts and roles are empty, null scores zero, and a null tree is a tree. Paths of
    equal score are ranked by leaf id. Messages that answer each other in a circle raise an error.
    ``loss_spans`` holds start and length, in characters of ``formatted``, of each assistant text.
    An empty table gives an empty result.
    """
    t = F.coalesce(F.concat(F.lit("="), name_of("tree").cast("string")), F.lit("")).alias("t")
    text = lambda c: F.coalesce(name_of(c).cast("string"), F.lit(""))
    score = F.coalesce(name_of("score").cast("double"), F.lit(0.0)).alias("score")
    parent = name_of("parent").cast("string").alias("parent")
    rows = messages.select(t, text("id").alias("id"), F.struct(parent, text("role").alias("role"), text_of().alias("text"), score, name_of("tree").alias("tree")).alias("m"))
    rows = written(rows.groupBy("t", "id").agg(F.min("m").alias("m")).select("t", "id", "m.*"), "messages")
    paths = _paths(rows.select("t", "id", "parent"))
    scored = paths.join(rows.select("t", "id", "score"), ["t", "id"]).groupBy("t", "leaf").agg(F.avg("score").alias("rank_by"))
    best = Window.partitionBy("t").orderBy(F.col("rank_by").desc(), "leaf")
    chosen = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_tree)
    chosen = written(chosen.select("t", "leaf", F.col("rank_by").alias("path_score")), "chosen")
    turns = paths.join(chosen, ["t", "leaf"]).join(rows.drop("score"), ["t", "id"])
    role, said = _role(F.col("role")), escaped(F.col("text"))
    turns = turns.select("t", "leaf", "tree", "path_score", "above", "role", F.concat(F.lit(START), role, F.lit("\n")).alias("head"), said.alias("said"))
    length = F.length("head") + F.length("said") + len(END) + 1
    order = Window.partitionBy("t", "leaf").orderBy(F.col("above").desc())
    start = F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = turns.withColumn("start", (start + F.length("head")).cast("long"))
    span = F.struct("start", F.length("said").cast("long").alias("length"))
    piece = F.struct((-F.col("above")).alias("at"), F.concat("head", "said", F.lit(f"{END}\n")).alias("piece"))
    grouped = turns.groupBy("t", "leaf").agg(
        F.min("tree").alias("tree"),
        F.min("path_score").alias("score"),
        F.sort_array(F.collect_list(piece)).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role") == LEARNED, span))).alias("loss_spans"),
    )
    formatted = F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("formatted")
    return grouped.select("tree", "leaf", "score", formatted, "loss_spans")


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    blocks = F.split(formatted, r"<\|im_end\|>\n")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turn(block: Column) -> Column:
        body = F.substr(block, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        return F.struct(_role_back(role).alias("role"), unescaped(F.substr(body, F.length(role) + 2)).alias("text"))

    return F.transform(blocks, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    part = lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(spans, part), "")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the output of :func:`format_conversations` holds when it is read back."""
    df = formatted.select("tree", "formatted", turns_of(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return df.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The same for DuckDB.
CHAT_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, length(replace(replace(text, '%', '%25'), '<|', '%3C|'))
    + length(replace(replace(replace(role, '%', '%25'), '<|', '%3C|'), chr(10), '%0A')) + 24 AS chars
  FROM c
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""
