"""Line deduplication by log templates.

A tree of fixed depth sorts lines by their number of words and then by their leading words, words
with digits standing as a wildcard. Within a leaf, a word that few lines have at its place is a
variable field, so lines that differ only there share a template. Templates found in many documents
are boilerplate: each of their lines goes, but for the very first one. A line without variable fields
is a template of its own, which recurs as soon as two documents hold it word for word.

Every step is a grouping or an equi-join. Whole lines are counted by a 128-bit hash. Only lines whose
leaf occurs in enough documents are taken apart into words. Hot lines, leaves and templates are counted in part before they are shuffled, and
joined as plain shuffles whose large partitions Spark splits.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import (
    WORD,
    boxed,
    document_key,
    drop_written,
    let,
    name_of,
    text_of,
    unboxed,
    with_text,
    words,
    written,
)

WILDCARD = "<*>"


@dataclass(frozen=True)
class LineRules:
    """depth: leading words of the tree. min_documents: from how many documents on a word is
    constant and a template with variable fields recurs. min_words: shorter lines have none.
    constant: least share of a line's words that must be constant. Lines that are equal as a whole
    recur from two documents on, however short."""

    depth: int = 3
    min_documents: int = 5
    min_words: int = 5
    constant: float = 0.5


def masked(word: Column) -> Column:
    return F.when(word.rlike("[0-9]"), F.lit(WILDCARD)).otherwise(word)


def _document_lines(df: DataFrame, rules: LineRules) -> DataFrame:
    """(k1, k2, doc_id, pos, line, leaf) of the lines with a word; leaf is null for short ones."""
    lines = df.select("k1", "k2", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))

    def leaf(found: Column) -> Column:
        leading = F.transform(F.slice(found, 1, rules.depth), masked)
        return F.when(F.size(found) >= rules.min_words, F.concat_ws(" ", F.size(found), F.array_join(leading, " ")))

    lines = lines.where(F.col("line").rlike(WORD))
    return lines.withColumn("leaf", let(words(F.col("line")), leaf))


def _place() -> Column:
    """What orders lines: ids, nulls last, then the place in the text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k2", "pos")


def _equal_lines(lines: DataFrame) -> DataFrame:
    """(k1, k2, pos) of the lines that two or more documents hold word for word, but the first."""
    by = ["h1", "h2"]
    hashed = lines.select(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"), "k1", "k2", "doc_id", "pos"
    )
    ends = [f(k).alias(f"{f.__name__}_{k}") for k in ("k1", "k2") for f in (F.min, F.max)]
    in_two = (F.col("min_k1") != F.col("max_k1")) | (F.col("min_k2") != F.col("max_k2"))
    equal = written(hashed.groupBy(*by).agg(*ends).where(in_two).select(*by), "equal-lines")
    places = written(hashed.join(equal, by), "equal-line-places")
    first = places.groupBy(*by).agg(F.min(_place()).alias("first"))
    later = places.join(first, by).where(~_place().eqNullSafe(F.col("first")))
    return later.select("k1", "k2", "pos")


def _in_many(df: DataFrame, rules: LineRules, *by: str) -> DataFrame:
    """The values of ``by`` that occur in enough documents."""
    once = df.select(*by, "k1", "k2").distinct()
    return once.groupBy(*by).agg(F.count("*").alias("documents")).where(F.col("documents") >= rules.min_documents)


def _templates(lines: DataFrame, rules: LineRules) -> DataFrame:
    """(leaf, line, template): null where too little of the line is constant."""
    weighed = lines.select("leaf", "line", "k1", "k2").distinct().groupBy("leaf", "line").agg(F.count("*").alias("n"))
    weighed = written(weighed.withColumn("id", F.monotonically_increasing_id()), "lines")
    place = weighed.select("id", "leaf", "n", F.posexplode(words(F.col("line"))).alias("at", "word"))
    place = place.withColumn("word", masked(F.col("word")))
    support = place.groupBy("leaf", "at", "word").agg(F.sum("n").alias("support"))
    support = support.where((F.col("support") >= rules.min_documents) & (F.col("word") != WILDCARD))
    place = place.drop("n").join(written(support, "words"), ["leaf", "at", "word"], "left")
    shown = F.when(F.col("support").isNull(), F.lit(WILDCARD)).otherwise(F.col("word"))
    ordered = F.sort_array(F.collect_list(F.struct("at", shown.alias("word"))))
    enough = F.count("support") >= rules.constant * F.count("*")
    made = place.groupBy("id").agg(F.when(enough, F.array_join(F.transform(ordered, lambda x: x["word"]), " ")).alias("template"))
    return weighed.join(made, "id").select("leaf", "line", "template")


def _dropped(df: DataFrame, rules: LineRules) -> DataFrame:
    """(k1, k2, gone): the places of the lines that a document loses."""
    all_lines = written(_document_lines(df, rules), "document-lines")
    equal = written(_equal_lines(all_lines), "equal-lines-gone")
    long = all_lines.where("leaf IS NOT NULL")
    leaves = written(_in_many(long, rules, "leaf"), "leaves")
    candidates = written(long.join(leaves.select("leaf"), "leaf"), "candidate-lines")
    drop_written(all_lines, leaves)
    templates = written(_templates(candidates, rules).where("template IS NOT NULL"), "templates")
    lines = written(candidates.join(templates, ["leaf", "line"]).drop("line"), "template-lines")
    recurring = _in_many(lines, rules, "leaf", "template").select("leaf", "template")
    first = lines.groupBy("leaf", "template").agg(F.min(_place()).alias("first"))
    first = written(first.join(recurring, ["leaf", "template"]), "first-lines")
    gone = lines.join(first, ["leaf", "template"]).where(~_place().eqNullSafe(F.col("first")))
    gone = gone.select("k1", "k2", "pos").union(equal)
    gone = written(gone.groupBy("k1", "k2").agg(F.collect_set("pos").alias("gone")), "gone")
    drop_written(candidates, templates, lines, first, equal)
    return gone


def _without_lines(docs: DataFrame, rules: LineRules) -> DataFrame:
    """(row, new, n_lines, n_dropped) for each row of ``docs``."""
    keys = document_key(name_of("doc_id"), name_of("text"))
    gone = _dropped(docs.select(*(c.alias(k) for k, c in keys.items()), "doc_id", text_of().alias("text")), rules)
    df = boxed(docs, **keys).join(gone, ["k1", "k2"], "left").withColumn("old", F.col("row.text"))
    lines = F.split("old", "\n")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    left = let(lines, lambda all_: F.array_join(F.transform(places, lambda i: F.get(all_, i)), "\n"))
    return df.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("old")).otherwise(left).alias("new"),
        F.when(F.col("old").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def line_dedup(docs: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """``docs`` with the text of each row without its dropped lines, and ``n_lines`` and
    ``n_dropped``, the lines it had and lost.

    Lines are what ``\\n`` separates; the first line of a template, and the first of equal lines, by
    doc_id (nulls last) and place, stays. Lines without a word stay. A null text stays null and has no lines, an empty one has one. Rows that repeat
    both id and text are one document and lose the same lines. An empty table gives an empty
    result. Input columns named like the added ones give way to them.
    """
    df = _without_lines(docs, rules or LineRules())
    return unboxed(df, "n_lines", "n_dropped", replace={"text": "new"})


def documents_without_lines(docs: DataFrame, rules: LineRules | None = None) -> DataFrame:
    """:func:`line_dedup` with the columns of ``docs``; ``n_chars`` follows the text if there."""
    df = _without_lines(docs, rules or LineRules()).withColumnRenamed("row", "document")
    return with_text(df, "new", docs.columns)


#: The same for DuckDB, over documents with ids of their own.
LINE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents
), w AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM l
), f AS (
  SELECT doc_id, pos, line, words, concat_ws(' ', len(words), array_to_string(list_transform(words[1:3],
    lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END), ' ')) AS leaf
  FROM w WHERE len(words) >= 5
), c AS (
  SELECT * FROM f WHERE leaf IN (SELECT leaf FROM f GROUP BY leaf HAVING count(DISTINCT doc_id) >= 5)
), n AS (
  SELECT leaf, line, any_value(words) AS words, count(DISTINCT doc_id) AS n FROM c GROUP BY leaf, line
), p AS (
  SELECT leaf, line, n, unnest(range(len(words))) AS place, unnest(words) AS raw FROM n
), m AS (
  SELECT *, CASE WHEN regexp_matches(raw, '[0-9]') THEN '<*>' ELSE raw END AS word FROM p
), s AS (
  SELECT *, word <> '<*>' AND sum(n) OVER (PARTITION BY leaf, place, word) >= 5 AS constant FROM m
), t AS (
  SELECT leaf, line, string_agg(CASE WHEN constant THEN word ELSE '<*>' END, ' ' ORDER BY place) AS template
  FROM s GROUP BY leaf, line HAVING count(*) FILTER (constant) >= 0.5 * count(*)
), o AS (
  SELECT c.doc_id, c.pos, c.leaf, t.template FROM c JOIN t ON c.leaf = t.leaf AND c.line = t.line
), r AS (
  SELECT leaf, template, min((doc_id, pos)) AS first FROM o
  GROUP BY leaf, template HAVING count(DISTINCT doc_id) >= 5
), e AS (
  SELECT line, min((doc_id, pos)) AS first FROM w WHERE len(words) > 0
  GROUP BY line HAVING count(DISTINCT doc_id) >= 2
), g AS (
  SELECT o.doc_id, o.pos FROM o JOIN r ON o.leaf = r.leaf AND o.template = r.template
  WHERE (o.doc_id, o.pos) <> r.first
  UNION SELECT w.doc_id, w.pos FROM w JOIN e ON w.line = e.line WHERE (w.doc_id, w.pos) <> e.first
), k AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL) AS kept,
         count(*) AS n_lines, count(g.pos) AS n_dropped
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
