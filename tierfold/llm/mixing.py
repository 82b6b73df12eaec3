"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the documents are dealt, by the leading
digits of the key, into ranges and sorted there; prefix sums of the ranges' word counts, taken over
two levels of digits, say how many words lie before each range. So no task ever holds a source, and
each source is cut at its exact budget: whole epochs first, then the first words in key order.
Weights and targets come from prefix sums over ranges of the sources, of which there may be any number.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierfold.llm.common import WORD, name_of, text_of, unboxed, with_text, written

WEIGHTS, MOST_EPOCHS = (1, 2, 3), 3
#: Hexadecimal digits of the key that tell the coarse and the fine ranges of a source.
COARSE, FINE = 3, 6


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share the total of all sizes;
    no target is above ``most`` times its source's size, and what is cut off is shared again by
    weight until none is above. Sources are filled up in the order of limit by weight: the share
    per unit of weight that is left after k of them are at their limit holds as soon as the next
    one stays below its limit.
    """
    named = F.col("source").asc_nulls_last()
    ranked = _running(sizes, "mix-names", [named], {"rank": F.lit(1)})
    turn = (F.col("rank") % len(weights) + 1).cast("int")
    sized = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long"))
    limit = F.col("source_size") * most
    sized = sized.withColumn("ratio", limit / F.col("weight"))
    # what the sources before this one in the order of limit by weight take and weigh
    order = [F.col("ratio").asc(), named]
    sums = {"limits": limit, "weights": F.col("weight")}
    sized = _running(sized.select("source", "source_size", "weight", "ratio"), "mix-ratios", order, sums)
    total = sized.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level = (F.lit(total[0]) - F.col("limits")) / (F.lit(total[1]) - F.col("weights"))
    level = sized.agg(F.max(F.when(level <= F.col("ratio"), level)).alias("level")).first()[0]
    level = F.lit(level).cast("double")
    target = F.when(F.col("ratio") <= level, limit.cast("double")).otherwise(level * F.col("weight"))
    return sized.select("source", "source_size", target.alias("target"))


def _running(df: DataFrame, purpose: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, per name of ``sums``, the sum over all rows that come before in ``order``.

    Rows are dealt over ranges of the order, as many as shuffle partitions, and written, since the
    bounds of ranges are drawn anew whenever they are computed. The ranges' own sums say what comes
    before each; only that table, one row a range, is put in order in one place.
    """
    ranged = written(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), purpose)
    upto = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    running = lambda of, window: F.coalesce(F.sum(of).over(upto(window)), F.lit(0))
    totals = ranged.groupBy("range").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    before = totals.select("range", *(running(F.col(n), Window.orderBy("range")).alias(f"before_{n}") for n in sums))
    within = Window.partitionBy("range").orderBy(*order)
    ranged = ranged.withColumns({n: running(c, within) for n, c in sums.items()}).join(before, "range")
    ranged = ranged.withColumns({n: F.col(n) + F.col(f"before_{n}") for n in sums})
    return ranged.drop("range", *(f"before_{n}" for n in sums))


def shuffle_key(doc_id: Column, text: Column) -> Column:
    """The hash-random key of a document, the same in every run: of its id, or of its text without one."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.md5(text)))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Adds ``size`` (words), ``source_size``, ``target`` and ``taken`` to every row of ``docs``.

    ``taken`` counts the words the mix takes of a document, repeats included: ``taken // size``
    whole copies and the first ``taken % size`` words once more. A null text has no words; a null
    source is a source. Rows that repeat an id are ordered by size, and equal ones stand for each
    other. An empty table gives an empty result. ``carry`` names the columns that the result needs,
    all unless given.
    """
    words = text_of(text)
    source = F.coalesce(F.concat(F.lit("="), name_of("source")), F.lit(""))  # a key without nulls
    key = shuffle_key(name_of("doc_id"), words)
    size = F.regexp_count(words, F.lit(WORD)).cast("long")
    row = F.struct(*(name_of(c) for c in carry or docs.columns)).alias("row")
    df = docs.select(row, size.alias("size"), source.alias("s"), name_of("source").alias("source"), key.alias("key"))
    df = df.withColumns({"coarse": F.substring("key", 1, COARSE), "fine": F.substring("key", 1, FINE)})
    df = written(df, "mix")
    fine = df.groupBy("s", "coarse", "fine").agg(F.sum("size").alias("words"), F.min("source").alias("source"))
    fine = written(fine, "mix-ranges")
    coarse = fine.groupBy("s", "coarse").agg(F.sum("words").alias("words"), F.min("source").alias("source"))
    sources = coarse.groupBy("s").agg(F.min("source").alias("source"), F.sum("words").alias("source_size"))
    sources = written(sources, "mix-sources")
    targets = source_targets(sources.drop("s"), weights, most)
    targets = targets.withColumn("s", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    before_coarse = F.coalesce(F.sum("words").over(earlier("s").orderBy("coarse")), F.lit(0))
    before_fine = F.coalesce(F.sum("words").over(earlier("s", "coarse").orderBy("fine")), F.lit(0))
    # a source meets its target as few rows, one a coarse range; the tables are broadcast if they are small
    coarse = coarse.select("s", "coarse", before_coarse.alias("before_coarse")).join(written(targets, "mix-targets"), "s")
    ranges = fine.select("s", "coarse", "fine", before_fine.alias("before_fine")).join(coarse, ["s", "coarse"])
    offset = F.col("before_coarse") + F.col("before_fine")
    ranges = ranges.select("s", "fine", offset.alias("offset"), "source_size", "target")
    within = F.sum("size").over(earlier("s", "fine").orderBy("key", "size"))
    df = df.withColumn("within", F.coalesce(within, F.lit(0))).drop("source", "coarse").join(ranges, ["s", "fine"])
    budget = F.expr("CAST(FLOOR(target) AS BIGINT)")
    epochs = F.expr("CASE WHEN source_size = 0 THEN 0L ELSE CAST(FLOOR(target) AS BIGINT) DIV source_size END")
    rest = budget - epochs * F.col("source_size") - F.col("offset") - F.col("within")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return unboxed(df.withColumn("taken", taken.cast("long")), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each copy of a document, and at the
    cut of a source a row with the first words of one. ``n_chars`` follows the text if there."""
    names = docs.columns
    row = F.struct(*(name_of(c) for c in names)).alias("document")
    mixed = mix(docs.select("doc_id", "text", "source", row), weights, most, carry=["document"]).where("taken > 0")
    mixed = mixed.withColumn("text", F.col("document.text"))
    size, taken = F.col("size"), F.col("taken")
    copies = F.ceil(taken / size).cast("int")
    mixed = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    part = taken - (F.col("copy") - 1) * size  # words left for this copy
    pieces = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    text = F.when(part < size, F.array_join(F.slice(pieces, 1, part.cast("int")), "")).otherwise(F.col("text"))
    return with_text(mixed.withColumn("new_text", text), "new_text", names)


#: The same for DuckDB, over documents with ids of their own.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, 3 * source_size / weight AS ratio FROM s
), l AS (
  SELECT *,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
      ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (
      ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM r
), m AS (
  SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER () AS even FROM l
), t AS (
  SELECT source, source_size,
    CASE WHEN ratio <= even THEN CAST(3 * source_size AS DOUBLE) ELSE even * weight END AS target
  FROM m
), p AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
    (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM p
"""
