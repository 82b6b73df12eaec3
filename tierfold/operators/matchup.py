"""Two-sided records: unpivoting, name resolution, opponent pairing and win rates.

A record (bout) names two competitors, A and B. Attributes of a competitor are found by name, and
one name may belong to several entities. Instead of producing every entity combination, pairs are
counted by name first, and each name carries its distinct attribute values with the number of
entities behind them; pairs carry a ``weight``. Sums of weights equal the counts of the fully
expanded pairs. Attributes are attached to the counted pairs of names, one side after the other
with counts in between, so namesakes multiply counts and not records. A pair is carried once, A
against B with both results, and turned round when nothing is left but attribute values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.functions.numbers import safe_ratio


def unpivot_sides(
    df: DataFrame, common: Sequence[str], sides: dict[str, dict[str, str]]
) -> DataFrame:
    """Wide to long in one scan: one row per side, with the side's columns renamed alike.

    ``sides`` maps a side label to {output column: input column}.
    """
    packed = [
        F.struct(F.lit(label).alias("side"), *(F.col(c).alias(out) for out, c in columns.items()))
        for label, columns in sides.items()
    ]
    return df.select(*common, F.inline(F.array(*packed)))


FIGHTER_SIDES = {
    "A": {"athlete_name": "fighter_a_name", "is_winner": "fighter_a_winner"},
    "B": {"athlete_name": "fighter_b_name", "is_winner": "fighter_b_winner"},
}


def _names(name_columns: Sequence[str]) -> Column:
    return F.array_distinct(F.array_compact(F.array(*(F.lower(F.col(c)) for c in name_columns))))


def name_rows(entities: DataFrame, name_columns: Sequence[str], *columns: str) -> DataFrame:
    """(name, *columns): one row per distinct lower-case name of each entity."""
    return entities.select(F.explode(_names(name_columns)).alias("name"), *columns)


def name_index(entities: DataFrame, name_columns: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """(name, *attrs, copies): how many entities of that name share those attribute values."""
    return (
        name_rows(entities, name_columns, *attrs)
        .groupBy("name", *attrs)
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def resolve_by_name(
    rows: DataFrame,
    entities: DataFrame,
    name: str,
    name_columns: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Left join on any of an entity's names, ignoring case.

    "name equals this one OR that one" would be a nested-loop join; one row per distinct name
    makes it an equi-join with the same result, also when both names match the same entity.
    """
    named = name_rows(entities, name_columns, *columns).withColumnRenamed("name", "_name")
    return rows.join(named, F.lower(F.col(name)) == F.col("_name"), "left").drop("_name")


def _named(rows: DataFrame, name: str, index: DataFrame) -> DataFrame:
    """Left join of ``rows`` with an index on its ``name``. Rows whose name is missing get a key of
    their own from their other columns, or they would all meet in one shuffle partition."""
    own = F.concat(F.lit("no name "), F.xxhash64(*rows.columns).cast("string"))
    keyed = rows.withColumn("_key", F.coalesce(F.col(name), own))
    side = index.withColumnRenamed("name", "_match")
    return keyed.join(side, F.col("_key") == F.col("_match"), "left").drop("_key", "_match")


def _resolved(
    rows: DataFrame, index: DataFrame, name: str, attrs: Sequence[str], prefix: str
) -> DataFrame:
    """``rows`` with the attributes of a name, their ``weight`` multiplied by the copies."""
    side = index.select("name", *(F.col(a).alias(f"{prefix}{a}") for a in attrs), "copies")
    weight = F.col("weight") * F.coalesce("copies", F.lit(1))
    return _named(rows, name, side).withColumn("weight", weight).drop("copies")


def _counted(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("weight").alias("weight"))


@dataclass(frozen=True)
class KeySplit:
    """Records whose key is theirs alone, and records that share theirs."""

    own: DataFrame
    shared: DataFrame


RESULTS = ["is_winner", "opp_winner"]


def _one() -> Column:
    return F.lit(1).cast("long")


def name_pairs(bouts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(*dims, name, opp_name, is_winner, opp_winner, weight): each record's own A and B, counted
    in the one order."""
    a, b = F.lower("fighter_a_name").alias("name"), F.lower("fighter_b_name").alias("opp_name")
    won = F.col("fighter_a_winner").alias("is_winner"), F.col("fighter_b_winner").alias("opp_winner")
    rows = bouts.select(*dims, a, b, *won, _one().alias("weight"))
    return _counted(rows, *dims, "name", "opp_name", *RESULTS)


def _both_ways(
    rows: DataFrame, dims: Sequence[str], mine: Sequence[Column], theirs: Sequence[Column]
) -> DataFrame:
    """Each row as a row of its own competitor and as one of the opponent's."""
    won = [F.col(c).alias("is_winner") for c in RESULTS]
    return rows.select(*dims, "weight", F.inline(F.array(F.struct(*mine, won[0]), F.struct(*theirs, won[1]))))


def attributed(pairs: DataFrame, index: DataFrame, attrs: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """Counted pairs of names as weighted pairs of attribute values, in both orders."""
    mine = _counted(_resolved(pairs, index, "name", attrs, ""), *dims, *attrs, "opp_name", *RESULTS)
    both = _resolved(mine, index, "opp_name", attrs, "opp_")

    def columns(me: str, you: str) -> list[Column]:
        return [*(F.col(f"{me}{a}").alias(a) for a in attrs), *(F.col(f"{you}{a}").alias(f"opp_{a}") for a in attrs)]

    return _both_ways(both, dims, columns("", "opp_"), columns("opp_", "")).select(
        *dims, *attrs, *(f"opp_{a}" for a in attrs), "is_winner", "weight"
    )


def pair_opponents(
    rows: DataFrame,
    key: str,
    side: str,
    own: Sequence[str],
    opponent: Sequence[str],
    weight: str | None = None,
) -> DataFrame:
    """Rows facing each other: same key, different side, across records.

    Each side is first reduced to its distinct values with a weight, so a key shared by very many
    rows joins a few summary rows per side and not all rows with all rows. Opponent columns get
    the prefix ``opp_``; ``weight`` counts the underlying pairs.
    """
    amount = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    mine = rows.groupBy(key, side, *own).agg(amount.alias("_mine"))
    yours = (
        rows.groupBy(key, side, *opponent)
        .agg(amount.alias("_yours"))
        .select(
            F.col(key).alias("_key"),
            F.col(side).alias(f"opp_{side}"),
            *(F.col(c).alias(f"opp_{c}") for c in opponent),
            "_yours",
        )
    )
    facing = (F.col(key) == F.col("_key")) & (F.col(side) != F.col(f"opp_{side}"))
    return mine.join(yours, facing).select(
        key,
        side,
        f"opp_{side}",
        *own,
        *(f"opp_{c}" for c in opponent),
        (F.col("_mine") * F.col("_yours")).alias("weight"),
    )


def _side_values(
    bouts: DataFrame, index: DataFrame, attrs: Sequence[str], dims: Sequence[str], key: str
) -> DataFrame:
    """(key, *dims, side, is_winner, *attrs, weight): the competitors of each key, counted."""
    rows = unpivot_sides(bouts, [key, *dims], FIGHTER_SIDES).select(
        key, *dims, "side", "is_winner", F.lower("athlete_name").alias("name"), _one().alias("weight"),
    )
    found = _resolved(_counted(rows, key, "side", *dims, "name", "is_winner"), index, "name", attrs, "")
    return _counted(found, key, *dims, "side", "is_winner", *attrs)


def _facing(
    bouts: DataFrame, index: DataFrame, attrs: Sequence[str], dims: Sequence[str], key: str
) -> DataFrame:
    """(*dims, *attrs, is_winner, weight, values): the competitors of each key, counted, each with
    the counted attribute values of all its opponents, whichever records they are in.

    A key is one row of its distinct values, however many records share it.
    """
    rows = _side_values(bouts, index, attrs, dims, key)
    own = F.struct(*dims, *attrs, "is_winner", "weight")
    value = F.struct(*attrs, F.col("weight").alias("copies"))
    lists = rows.groupBy(key).agg(
        *(F.collect_list(F.when(F.col("side") == s, own)).alias(f"own_{s}") for s in FIGHTER_SIDES),
        *(F.collect_list(F.when(F.col("side") != s, value)).alias(f"facing_{s}") for s in FIGHTER_SIDES),
    )
    sides = (F.struct(F.col(f"own_{s}").alias("own"), F.col(f"facing_{s}").alias("values")) for s in FIGHTER_SIDES)
    found = lists.select(F.inline(F.array(*sides))).select(F.explode("own").alias("own"), "values")
    return found.select("own.*", "values")


def pairs_across_records(
    bouts: DataFrame, index: DataFrame, attrs: Sequence[str], dims: Sequence[str], key: str
) -> DataFrame:
    """Pairs of all A rows with all B rows of a key, as weighted rows of attribute values."""
    found = _facing(bouts, index, attrs, dims, key)
    long = found.select(*dims, *attrs, "is_winner", "weight", F.explode("values").alias("opp"))
    theirs = [F.col(f"opp.{a}").alias(f"opp_{a}") for a in attrs]
    return long.select(*dims, *attrs, *theirs, "is_winner", (F.col("weight") * F.col("opp.copies")).alias("weight"))


def shared_keys(bouts: DataFrame, key: str = "competition_id") -> DataFrame:
    """(_shared): the keys that more than one record has."""
    return bouts.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(F.col(key).alias("_shared"))


def split_by_key(bouts: DataFrame, key: str = "competition_id", shared: DataFrame | None = None) -> KeySplit:
    """Tell records that share their key from the others: a lazy plan, whose join the optimizer
    chooses. Records without a key face nobody. ``shared`` are the :func:`shared_keys`, if they were
    stored for several uses."""
    if shared is None:
        shared = shared_keys(bouts, key)
    marked = bouts.where(F.col(key).isNotNull()).join(shared, F.col(key) == F.col("_shared"), "left")
    return KeySplit(
        marked.where("_shared IS NULL").drop("_shared"), marked.where("_shared IS NOT NULL").drop("_shared")
    )


def _split(bouts: DataFrame | KeySplit, key: str) -> KeySplit:
    return bouts if isinstance(bouts, KeySplit) else split_by_key(bouts, key)


def weighted_pairs(
    bouts: DataFrame | KeySplit,
    index: DataFrame,
    attrs: Sequence[str],
    dims: Sequence[str] = (),
    key: str = "competition_id",
) -> DataFrame:
    """Every competitor against every opponent of the same key, as weighted rows of attribute values.

    A record's own pair is in the record and is counted by names. Records that share a key give all
    pairs of that key instead, by a join of summary rows.
    """
    split = _split(bouts, key)
    own = attributed(name_pairs(split.own, dims), index, attrs, dims)
    return own.unionByName(pairs_across_records(split.shared, index, attrs, dims, key))


#: Whole numbers to be binned, as a struct, from the own and the opponent's attributes.
Measures = Callable[[Column, Column], Column]


def _low(value: Column, edges: Sequence[int]) -> Column:
    """Lower edge of the bin of a clipped value."""
    below = [F.when(value >= e, F.lit(e)) for e in edges[:-1]]
    return F.greatest(*below) if len(below) > 1 else below[0]


def _binned(
    rows: DataFrame, attrs: Sequence[str], dims: Sequence[str], measures: Measures, edges: dict[str, Sequence[int]]
) -> DataFrame:
    """Rows that carry their opponents' values as one array, as counted rows of bins, a bin being
    its lower edge. Rows that are ``mirrored`` also tell what their opponents see.

    Each value is a row only within its task, where the bins are counted before they travel.
    """
    long = rows.select(*dims, *RESULTS, "mirrored", "weight", F.struct(*attrs).alias("me"), F.explode("values").alias("you"))
    me, you = F.col("me"), F.col("you")
    measured = long.select(
        *dims, *RESULTS, "mirrored", (F.col("weight") * F.col("you.copies")).alias("weight"),
        measures(me, you).alias("mine"), measures(you, me).alias("theirs"),
    )

    def way(won: str, bins: str) -> Column:
        low = (_low(F.col(f"{bins}.{c}"), e).alias(c) for c, e in edges.items())
        return F.struct(*low, F.col(won).alias("is_winner"))

    mine, theirs = way("is_winner", "mine"), F.when(F.col("mirrored"), way("opp_winner", "theirs"))
    each = measured.select(*dims, "weight", F.explode(F.array(mine, theirs)).alias("way")).where("way IS NOT NULL")
    return _counted(each.select(*dims, "way.*", "weight"), *dims, *edges, "is_winner")


def binned_pairs(
    bouts: DataFrame | KeySplit,
    index: DataFrame,
    attrs: Sequence[str],
    measures: Measures,
    edges: dict[str, Sequence[int]],
    dims: Sequence[str] = (),
    key: str = "competition_id",
) -> DataFrame:
    """Pairs as counted rows of bins of both sides' values, for attributes that have many.

    ``edges`` gives the bins of each field of ``measures``; a bin is its lower edge.
    """
    split = _split(bouts, key)
    kinds = index.schema
    nobody = F.array(F.struct(*(F.lit(None).cast(kinds[a].dataType).alias(a) for a in attrs), _one().alias("copies")))
    held = F.collect_list(F.struct(*attrs, "copies")).alias("values")
    mine = _resolved(name_pairs(split.own, dims), index, "name", attrs, "")
    mine = _counted(mine, *dims, *attrs, "opp_name", *RESULTS)
    own = _named(mine, "opp_name", index.groupBy("name").agg(held))
    own = own.withColumns({"values": F.coalesce("values", nobody), "mirrored": F.lit(True)}).drop("opp_name")
    shared = _facing(split.shared, index, attrs, dims, key)
    shared = shared.withColumns({"opp_winner": F.lit(None).cast("boolean"), "mirrored": F.lit(False)})
    return _binned(own.unionByName(shared.select(own.columns)), attrs, dims, measures, edges)


def _wins(flag: str, weight: str | None) -> Column:
    return F.sum(F.when(F.col(flag), F.col(weight) if weight else F.lit(1)).otherwise(F.lit(0)))


def win_counts(flag: str = "is_winner", weight: str | None = None) -> list[Column]:
    """``fights`` and ``wins``; an unknown result counts as a fight and not as a win."""
    fights = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    return [fights.alias("fights"), _wins(flag, weight).alias("wins")]


def with_win_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("win_rate", safe_ratio(F.col("wins"), F.col("fights")))


def win_rate(
    df: DataFrame, dims: Sequence[str], flag: str = "is_winner", weight: str | None = None
) -> DataFrame:
    """fights, wins and win_rate per dimension values; NULL is a value of its own."""
    return with_win_rate(df.groupBy(*dims).agg(*win_counts(flag, weight)))


def win_rate_grains(
    df: DataFrame,
    grains: dict[str, Sequence[str]],
    flag: str = "is_winner",
    weight: str | None = None,
) -> DataFrame:
    """Several grains from one pass over the rows, told apart by the column ``grain``."""
    every = list(dict.fromkeys(c for dims in grains.values() for c in dims))
    level = F.grouping_id()
    grouped = df.groupingSets([[F.col(c) for c in dims] for dims in grains.values()], *every)
    counted = grouped.agg(level.alias("_level"), *win_counts(flag, weight))
    name = F.lit(None).cast("string")
    for label, dims in grains.items():
        bits = sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in dims)
        name = F.when(F.col("_level") == bits, F.lit(label)).otherwise(name)
    return with_win_rate(counted.withColumn("grain", name).drop("_level"))


def matrix(
    df: DataFrame,
    row: str,
    column: str,
    value: str,
    values: Sequence[str] | None = None,
    fill: float | None = None,
) -> DataFrame:
    """Pivot (row, column, value) into a matrix with one column per value, NULL included (as
    ``null``).

    Without ``values`` they are taken from the data, which are a few labels. With them, a value
    that is not listed has no column.
    """
    shown = df.withColumn(column, F.coalesce(F.col(column), F.lit("null")))
    if values is None:
        values = sorted(r[0] for r in shown.select(column).distinct().collect())
    wide = shown.groupBy(row).pivot(column, list(values)).agg(F.first(value))
    return wide if fill is None else wide.na.fill(fill)
