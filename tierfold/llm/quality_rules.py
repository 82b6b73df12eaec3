"""Weak supervision over text rules, in place of a filter that every rule must pass.

Each rule votes good (1), bad (-1) or abstains (0). A document's votes are one of at most
3**rules patterns; the patterns and their counts are all that expectation-maximisation needs.
From the documents that pass the base rule it estimates how often good and bad text gets each vote
of each rule and how common good text is; the posterior probability of good text decides. A rule
that votes alike on both kinds has no say, and a document may go by what its rules abstain from.

Only DataFrame functions are used. Texts are read once; the counts and votes are written to the
shared folder, since both the estimate and the result read them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import WORD, boxed, row_of, text_of, unboxed, words, written

SYMBOLS = r"[#*$%&|<>]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ROUNDS, TOLERANCE = 500, 1e-7
#: Where the estimate starts: the share of good text, how likely good and bad text gets the votes -1, 0, 1,
#: and the same for the anchor, the first rule. What the anchor says is held, not estimated: it tells which
#: kind is meant, also where no other rule tells the kinds apart.
SHARE, IF_GOOD, IF_BAD = 0.9, (0.05, 0.35, 0.6), (0.4, 0.3, 0.3)
ANCHOR_IF_GOOD, ANCHOR_IF_BAD = (0.002, 0.1, 0.898), (0.7, 0.2, 0.1)
#: The start counts as much as this share of the rows. It holds a kind of text that hardly occurs in its
#: place and is lost in what is seen of one that does. No estimate has a limit or sits on one.
PRIOR = 0.005
#: Frequent function words of four languages, in lower case.
FUNCTION_WORDS = (
    "the and of to in a is that with for der die das und den ist zu le la les de et des en que el los las y un una du est dans"
).split()
SENTENCE_ENDS = [".", "!", "?", "…", ":", ")", '"', "'", "”", "’", "。"]
SHAPES = ["n_lines", "n_ended_lines", "n_distinct_words", "n_function_words", "n_letter_words", "n_upper_words"]


def text_counts(df: DataFrame) -> DataFrame:
    """Columns of COUNTS and SHAPES from the string column ``text``, which is dropped."""
    count = lambda of, test: F.size(F.filter(of, test)).cast("long")
    last = lambda line: F.substring(F.rtrim(line, F.lit(" \t\n\x0b\f\r")), -1, 1)
    stem = lambda word: F.lower(F.rtrim(word, F.lit(".,;:!?")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    df = df.withColumns({"words": words(F.col("text")), "lines": lines})
    df = df.select(
        *(c for c in df.columns if c not in ("text", "lines")),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        count("lines", lambda line: last(line).isin(SENTENCE_ENDS)).alias("n_ended_lines"),
        F.size(F.array_distinct(F.transform("words", lambda w: F.xxhash64(F.lower(w))))).cast("long").alias("n_distinct_words"),
        count("words", lambda w: stem(w).isin(FUNCTION_WORDS)).alias("n_function_words"),
        count("words", lambda w: w.rlike(r"\p{L}")).alias("n_letter_words"),
        count("words", lambda w: (w == F.upper(w)) & (w != F.lower(w))).alias("n_upper_words"),
    )
    return _repeat_words(df)


def _repeat_words(df: DataFrame) -> DataFrame:
    """n_repeat_words: words inside three-word windows that the text has twice or more.

    Windows are compared by a 64-bit hash within one text. Numbers made of half of that hash and
    the position are sorted first, which brings windows together that may be equal; only those are
    then compared in full. The work is n log n even for a text that repeats itself throughout.
    """
    word = lambda i: F.get("words", i)
    window = lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))
    starts = F.sequence(F.lit(0), F.size("words") - 3)
    half = F.transform(starts, lambda i: F.shiftleft(window(i), 32) + i)
    df = df.withColumn("w", F.when(F.size("words") >= 3, F.sort_array(half)))

    def near(x: Column, i: Column) -> Column:
        same = lambda j: F.shiftright(F.get("w", j), 32) == F.shiftright(x, 32)
        return F.coalesce(same(i - 1), F.lit(False)) | F.coalesce(same(i + 1), F.lit(False))

    df = df.withColumn("near", F.filter("w", near))
    start = lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int")
    full = F.transform("near", lambda x: F.struct(window(start(x)).alias("h"), start(x).alias("i")))
    df = df.withColumn("near", F.when(F.size("near") > 0, F.sort_array(full))).drop("words", "w")

    def start_if_repeated(x: Column, i: Column) -> Column:
        same = lambda j: F.get("near", j)["h"].eqNullSafe(x["h"])
        return F.when(same(i - 1) | same(i + 1), x["i"])

    found = F.filter(F.transform("near", start_if_repeated), lambda i: i.isNotNull())
    covered = F.flatten(F.transform(found, lambda i: F.array(i, i + 1, i + 2)))
    n = F.when(F.col("near").isNull(), 0).otherwise(F.size(F.array_distinct(covered)))
    return df.withColumn("n_repeat_words", n.cast("long")).drop("near")


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else not at all."""

    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        return F.when(self.bad, -1).when(self.good, 1).otherwise(0).cast("int")


def default_rules() -> list[Rule]:
    """The first rule is the anchor."""
    n, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    symbols, upper, letters = F.col("n_symbols") / n, F.col("n_upper_words") / n, F.col("n_letter_words") / n
    vocabulary, function_words = F.col("n_distinct_words") / F.sqrt(n), F.col("n_function_words") / n
    dup_lines, ended = F.col("n_dup_lines") / lines, F.col("n_ended_lines") / lines
    repeats = F.col("n_repeat_words") / n
    return [
        Rule("symbols", symbols > 1, symbols < 0.02),
        Rule("capitals", upper > 0.5, upper < 0.1),
        Rule("vocabulary", vocabulary < 3, vocabulary > 5),
        Rule("function_words", function_words < 0.02, function_words > 0.1),
        Rule("line_ends", ended < 0.3, ended > 0.8),
        Rule("lines", dup_lines > 0.3, dup_lines < 0.05),
        Rule("letters", letters < 0.5, letters > 0.9),
        Rule("repeats", repeats > 0.2, repeats < 0.05),
    ]


@dataclass(frozen=True)
class LabelModel:
    """Share of good text and, for each rule, how likely it votes -1, 0 and 1 on good and bad text."""

    share: float
    if_good: list[tuple[float, ...]]
    if_bad: list[tuple[float, ...]]

    @classmethod
    def start(cls, rules: int) -> LabelModel:
        return cls(SHARE, [ANCHOR_IF_GOOD] + [IF_GOOD] * (rules - 1), [ANCHOR_IF_BAD] + [IF_BAD] * (rules - 1))

    def numbers(self) -> list[float]:
        return [self.share, *(p for rates in (self.if_good, self.if_bad) for rule in rates for p in rule)]

    def evidence(self, rule: int, vote: int) -> float:
        """Log odds of good text that a vote, or an abstention, adds."""
        return math.log(self.if_good[rule][vote + 1] / self.if_bad[rule][vote + 1])

    def _odds(self) -> float:
        return math.log(self.share / (1 - self.share))

    def probability(self, votes: tuple[int, ...]) -> float:
        """Posterior probability of good text."""
        odds = self._odds() + sum(self.evidence(j, v) for j, v in enumerate(votes))
        return 1 / (1 + math.exp(-max(odds, -700.0)))

    def posterior(self, votes: list[Column]) -> Column:
        odds = F.lit(self._odds())
        for j, vote in enumerate(votes):
            none = self.evidence(j, 0)
            odds = odds + F.when(vote == -1, self.evidence(j, -1)).when(vote == 1, self.evidence(j, 1)).otherwise(none)
        return 1 / (1 + F.exp(-odds))


def _rates(patterns: list[tuple], weights: list[float], start: list[tuple[float, ...]], prior: float):
    """How likely each rule casts each vote where patterns count by ``weights``; the anchor's are held."""
    total = sum(weights) + prior
    out = start[:1]
    for j, first in enumerate(start[1:], 1):
        seen = [prior * p for p in first]
        for votes, weight in zip(patterns, weights, strict=True):
            seen[votes[j] + 1] += weight
        out.append(tuple(x / total for x in seen))
    return out


def fit_label_model(votes: DataFrame, columns: list[str]) -> LabelModel:
    """Expectation-maximisation over the counted vote patterns of all rows.

    Spark counts the patterns; the driver gets 3**rules numbers at most. Without rows the starting
    values stay.
    """
    rows = votes.groupBy(*columns).agg(F.count("*").alias("n")).collect()
    counted = sorted((tuple(r[c] for c in columns), r["n"]) for r in rows)
    patterns, counts = [v for v, _ in counted], [n for _, n in counted]
    model = start = LabelModel.start(len(columns))
    total = sum(counts)
    prior = PRIOR * total
    for _ in range(ROUNDS if total else 0):
        good = [n * model.probability(v) for v, n in counted]
        bad = [n - g for n, g in zip(counts, good, strict=True)]
        new = LabelModel(
            (sum(good) + prior * start.share) / (total + prior),
            _rates(patterns, good, start.if_good, prior),
            _rates(patterns, bad, start.if_bad, prior),
        )
        moved = max(abs(a - b) for a, b in zip(new.numbers(), model.numbers(), strict=True))
        model = new
        if moved < TOLERANCE:
            break
    return model


def quality_rules(
    docs: DataFrame, rules: list[Rule] | None = None, text: str | Column = "text", carry: list[str] | None = None
) -> DataFrame:
    """Adds counts, votes, ``p_good``, ``base_failed`` and ``kept`` to every row of ``docs``.

    Rules are weighed by all rows that pass the base rule. A null text has no words and fails it.
    Repeated rows count as often as they stand there and are judged alike. An empty table gives an empty result. A column of ``docs`` that is named
    like an added one is replaced. ``carry`` names the columns that the result needs, all unless given.
    """
    rules = default_rules() if rules is None else rules
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = text_counts(boxed(docs, carry, text=text_of(text))).withColumn("base_failed", base)
    votes = [f"vote_{r.name}" for r in rules]
    df = written(df.withColumns({v: r.vote() for v, r in zip(votes, rules, strict=True)}), "quality")
    model = fit_label_model(df.where("NOT base_failed"), votes)
    df = df.withColumn("p_good", model.posterior([F.col(v) for v in votes]))
    df = df.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))
    return unboxed(df, *COUNTS, "base_failed", "kept", *SHAPES, *votes, "p_good")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``, null texts and ids
    and repeated rows as in :func:`quality_rules`. An empty table stays empty."""
    judged = quality_rules(docs.select(row_of(docs.columns).alias("document")), text=F.col("document.text"))
    return judged.where("kept").select("document.*")
