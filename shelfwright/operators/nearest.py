"""Nearest vocabulary term within edit distance 3, without comparing every pair.

A length of at most ``SHARED`` options brings all of them. For the others a first round joins both sides on the strings that
either becomes by losing at most one character, which are as many as a word has letters; two strings at distance 1 share
one. Inputs that find an option leave, so a dense vocabulary answers here, where few pairs meet.

For what is left an option is cut into four pieces. At most three edits cannot touch all four, so an input in reach
holds one piece unchanged, shifted by no more than the edits before it, and meets the option by it. A piece of more than
``SHARED`` options (a common prefix, say) brings no pairs. Its options are cut into halves instead: at most one edit falls
into one of the two halves. So the input's half meets the *distinct* halves at distance 1, again by strings that lack one
character, and goes on with the options of the halves it found: their pairs if they are few, and otherwise the same again
with the other half, until what is left is short enough (``SHORT``) for strings that lack three characters. The number of keys
of a string is therefore linear in its length. All ways are filters before the exact distance, so no match is lost and none
is invented.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright import fixed_values as fixed
from shelfwright.session import durable

REACH = fixed.NEAREST_MAX_DISTANCE
PIECES = REACH + 1
SHARED = 64  # options of one piece that are still compared one by one
SHORT = 16  # characters up to which strings may lack three of them
FIRST = 1  # distance of the first round


def _shorter(df: DataFrame, text: str, losses: int) -> DataFrame:
    """``df`` with ``_variant``: a row for each way in which ``text`` loses at most ``losses`` characters.

    Places are exploded one after the other, which stays inside generated code.
    """
    n = F.length(text)
    result = df.withColumn("_variant", F.col(text))
    for count in range(1, losses + 1):
        rows, kept, last = df.where(n >= count), [], F.lit(0)
        for i in range(1, count + 1):
            rows = rows.withColumn(f"_p{i}", F.explode(F.sequence(last + 1, n - (count - i))))
            kept.append(F.substring(F.col(text), last + 1, F.col(f"_p{i}") - last - 1))
            last = F.col(f"_p{i}")
        kept.append(F.substring(F.col(text), last + 1, n))
        rows = rows.withColumn("_variant", F.concat(*kept))
        result = result.unionByName(rows.drop(*[f"_p{i}" for i in range(1, count + 1)]))
    return result


def in_reach(asked: DataFrame, terms: DataFrame, distance: int) -> DataFrame:
    """Inputs for which an option of a possible length exists."""
    lengths = terms.select(F.length("_term").alias("m")).distinct()
    n = F.length("_asked")
    near = asked.withColumn("m", F.explode(F.sequence(F.greatest(n - distance, F.lit(0)), n + distance)))
    return near.join(lengths, "m", "left_semi").drop("m").distinct()


def candidates(asked: DataFrame, terms: DataFrame, distance: int) -> DataFrame:
    """The pairs of input and option that share a string after at most ``distance`` losses, each once.

    Strings of up to ``distance`` characters all share the empty string. Through it the distance is at most the longer length,
    so the first option of each length stands for the others.
    """
    row = F.struct("_option", "_position", "_term")
    split = _shorter(terms, "_term", distance)
    blank = F.col("_variant") == ""
    first = (
        split.where(blank)
        .groupBy(F.length("_term").alias("m"))
        .agg(F.min_by(row, "_position").alias("_row"))
        .select("_row.*", F.lit("").alias("_variant"))
    )
    split = split.where(~blank).unionByName(first)
    wanted = _shorter(in_reach(asked, terms, distance), "_asked", distance)
    close = F.abs(F.length("_asked") - F.length("_term")) <= distance
    return wanted.join(split, "_variant").where(close).drop("_variant").distinct()


def _start() -> Column:
    return F.expr(f"cast((i * m) div {PIECES} as int)")


def _piece_key(text: str, shift: Column) -> Column:
    """Hash of piece ``i`` of an option of ``m`` characters, read from ``text`` at ``shift``."""
    size = F.expr(f"cast(((i + 1) * m) div {PIECES} - (i * m) div {PIECES} as int)")
    return F.xxhash64("m", "i", F.substr(F.col(text), _start() + shift + 1, size))


def _each_piece() -> Column:
    return F.explode(F.array(*[F.lit(i) for i in range(PIECES)]))


def _option_keys(terms: DataFrame) -> DataFrame:
    numbered = terms.withColumn("m", F.length("_term")).withColumn("i", _each_piece())
    return numbered.withColumn("_key", _piece_key("_term", F.lit(0))).drop("m", "i")


def _asked_keys(asked: DataFrame, terms: DataFrame) -> DataFrame:
    """Keys an input may share with options of each length in reach.

    With ``i`` edits before piece ``i`` and the rest after it, the shift is at most ``i`` one way
    and, measured from the end, at most ``REACH - i`` the other way; one such piece always exists.
    """
    lengths = terms.select(F.length("_term").alias("m")).distinct()
    n, m, i = F.length("_asked"), F.col("m"), F.col("i")
    around = F.sequence(F.greatest(n - REACH, F.lit(0)), n + REACH)
    near = asked.withColumn("m", F.explode(around)).join(lengths, "m", "left_semi")
    low = F.greatest(-i, n - m - (REACH - i), -_start())
    high = F.least(i, n - m + (REACH - i))
    shifted = near.withColumn("i", _each_piece()).where(low <= high).withColumn("d", F.explode(F.sequence(low, high)))
    return shifted.withColumn("_key", _piece_key("_asked", F.col("d"))).drop("m", "i", "d")


_PAIR = ["_input", "_asked", "_option", "_position", "_term"]


def _side(text: Column, size: Column) -> tuple[Column, Column]:
    """The first or the last ``size`` characters of ``text``, by ``side``, and the others."""
    n = F.length(text)
    first, last = F.col("side") == 0, n - size
    half = F.when(first, F.substr(text, F.lit(1), size)).otherwise(F.substr(text, last + 1, size))
    other = F.when(first, F.substr(text, size + 1, n)).otherwise(F.substr(text, F.lit(1), last))
    return half, other


def _both_sides() -> Column:
    return F.explode(F.array(F.lit(0), F.lit(1)))


def _near_halves(asked: DataFrame, halves: DataFrame) -> DataFrame:
    """``asked`` (``key``, ``side``, ``part``) with each of the distinct ``half`` of its key and side at distance 1 or less."""
    on = ["key", "side", "_variant"]
    wanted, held = _shorter(asked, "part", 1), _shorter(halves, "half", 1)
    met = wanted.join(held, on).drop("_variant").distinct()
    return met.where(F.levenshtein(F.col("part"), F.col("half"), 1) >= 0)


def crowded_candidates(asked: DataFrame, terms: DataFrame, shared: int = SHARED, short: int = SHORT) -> DataFrame:
    """The pairs of input and option that may be in reach, by halves of what is left of each.

    Inputs and options with equal ``key`` agree, but for the edits found so far, in all but their ``rest``.
    """
    m = F.length("_term")
    options = terms.select("_option", "_position", "_term", m.cast("long").alias("key"), F.col("_term").alias("rest"))
    n = F.length("_asked")
    around = F.sequence(F.greatest(n - REACH, F.lit(0)), n + REACH).cast("array<long>")
    inputs = asked.select("_input", "_asked", F.explode(around).alias("key"), F.col("_asked").alias("rest"))
    inputs = inputs.join(options.select("key").distinct(), "key", "left_semi")
    found = []
    while True:
        options, inputs = durable(options), durable(inputs)
        ends = options.where(F.length("rest") <= short)
        found.append(_short_candidates(inputs, ends))
        options = options.where(F.length("rest") > short)
        if options.isEmpty():
            break
        size = F.expr("cast(length(rest) div 2 as int)")
        halved = options.withColumn("side", _both_sides())
        halved = halved.withColumn("size", F.when(F.col("side") == 0, size).otherwise(F.length("rest") - size))
        half, other = _side(F.col("rest"), F.col("size"))
        halved = halved.withColumn("half", half).withColumn("other", other)
        group = ["key", "side", "half"]
        halves = halved.groupBy(*group).agg(F.count("*").alias("_n"))
        sizes = halved.groupBy("key", "side", "size").agg(F.first(F.length("other")).alias("_left"))
        takes = F.explode(F.sequence(F.col("size") - 1, F.col("size") + 1))
        taken = inputs.join(sizes, "key").withColumn("take", takes)
        taken = taken.where((F.col("take") >= 0) & (F.col("take") <= F.length("rest")))
        part, other = _side(F.col("rest"), F.col("take"))
        taken = taken.withColumn("part", part).withColumn("other", other)
        taken = taken.where(F.abs(F.length("other") - F.col("_left")) <= REACH)
        met = _near_halves(taken.select("_input", "_asked", "key", "side", "part", "other"), halves)
        met = durable(met.drop("part"))
        few = met.where(F.col("_n") <= shared).select("_input", "_asked", *group).distinct()
        found.append(few.join(halved.select("_option", "_position", "_term", *group), group).select(*_PAIR))
        deeper = F.xxhash64(*group)
        crowds = met.where(F.col("_n") > shared)
        options = halved.join(crowds.select(*group).distinct(), group, "left_semi")
        options = options.select("_option", "_position", "_term", deeper.alias("key"), F.col("other").alias("rest"))
        inputs = crowds.select("_input", "_asked", deeper.alias("key"), F.col("other").alias("rest")).distinct()
    return reduce(DataFrame.unionByName, found).distinct()


def _short_candidates(inputs: DataFrame, options: DataFrame) -> DataFrame:
    """The pairs of one key whose rests share a string that lacks at most three characters of either."""
    lengths = options.groupBy("key").agg(F.max(F.length("rest")).alias("_most"))
    near = inputs.join(lengths, "key").where(F.length("rest") <= F.col("_most") + REACH).drop("_most")
    met = _shorter(near, "rest", REACH).drop("rest").join(_shorter(options, "rest", REACH).drop("rest"), ["key", "_variant"])
    return met.select(*_PAIR).distinct()


def far_candidates(asked: DataFrame, terms: DataFrame, shared: int = SHARED, short: int = SHORT) -> DataFrame:
    """The pairs of input and option that share a piece, or for common pieces pass the search by halves."""
    option_keys, asked_keys = _option_keys(terms), _asked_keys(asked, terms)
    common = option_keys.groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") > shared).select("_key")
    pairs = asked_keys.join(option_keys.join(common, "_key", "left_anti"), "_key").drop("_key").select(*_PAIR)
    crowd = durable(option_keys.join(common, "_key", "left_semi").drop("_key").distinct())
    if crowd.isEmpty():
        return pairs
    askers = asked_keys.join(common, "_key", "left_semi").drop("_key").distinct()
    long = F.length("_term") > short
    pairs = pairs.unionByName(candidates(askers, crowd.where(~long), REACH).select(*_PAIR))
    if crowd.where(long).isEmpty():
        return pairs
    return pairs.unionByName(crowded_candidates(askers, crowd.where(long), shared, short))


def alike_in_length(asked: DataFrame, terms: DataFrame) -> DataFrame:
    """The pairs of input and option whose lengths are in reach."""
    n = F.length("_asked")
    around = F.explode(F.sequence(F.greatest(n - REACH, F.lit(0)), n + REACH))
    return asked.withColumn("m", around).join(terms.withColumn("m", F.length("_term")), "m").drop("m")


def _best(pairs: DataFrame, distance: int) -> DataFrame:
    return (
        pairs.withColumn("_distance", F.levenshtein(F.col("_asked"), F.col("_term"), distance))
        .where(F.col("_distance") >= 0)
        .groupBy("_input")
        .agg(F.min(F.struct("_distance", "_position", "_option")).alias("_best"))
    )


def nearest_option(
    inputs: DataFrame,
    value: str,
    options: DataFrame,
    option: str,
    position: str,
    shared: int = SHARED,
    short: int = SHORT,
) -> DataFrame:
    """``(value, suggestion, distance)`` for each distinct input that has an option in reach.

    Case is ignored; among equally near options the one with the lowest ``position`` wins. Where options of one length are
    many, the inputs in reach of these and the first round are cut with a checkpoint.
    """
    terms = options.select(
        F.col(option).alias("_option"),
        F.col(position).alias("_position"),
        F.lower(option).alias("_term"),
    ).where(F.col("_option").isNotNull())
    asked = (
        inputs.select(F.col(value).alias("_input"))
        .where(F.col("_input").isNotNull())
        .distinct()
        .withColumn("_asked", F.lower("_input"))
    )
    lengths = terms.groupBy(F.length("_term").alias("m")).agg(F.count("*").alias("_n"))
    many = durable(lengths.where(F.col("_n") > shared).select("m"))  # as many rows as there are lengths
    sized = terms.withColumn("m", F.length("_term"))
    best = _best(alike_in_length(asked, sized.join(many, "m", "left_anti").drop("m")), REACH)
    if not many.isEmpty():
        crowd = sized.join(many, "m", "left_semi").drop("m")
        asked = durable(in_reach(asked, crowd, REACH))
        near = durable(_best(candidates(asked, crowd, FIRST), FIRST))
        waiting = asked.join(near.select("_input"), "_input", "left_anti")
        far = _best(far_candidates(waiting, crowd, shared, short), REACH)
        best = best.unionByName(near).unionByName(far).groupBy("_input").agg(F.min("_best").alias("_best"))
    return best.select(
        F.col("_input").alias(value), F.col("_best._option").alias("suggestion"), F.col("_best._distance").alias("distance")
    )
