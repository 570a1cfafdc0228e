"""Negative sampling: items a user has not seen, drawn by a seeded hash.

Try number t of a positive draws item ``hash(seed, epoch, positive, t) mod n``,
so the sample depends on nothing but the data, the seed and the epoch. Draws of
seen items are rejected and the first ``n`` that are left count, in the order of
the tries, with replacement.

Every try is a row and meets the seen pairs on (user, item), so a user with very
many positives is spread over the items, and no list of tries is ever built. The
few pairs whose user has seen nearly all items draw from the unseen items
themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastro.functions.columns import hash_int
from rastro.functions.running import row_rank, running_total
from rastro.session import pinned, spread

DRAWS_PER_TASK = 10_000_000


def _numbered(positives: DataFrame, key: list[str], tries: int) -> DataFrame:
    """Positives with a number of their own, pinned so that it stays the same.

    They are few bytes and much work, so they are spread by their draws first.
    """
    columns = list(dict.fromkeys(["u_idx", "i_idx", *key]))
    even = spread(positives.select(*columns), DRAWS_PER_TASK // tries)
    return pinned(even.withColumn("_pos", F.monotonically_increasing_id()))


def _column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _round(
    wanted: DataFrame,
    seen: DataFrame,
    n_items: Column | int,
    key: list[str],
    seed: int,
    epoch: int,
    tries: tuple[int, int],
    true_item: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(chosen, short): the first ``_missing`` unseen items of each positive among these
    tries, as ``neg_idx``, and the positives that miss some still."""
    first, last = tries
    drawn = wanted.withColumn("_try", F.explode(F.sequence(F.lit(first), F.lit(last - 1))))
    drawn = drawn.withColumn("neg_idx", _item(n_items, key, seed, epoch, F.col("_try")))
    pairs = seen.select("u_idx", F.col("i_idx").alias("neg_idx"))
    unseen = drawn.join(pairs, ["u_idx", "neg_idx"], "left_anti")
    if true_item:
        unseen = unseen.filter(F.col("neg_idx") != F.col(true_item))
    # At most last - first rows for a positive.
    order = Window.partitionBy("_pos").orderBy("_try")
    placed = unseen.withColumn("_place", F.row_number().over(order))
    chosen = pinned(
        placed.filter(F.col("_place") <= F.col("_missing")).select("_pos", "u_idx", "i_idx", "neg_idx")
    )
    found = chosen.groupBy("_pos").agg(F.count(F.lit(1)).alias("_found"))
    left = F.col("_missing") - F.coalesce("_found", F.lit(0))
    short = wanted.join(found, "_pos", "left").withColumn("_missing", left).drop("_found")
    return chosen, pinned(short.filter("_missing > 0"))


def _first_round(
    wanted: DataFrame, seen: DataFrame, n_items: Column | int, key: list[str], seed: int, epoch: int, n: int
) -> tuple[DataFrame, DataFrame]:
    """The same for the first n tries of positives that miss n: each unseen item counts, so the
    draws are shuffled once, to meet the seen pairs, and only those that were seen are counted."""
    drawn = wanted.withColumn("_try", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    drawn = drawn.select("_pos", "u_idx", "_try", _item(n_items, key, seed, epoch, F.col("_try")).alias("neg_idx"))
    pairs = seen.select("u_idx", F.col("i_idx").alias("neg_idx"), F.lit(1).alias("_known"))
    met = drawn.join(pairs, ["u_idx", "neg_idx"], "left")
    # Of draws that count nobody asks for their positive again.
    again = [F.when(F.col("_known") == 1, F.col(c)).alias(c) for c in ("_pos", "_try")]
    met = pinned(met.select("u_idx", "neg_idx", "_known", *again))
    # A seen pair may come twice.
    missed = met.filter("_known = 1").groupBy("_pos").agg(F.count_distinct("_try").cast("int").alias("_missing"))
    short = wanted.drop("_missing").join(missed, "_pos").select(*wanted.columns)
    return met.filter("_known is null").select("u_idx", "neg_idx"), pinned(short)


def _item(n_items: Column | int, key: list[str], seed: int, epoch: int, attempt: Column) -> Column:
    drawn = hash_int(F.lit(seed), F.lit(epoch), *[F.col(c) for c in key], attempt)
    # Never null, and seen to be so: else a join computes it twice, to filter nulls.
    return F.coalesce(F.pmod(drawn, _column(n_items).cast("bigint")), F.lit(-1))


def training_negatives(
    positives: DataFrame,
    seen: DataFrame,
    n_items: Column | int,
    key: list[str],
    n: int = 4,
    seed: int = 42,
    epoch: int = 0,
    tries_per_negative: int = 10,
) -> DataFrame:
    """Up to n unseen items per positive, from at most ``tries_per_negative`` · n tries each.

    The first n tries are enough for nearly every positive, so no more are drawn for all. Those
    that miss some go on to 2·n, and to the full number of tries where users have seen much of
    the catalogue; ``training_shortfall`` counts what they miss then.
    """
    short = _numbered(positives, key, n).withColumn("_missing", F.lit(n))
    ends = [0, *(min(k, tries_per_negative) * n for k in (1, 2, tries_per_negative))]
    if not ends[-1]:
        return short.limit(0).select("u_idx", "i_idx")
    chosen, short = _first_round(short, seen, n_items, key, seed, epoch, n)
    kept = [chosen]
    for first, last in zip(ends[1:], ends[2:]):
        if last > first and not short.isEmpty():
            chosen, short = _round(short, seen, n_items, key, seed, epoch, (first, last))
            kept.append(chosen.select("u_idx", "neg_idx"))
    return reduce(DataFrame.unionByName, kept).select("u_idx", F.col("neg_idx").alias("i_idx"))


def training_shortfall(pairs: DataFrame, n: int = 4) -> DataFrame:
    """(positivos, negativos, faltan): how many negatives the tries did not find."""
    counts = pairs.agg(
        F.count_if(F.col("label") == 1).alias("positivos"),
        F.count_if(F.col("label") == 0).alias("negativos"),
    )
    return counts.withColumn("faltan", F.lit(n) * F.col("positivos") - F.col("negativos"))


def training_pairs(
    positives: DataFrame,
    seen: DataFrame,
    n_items: Column | int,
    key: list[str],
    n: int = 4,
    seed: int = 42,
    epoch: int = 0,
    tries_per_negative: int = 10,
) -> DataFrame:
    """Positives with label 1 and their sampled negatives with label 0.

    ``positives`` and ``seen`` are pinned tables with u_idx and i_idx. ``key`` names the
    columns that tell one positive from another. Positives are events of a cleaned log, so a
    pair that repeats draws anew each time.
    """
    ones = positives.select("u_idx", "i_idx", F.lit(1.0).alias("label"))
    negatives = training_negatives(
        positives, seen, n_items, key, n, seed, epoch, tries_per_negative
    )
    zeros = negatives.withColumn("label", F.lit(0.0))
    return ones.unionByName(zeros).withColumn("epoch", F.lit(epoch))


def evaluation_negatives(
    test_pairs: DataFrame,
    seen: DataFrame,
    n_items: Column | int,
    n: int = 99,
    seed: int = 42,
) -> DataFrame:
    """Exactly n unseen items, none the true one, per (user, true item).

    Two rounds of tries, 2·n and 4·n, are enough for users who have seen no more than about
    four fifths of the items. What is missing then is drawn from the unseen items themselves:
    draw d takes the unseen item with number ``hash(seed, 0, pair, 6·n + d) mod unseen``, in
    the order of the items. A user who has seen every other item has nothing to draw and is
    left out.
    """
    key = ["u_idx", "i_idx"]
    seen = seen.select(*key)
    seen_counts = seen.groupBy("u_idx").agg(F.count(F.lit(1)).alias("_n_seen"))
    with_true = test_pairs.select(*key).join(seen.withColumn("_known", F.lit(1)), key, "left")
    taken = F.coalesce("_n_seen", F.lit(0)) + F.when(F.col("_known").isNull(), 1).otherwise(0)
    drawable = (
        with_true.join(seen_counts, "u_idx", "left")
        .withColumn("_unseen", _column(n_items) - taken)
        .filter("_unseen > 0")
    )
    wanted = _numbered(pinned(drawable), [*key, "_unseen"], 2 * n).withColumn("_missing", F.lit(n))
    first, short = _round(wanted, seen, n_items, key, seed, 0, (0, 2 * n), "i_idx")
    second, hard = _round(short, seen, n_items, key, seed, 0, (2 * n, 6 * n), "i_idx")
    tables = [first, second, _from_unseen(hard, seen, key, seed, 6 * n)]
    return reduce(DataFrame.unionByName, [t.select(*key, "neg_idx") for t in tables])


def _from_unseen(hard: DataFrame, seen: DataFrame, key: list[str], seed: int, first: int) -> DataFrame:
    """Draws of the pairs that are short: numbers of unseen items, turned into items.

    The k-th unseen item is k plus the number of taken items in front of it, and item number r
    of those taken, i, is in front of the unseen ones from number i - r on. So sorting draws
    and taken items of a pair together, a running count gives the items; it is split for
    pairs with very many.
    """
    own = hard.select("_pos", F.col("i_idx").alias("item"))
    taken = hard.select("_pos", "u_idx").join(
        seen.select("u_idx", F.col("i_idx").alias("item")), "u_idx"
    )
    taken = pinned(taken.select("_pos", "item").unionByName(own).distinct())
    ranked = row_rank(taken, ["_pos"], [F.col("item").asc()], "_rank", written=True)
    marks = ranked.select(
        "_pos", (F.col("item") - F.col("_rank") + 1).alias("_at"), F.lit(0).alias("_kind"),
        F.col("item").cast("bigint").alias("_tie"), F.lit(1).cast("bigint").alias("_taken"),
    )
    draw = F.explode(F.sequence(F.lit(0), F.col("_missing") - 1))
    drawn = hard.select("*", draw.alias("_draw")).withColumn(
        "_at", _item(F.col("_unseen"), key, seed, 0, F.col("_draw") + first)
    )
    draws = drawn.select(
        "_pos", "_at", F.lit(1).alias("_kind"), F.col("_draw").cast("bigint").alias("_tie"),
        F.lit(0).cast("bigint").alias("_taken"),
    )
    order = [F.col(c).asc() for c in ("_at", "_kind", "_tie")]
    together = pinned(marks.unionByName(draws))
    counted = running_total(together, ["_pos"], order, F.col("_taken"), "_before", written=True)
    items = counted.filter("_kind = 1").select("_pos", (F.col("_at") + F.col("_before")).alias("neg_idx"))
    return items.join(hard.select("_pos", *key), "_pos")
