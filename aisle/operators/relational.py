"""Generic DataFrame operators used by the marts, written to survive skew.

* ``row_number_by``   row_number() over (partition by g order by k) without
                      sending a whole group to one task (E1).
* ``explode_count``   unnest(generate_series(1, n)) chunk by chunk (H1).
* ``pair_counts``     co-occurrence counts of item pairs per basket, a large
                      basket being many block pairs (C4/C5).
* ``distinct_counts`` exact count(distinct) of several id columns (D5) from
                      mergeable bitmaps, without a row per distinct column.
* ``ordered_concat``  string aggregation in two levels (D11, D12).
* ``with_group_total`` sum(x) over (partition by g) for a small, bounded
                      number of groups as groupBy + broadcast join (E2).
* ``top_k_per_group`` row_number() <= k, which Spark plans with a map-side
                      WindowGroupLimit, so a hot group ships at most k rows
                      per map task.

All are native expressions; none runs a job while it is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisle.operators.prefix import running_totals


def _cols(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


# --------------------------------------------------------------------------
# row_number over a possibly skewed partition key
# --------------------------------------------------------------------------

ID_BLOCK_BITS = 12      # consecutive integer keys in one bucket


def order_bucket(df: DataFrame, column: str) -> Column:
    """A bucket that rises with the column: the day of a date or timestamp, a
    block of 4096 values of an integer; the least bucket for null."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.unix_date(F.to_date(c)).cast("long"), F.lit(-(2 ** 62)))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.shiftright(c.cast("long"), ID_BLOCK_BITS), F.lit(-(2 ** 62)))
    raise ValueError(f"give a bucket for the order column {column} of type {kind.simpleString()}")


def row_number_by(df: DataFrame, partition_by: Sequence[str] | str, order_by: Sequence[str] | str,
                  out: str = "row_number", bucket: Column | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by P order by O)``, nulls first.

    The order key must be unique within a group (add a tiebreak). ``bucket`` is a
    column that never falls as the order key rises (default: see
    ``order_bucket`` of the first order column). Rows are counted per (group,
    bucket) with a partial aggregate, the counts are summed up per group, and
    only rows of one (group, bucket) meet in a task.
    """
    pcols, ocols = _cols(partition_by), _cols(order_by)
    rows = df.withColumn("_bucket", order_bucket(df, ocols[0]) if bucket is None else bucket)
    order = [F.col(c).asc_nulls_first() for c in ocols]
    summed = running_totals(rows, pcols, "_bucket", order, {out: F.lit(1)})
    return summed.withColumn(out, F.col(out) + 1).select(*[F.col(f"`{c}`") for c in df.columns], out)


# --------------------------------------------------------------------------
# unnest(generate_series(1, n))
# --------------------------------------------------------------------------

def explode_count(df: DataFrame, n_col: str, out: str, chunk: int = 4096, spread: Sequence[str] = ()) -> DataFrame:
    """One row per i in 1..n for rows with n >= 1 (rows with n < 1 or NULL
    vanish, as an empty series does). Every row is cut into chunks of at most
    ``chunk`` values, so no array is larger than that. With ``spread``, columns
    that name a row, the chunks are dealt out by (those, chunk) first, so that
    many tasks share one huge row."""
    n = F.col(n_col).cast("long")
    last = F.expr(f"cast((cast(`{n_col}` as bigint) - 1) div {chunk} as int)")
    chunks = df.filter(n >= 1).withColumn("_chunk", F.explode(F.sequence(F.lit(0), last)))
    if spread:
        chunks = chunks.repartition(*spread, "_chunk")
    begin = F.col("_chunk").cast("long") * chunk
    values = F.sequence((begin + 1).cast("int"), F.least(begin + chunk, n).cast("int"))
    return chunks.withColumn(out, F.explode(values)).drop("_chunk")


# --------------------------------------------------------------------------
# item-pair co-occurrence per basket
# --------------------------------------------------------------------------

def basket_lines(items: DataFrame, group: Sequence[str] | str, basket: str, item: str,
                 carry: Sequence[str] = ()) -> DataFrame:
    """One row per (group, basket, item) with its multiplicity ``_cnt``
    (partially aggregated, so a hot basket is combined map-side). ``carry``
    columns must be functionally dependent on the item. Rows without a basket or
    an item belong to no pair and are dropped."""
    known = items.filter(F.col(basket).isNotNull() & F.col(item).isNotNull())
    return known.groupBy(*_cols(group), basket, item, *carry).agg(F.count(F.lit(1)).alias("_cnt"))


PAIR_BLOCK = 1024       # items of a basket that one task pairs with as many


def basket_sizes(lines: DataFrame, group: Sequence[str] | str, basket: str) -> DataFrame:
    """Lines per (group, basket) as ``_n``, of the result of ``basket_lines``."""
    return lines.groupBy(*_cols(group), basket).agg(F.count(F.lit(1)).alias("_n"))


def large_baskets(sizes: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """The baskets of ``basket_sizes`` that ``pair_counts`` cuts into blocks: at most
    one per ``block`` lines."""
    return sizes.filter(F.col("_n") > block)


def pair_counts(items: DataFrame, group: Sequence[str] | str, basket: str, item: str,
                ordered: bool = False, deduped: bool = False, block: int = PAIR_BLOCK,
                large: DataFrame | None = None) -> DataFrame:
    """For every pair of distinct items in the same basket (item_a < item_b, or
    both orders when ``ordered``), per ``group`` (a function of the basket):

    * ``times``   = number of (row, row) pairs, i.e. sum over baskets of
                    count(a) * count(b) (a self-join's row count);
    * ``baskets`` = number of baskets containing both.

    Rows are first reduced to one row per (basket, item). The items of a basket
    are dealt to blocks of about ``block`` items, and the self-join is keyed by a hash
    of (basket, block of a, block of b), and compares these: an ordinary basket is one
    block, a huge one many tasks of at most about block * block pairs. The pairs go
    straight into a partial aggregate, which spills. ``large`` gives the
    ``large_baskets`` where they are stored already: few rows, so that the lines need
    no shuffle to learn their block.
    """
    g = _cols(group)
    lines = items if deduped else basket_lines(items, g, basket, item)
    lines = lines.select(*g, basket, item, "_cnt").filter(F.col(basket).isNotNull() & F.col(item).isNotNull())
    large = large_baskets(basket_sizes(lines, g, basket), block) if large is None else large
    keys = [basket, *g]
    sizes = large.select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(keys)],
                         F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    its_size = reduce(and_, [lines[c].eqNullSafe(sizes[f"_of_{i}"]) for i, c in enumerate(keys)])
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    cut = (lines.join(sizes, its_size, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
           .withColumn("_own", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int")).withColumn("_other", other)
           .select(*g, F.col(basket).alias("_basket"), F.least("_own", "_other").alias("_lo"),
                   F.greatest("_own", "_other").alias("_hi"), "_own", F.col(item).alias("_item"), "_cnt"))
    cut = cut.withColumn("_key", F.xxhash64("_basket", "_lo", "_hi", *g))
    # both sides are the same relation with the same columns: one exchange serves both. One
    # integer is the only join key, which Spark sorts by radix; the columns behind it are
    # compared as a range or a coalesce, since an equality would become a further key
    a, b = cut.alias("a"), cut.alias("b")
    same = [F.col("a._key") == F.col("b._key")]
    same += [F.col(f"a.{c}").between(F.col(f"b.{c}"), F.col(f"b.{c}")) for c in ("_basket", "_lo", "_hi")]
    same += [F.coalesce(F.col(f"a.{c}") == F.col(f"b.{c}"), F.col(f"a.{c}").isNull() & F.col(f"b.{c}").isNull()) for c in g]
    x, y = F.col("a._item"), F.col("b._item")
    residual = ((x != y) if ordered else (x < y)) & ((F.col("a._lo") == F.col("a._hi")) | (F.col("a._own") != F.col("b._own")))
    return (a.join(b, reduce(and_, same) & residual)
            .groupBy(*[F.col(f"a.{c}").alias(c) for c in g], x.alias("item_a"), y.alias("item_b"))
            .agg(F.sum(F.col("a._cnt") * F.col("b._cnt")).alias("times"), F.count(F.lit(1)).alias("baskets")))


# --------------------------------------------------------------------------
# count(distinct) of several columns
# --------------------------------------------------------------------------

def distinct_counts(df: DataFrame, keys: Sequence[str] | str, columns: dict[str, str]) -> DataFrame:
    """Per key ``count(distinct column)`` as ``name`` for every (name, integer column)
    of ``columns``; null is no value. Each column is reduced to bitmaps of 32,768
    consecutive ids per (key, block of ids), which merge map-side and need not meet
    as values; a block's bits are counted, and the blocks' counts summed. Ids may be
    any BIGINTs. No row is copied per column (as for several distincts in one
    aggregate): every column has a scan of the keys and itself. A key whose columns
    are all null counts 0."""
    k = _cols(keys)
    out = df.groupBy(*k).agg(F.count(F.lit(1)).alias("_rows"))
    for name, column in columns.items():
        bits = (df.select(*k, F.col(column).cast("long").alias("_v")).filter(F.col("_v").isNotNull())
                .groupBy(*k, F.bitmap_bucket_number("_v").alias("_block"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_v")).alias("_bits")))
        n = bits.groupBy(*[F.col(c).alias(f"_{c}") for c in k]).agg(F.sum(F.bitmap_count("_bits")).alias("_n"))
        same = reduce(and_, [out[c].eqNullSafe(n[f"_{c}"]) for c in k])
        out = out.join(n, same, "left").withColumn(name, F.coalesce("_n", F.lit(0)).cast("long")).drop("_n", *[f"_{c}" for c in k])
    return out.drop("_rows")


# --------------------------------------------------------------------------
# ordered string aggregation
# --------------------------------------------------------------------------

def ordered_concat(df: DataFrame, keys: Sequence[str] | str, element: str, order_by: Sequence[str],
                   bucket: Column, separator: str, out: str) -> DataFrame:
    """The elements of each key, joined by ``separator`` in the total order
    ``order_by``; null elements are skipped (D11, D12). Two levels: rows meet per
    (key, ``bucket``), a column that never falls as the order rises, and a key's
    task sees one string per bucket."""
    k = _cols(keys)

    def joined(column: str, order: str) -> Column:
        return F.expr(f"listagg({column}, '{separator}') WITHIN GROUP (ORDER BY {order})")

    parts = df.withColumn("_bucket", bucket).groupBy(*k, "_bucket").agg(joined(element, ", ".join(order_by)).alias("_part"))
    return parts.groupBy(*k).agg(joined("_part", "_bucket").alias(out))


# --------------------------------------------------------------------------
# partition totals for a bounded number of groups
# --------------------------------------------------------------------------

def with_group_total(df: DataFrame, group: Sequence[str] | str, value: str, out: str) -> DataFrame:
    """``sum(value) over (partition by group)`` when the number of groups has a
    proven small bound (e.g. the six behavioural clusters): a window would put
    each whole group in one task; a grouped total broadcast back does not."""
    g = _cols(group)
    totals = df.groupBy(*g).agg(F.sum(value).alias(out))
    return df.join(F.broadcast(totals), g, "left")


def top_k_per_group(df: DataFrame, group: Sequence[str] | str, order: Sequence[Column],
                    k: int, rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*_cols(group)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
