"""Values carried along an order, without a whole key in one task.

``ranges`` cuts rows into ranges of one global order (key, then position): a range
partition, so a key with a third of all rows spreads over many ranges, whatever the
spacing of its positions. Inside a range a window carries values from row to row;
across ranges they come from a small table with one row per key and range. No
constant, count of versions or spacing decides how it is done, and each window holds
at most one range of one key.

``asof_join`` gives each fact the last version of its key before it, found by halving in
the sorted list of the key's versions. If the measured size of the versions that facts can
meet allows a broadcast, the lists are broadcast; else facts are written once and shuffled
once, to lists of pieces: a key of many versions has a list for each piece of its positions,
and a list that many facts look into is copied, so no task gets a whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.jsonvar import rows_where
from rillflow.operators.joins import fits_broadcast, sized_broadcast
from rillflow.session import materialize

#: rows that one plain window may hold; more are cut into ranges
WINDOW_ROWS = 1_000_000
#: versions of a key in one list, at least; pieces of a key's versions beyond that, and keys
#: so cut, at most
LIST_ROWS, PIECES = 16_384, 1_000
#: facts that look into one copy of a list
LIST_FACTS = 250_000
#: versions in a shuffle partition that a hash join may hold
HASH_ROWS = 200_000


def ranges(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` in ranges of (key, order), with the range's number as ``_range``; written
    once, since the sampled bounds of a range partition are good for one run only."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, key, *order)
                       .withColumn("_range", F.spark_partition_id()), "ranges")


def _last_before(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """``rows`` (in ranges) plus ``_last``: the last ``_value`` that is not null among
    the earlier rows of the key."""
    at = F.struct(*order)
    spans = rows.groupBy(key, "_range").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), at)).alias("_value"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    spans = spans.select(key, "_range", F.last("_value", ignorenulls=True).over(earlier)
                         .alias("_carry"))
    inside = Window.partitionBy(key, "_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    here = rows.withColumn("_here", F.last("_value", ignorenulls=True).over(inside))
    return here.join(spans, [key, "_range"], "left") \
        .withColumn("_last", F.coalesce("_here", "_carry")).drop("_here", "_carry", "_range")


def next_in_group(df: DataFrame, key: str, order: str, out: str,
                  window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``df`` plus ``out``: the next ``order`` value of the key (null for its last row).
    Keys are not null; ``order`` is distinct within a key."""
    if df.limit(window_rows + 1).count() <= window_rows:
        return df.withColumn(out, F.lead(order).over(Window.partitionBy(key).orderBy(order)))
    rows = ranges(df, key, order)
    spans = rows.groupBy(key, "_range").agg(F.min(order).alias("_first"))
    spans = spans.select(key, "_range", F.lead("_first").over(
        Window.partitionBy(key).orderBy("_range")).alias("_next"))
    here = rows.withColumn(out, F.lead(order).over(
        Window.partitionBy(key, "_range").orderBy(order)))
    return here.join(spans, [key, "_range"]).withColumn(out, F.coalesce(out, "_next")) \
        .select(*df.columns, out)


def previous_in_group(df: DataFrame, key: str, order: str, value: str, out: str,
                      window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``df`` plus ``out``: ``value`` of the row before, in the order of the key (null
    for its first row); ``value`` is not null."""
    if df.limit(window_rows + 1).count() <= window_rows:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(key).orderBy(order)))
    rows = ranges(df.withColumn("_value", F.col(value)), key, order)
    return _last_before(rows, key, order).select(*df.columns, F.col("_last").alias(out))


def asof_join(facts: DataFrame, versions: DataFrame, fact_key: str, key: str, pos: str, at: str,
              columns: list[str], in_force: Column | None = None,
              limit: int | None = None, list_rows: int = LIST_ROWS,
              list_facts: int = LIST_FACTS) -> DataFrame:
    """``facts`` with ``columns`` of the last version of their key whose ``at`` lies before
    ``pos`` (one at the same position comes after it). Facts without such a version go, and
    those whose last version is not ``in_force`` (a condition on ``versions``, whose null is false). Null keys
    never match. ``limit``: most versions to broadcast (default: by size)."""
    force = F.lit(True) if in_force is None else F.coalesce(in_force, F.lit(False))
    v = versions.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(key).alias("_key"), F.struct(F.col(at).alias("_at"), force.alias("_force"),
                                           *columns).alias("_v"))
    if fits_broadcast(v, limit):
        return _asof_broadcast(facts, v, fact_key, pos, columns)
    facts = materialize(facts.where(F.col(fact_key).isNotNull() & F.col(pos).isNotNull()),
                        "facts")
    keys = facts.select(F.col(fact_key).alias("_key")).distinct()
    if fits_broadcast(keys):  # versions of other keys meet no fact
        v = materialize(v.join(F.broadcast(keys), "_key", "left_semi"), "versions")
        if fits_broadcast(v, limit):
            return _asof_broadcast(facts, v, fact_key, pos, columns)
    return _asof_pieces(facts, v, fact_key, pos, columns, list_rows, list_facts)


def _longest(rows: DataFrame, *by: str) -> int:
    """Rows of the largest group."""
    return rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def _count_below(df: DataFrame, array: str, size: int, below, out: str) -> DataFrame:
    """``df`` plus ``out``: how many elements of the sorted column ``array`` (of ``size`` elements
    at most) are ``below``, a condition that is true for its first elements only. A search by
    halving, one projection a step: all in generated code, which does not copy the array
    out of the joined row, as a lambda would."""
    df = df.withColumn(out, F.lit(0))
    for step in (1 << k for k in reversed(range(size.bit_length()))):
        df = df.withColumn(out, F.col(out) + F.when(
            below(F.get(array, F.col(out) + (step - 1))), step).otherwise(0))
    return df


def _sorted_lists(v: DataFrame, *by: str) -> DataFrame:
    return v.groupBy(*by).agg(F.array_sort(F.collect_list("_v")).alias("_all"))


def _last_in_force(met: DataFrame, facts: DataFrame, pos: str, columns: list[str],
                   size: int) -> DataFrame:
    """Facts beside ``_all``, a sorted list of versions, with those in force at ``pos``."""
    met = _count_below(met, "_all", size, lambda e: e["_at"] < F.col(pos), "_n")
    last = F.get("_all", F.col("_n") - 1)
    # inline: one look-up per fact, however many of its columns are used
    record = F.struct(*[F.col(c) for c in facts.columns], *[last[c].alias(c) for c in columns])
    return rows_where(met, last["_force"], record)


def _asof_broadcast(facts: DataFrame, v: DataFrame, fact_key: str, pos: str,
                    columns: list[str]) -> DataFrame:
    """The measured size of all versions bounds both the lists and the broadcast."""
    lists = _sorted_lists(v, "_key")
    met = facts.join(F.broadcast(lists), F.col(fact_key) == F.col("_key"))
    return _last_in_force(met, facts, pos, columns, _longest(v, "_key"))


def _in_pieces(rows: DataFrame, index: DataFrame, key: str, before) -> DataFrame:
    """``rows`` plus ``_piece``: how many of the key's ``_cuts`` lie ``before`` the row, 0 for
    a key that is not cut. ``index`` has ``PIECES`` keys at most."""
    cut = rows.join(F.broadcast(index.withColumnRenamed("_key", "_cut_key")),
                    F.col(key) == F.col("_cut_key"), "left")
    return _count_below(cut, "_cuts", PIECES, before, "_piece").drop("_cut_key", "_cuts")


def _first_positions(v: DataFrame, n: int, list_rows: int) -> DataFrame:
    """``_key, _cuts`` for each key of many versions: the position of the first version of
    each of its pieces, in order. A fact's last version is in the last piece that begins before
    it. Pieces are cut at quantiles, by aggregation alone."""
    many = v.groupBy("_key").count().where(F.col("count") > max(list_rows, n // PIECES))
    at = v.join(F.broadcast(many.select("_key")), "_key").select(
        "_key", F.col("_v._at").alias("_at"))
    pieces = min(PIECES, max(2, -(-n // list_rows) * 8))
    quantiles = at.groupBy("_key").agg(F.array_sort(F.array_distinct(F.percentile_approx(
        "_at", [i / pieces for i in range(1, pieces)]))).alias("_cuts"))
    first = _in_pieces(at, quantiles, "_key", lambda c: c <= F.col("_at")) \
        .groupBy("_key", "_piece").agg(F.min("_at").alias("_first"))
    return materialize(first.groupBy("_key").agg(
        F.array_sort(F.collect_list("_first")).alias("_cuts")), "pieces")


def _asof_pieces(facts: DataFrame, v: DataFrame, fact_key: str, pos: str, columns: list[str],
                 list_rows: int, list_facts: int) -> DataFrame:
    """``v`` and ``facts`` are stored tables; ``facts`` have neither null keys nor positions."""
    n = v.count()
    index = _first_positions(v, n, list_rows)
    f = _in_pieces(facts, index, fact_key, lambda c: c < F.col(pos))
    crowds = f.groupBy(F.col(fact_key).alias("_key"), "_piece").count() \
        .where(F.col("count") > list_facts) \
        .select("_key", "_piece", F.ceil(F.col("count") / list_facts).cast("int").alias("_copies"))
    crowds = materialize(crowds, "crowds")
    v = _in_pieces(v, index, "_key", lambda c: c <= F.col("_v._at"))
    lists = _sorted_lists(v, "_key", "_piece") \
        .join(sized_broadcast(crowds), ["_key", "_piece"], "left") \
        .withColumn("_copy", F.explode(F.sequence(
            F.lit(1), F.coalesce("_copies", F.lit(1))))).drop("_copies")
    own = crowds.select(F.col("_key").alias("_crowd"), F.col("_piece").alias("_crowd_piece"),
                        "_copies")
    f = f.join(sized_broadcast(own), (F.col(fact_key) == F.col("_crowd"))
               & (F.col("_piece") == F.col("_crowd_piece")), "left") \
        .withColumn("_copy", F.coalesce(F.pmod(F.xxhash64(pos), "_copies"), F.lit(0))
                    .cast("int") + 1) \
        .withColumnRenamed("_piece", "_its_piece").withColumnRenamed("_copy", "_its_copy")
    parts = int(v.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = lists.hint("shuffle_hash" if n <= HASH_ROWS * parts else "merge")
    met = f.join(lists, (F.col(fact_key) == F.col("_key"))
                 & (F.col("_its_piece") == F.col("_piece"))
                 & (F.col("_its_copy") == F.col("_copy")))
    return _last_in_force(met, facts, pos, columns, _longest(v, "_key", "_piece"))
