"""Per-key statistics without per-key tasks.

A window over a key puts every row of the key into one task; with a key that holds a third of the table this is a
third of the table in one task. So instead of windows over raw rows these operators

1. aggregate (map-side combined, narrow),
2. keep only the keys that matter and stage them, which fixes their size for the planner,
3. join back: broadcast when the staged side is really small, otherwise a sort-merge join whose hot row-side
   partitions adaptive execution splits (the statistics side has one row per key).

Windows remain where the group is bounded by meaning, e.g. one row per week of a series.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Stages


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Bring one row of statistics per key back to the rows. NULL keys match NULL keys, as in a window."""
    renamed = stats.select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        *[F.col(c) for c in stats.columns if c not in keys],
    )
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)])
    joined = df.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__key_{i}" for i in range(len(keys))])


def repeated_keys(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).where(F.col(count) > 1)


def with_repeat_count(df: DataFrame, keys: Sequence[str], stages: Stages, count: str = "copies") -> DataFrame:
    """`count` = rows sharing the key, NULL where the row is alone."""
    return attach(df, stages(repeated_keys(df, keys, count), "repeated"), keys)


def with_other_source(df: DataFrame, keys: Sequence[str], source: str, stages: Stages,
                      name: str = "several_sources") -> DataFrame:
    """`name` is true where the key is reported by more than one source, else NULL.

    Minimum <> maximum replaces a distinct count: constant state per key, combined on the map side.
    """
    shared = (
        df.groupBy(*keys).agg(F.min(source).alias("_lo"), F.max(source).alias("_hi"))
        .where(F.col("_lo") != F.col("_hi")).select(*keys, F.lit(True).alias(name))
    )
    return attach(df, stages(shared, "shared"), keys)


def survivors(df: DataFrame, keys: Sequence[str], rank: Sequence[Column], identifier: str,
              stages: Stages, name: str = "survivor") -> DataFrame:
    """`name` = identifier of the best row of the key (smallest `rank`, then smallest identifier)."""
    best = df.groupBy(*keys).agg(F.min(F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)],
                                                F.col(identifier).alias("id"))).alias("_best"))
    return attach(df, stages(best.select(*keys, F.col("_best.id").alias(name)), "survivors"), keys)


def aliases(df: DataFrame, keys: Sequence[str], identifier: str, survivor: str) -> DataFrame:
    """Every identifier that lost its key, one row each: complete for groups of any size."""
    return df.where(F.col(identifier) != F.col(survivor)).select(
        *keys, F.col(survivor).alias("survivor"), F.col(identifier).alias("alias"))


def alias_lists(alias_rows: DataFrame, keys: Sequence[str], name: str = "alias_ids") -> DataFrame:
    """Sorted list and number of the aliases of a key in one row, the established format of the product table. A list is as long
    as its key has aliases; `aliases()` and `alias_pieces()` have them in rows of bounded size."""
    lists = alias_rows.groupBy(*keys, "survivor").agg(F.array_sort(F.collect_set("alias")).alias(name))
    return lists.select(*keys, "survivor", F.size(name).cast("long").alias("n_aliases"), name)


def alias_pieces(alias_rows: DataFrame, keys: Sequence[str], stages: Stages, size: int = 1000, name: str = "alias_ids") -> DataFrame:
    """Aliases of a key in consecutive sorted lists of `size` (the last one shorter): survivor, n_aliases, piece (from 0), list.

    For groups of any size: aliases are numbered over ordered ranges, so no task and no row ever holds a whole key. An alias
    met twice counts once; a key without aliases has no row.
    """
    group = [*keys, "survivor"]
    rows = stages(alias_rows.select(*group, "alias").distinct(), "distinct-aliases")
    total = stages(rows.groupBy(*group).agg(F.count("*").alias("n_aliases")), "alias-counts")
    numbered = running_number(rows, group, [F.col("alias")], stages, "_number")
    piece = F.floor((F.col("_number") - 1) / size).cast("long")
    pieces = numbered.groupBy(*group, piece.alias("piece")).agg(F.sort_array(F.collect_list("alias")).alias(name))
    return attach(pieces, total, group).select(*group, "n_aliases", "piece", name)


def number_copies(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "copy",
                  chunk: int = 100_000) -> DataFrame:
    """Running number of each row inside its group of identical content, ordered by `order`.

    Rows equal in every column are interchangeable, so they are collapsed to one row with a multiplicity (map-side),
    the collapsed rows get the running start (one per file and content, hence few per group), and are expanded
    again in two steps so that one huge group of copies is written by many tasks.
    """
    columns = df.columns
    rest = [c for c in columns if c not in group and c not in order]
    cells = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    before = (
        Window.partitionBy(*group).orderBy(*order, *rest).rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    chunks = cells.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk))))
    # a given number of tasks: chunks are tiny before they are expanded, so adaptive execution would merge all into one task
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(tasks, *[F.col(c) for c in group], F.col("_chunk"))
    first = F.col("_chunk") * chunk + 1
    last = F.least(F.col("_n"), (F.col("_chunk") + 1) * chunk)
    return spread.withColumn("_at", F.explode(F.sequence(first, last))).select(
        *columns, (F.col("_before") + F.col("_at")).cast("long").alias(name))


def running_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column], stages: Stages,
                   name: str = "number") -> DataFrame:
    """row_number over (partition by keys order by order) for groups of any size.

    Rows are range-partitioned by key and order, so a hot key is cut into consecutive ranges. A range number is the
    local row number plus the rows of the same key in earlier ranges. Only the first and last key of a range can need
    that offset, so both broadcasts below are bounded by twice the number of partitions.
    """
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id())
    ranged = stages(ranged, "ranges")
    # ranges are sorted by key, so a key lying in several ranges is the first or last key of each of them
    ends = ranged.groupBy("_range").agg(F.array(F.min(F.struct(*keys)), F.max(F.struct(*keys))).alias("_ends"))
    cut = ends.select(F.explode("_ends").alias("_k")).select(*[F.col(f"_k.{k}").alias(k) for k in keys]).distinct()
    pieces = attach(ranged.select(*keys, "_range"), F.broadcast(cut), keys, "left_semi")
    pieces = pieces.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(*keys, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order))
    numbered = attach(ranged.withColumn("_local", local), F.broadcast(offsets), [*keys, "_range"])
    return numbered.withColumn(name, F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))).drop(
        "_range", "_local", "_offset")


def packed(df: DataFrame, keep: Sequence[str], name: str = "_packed") -> DataFrame:
    """All columns but `keep` as one struct. Windows, sorts and shuffles copy every row several times: a struct goes as one
    block, single columns go field by field."""
    keep = [c for c in df.columns if c in set(keep)]
    return df.select(*keep, F.struct(*[c for c in df.columns if c not in keep]).alias(name))


def unpacked(df: DataFrame, columns: Sequence[str], name: str = "_packed") -> DataFrame:
    """Rows of `packed` with their `columns` in the old order again, then the columns added since."""
    inside = set(df.schema[name].dataType.fieldNames())
    added = [c for c in df.columns if c != name and c not in columns]
    return df.select(*[F.col(f"{name}.{c}").alias(c) if c in inside else F.col(c) for c in columns], *added)


def one_row(*frames: DataFrame) -> DataFrame:
    """Several one-row relations with different columns as one row (an aggregate over their union, no join)."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def exact_median(df: DataFrame, keys: Sequence[str], value: Column, stages: Stages,
                 name: str = "median", count: str = "observations", ordered_limit: int = 2_000_000) -> DataFrame:
    """Exact median and count per key for keys of any size.

    Equal values are counted first (on the map side). The middle ranks are then located through buckets: logarithmic
    ones, then linear ones inside the chosen bucket, until the chosen bucket has at most `ordered_limit` distinct
    values. Only that bucket is ordered value by value, so no task ever orders a whole key.
    """
    keys = list(keys)
    v = F.col("_v")
    magnitude = F.floor(F.log(F.abs(v)) * 32) + 100_000          # |log| of any double stays below 100 000 / 32
    infinite, largest_bucket = F.abs(v) == float("inf"), F.lit(200_001)
    bucket = (F.when(F.isnan(v), largest_bucket + 1).when(infinite & (v > 0), largest_bucket).when(infinite, -largest_bucket)
              .when(v > 0, magnitude).when(v < 0, -magnitude).otherwise(F.lit(0)).cast("int"))
    rows = stages(
        df.select(*keys, value.cast("double").alias("_v")).where(v.isNotNull())
        .groupBy(*keys, "_v").agg(F.count("*").alias("_n")), "values")
    segment: list[str] = []                                       # empty: the whole key
    while True:
        part = [*keys, *segment]
        known = ["_start", count] if segment else []
        sizes = rows.withColumn("_b", bucket).groupBy(*part, *known, "_b").agg(
            F.sum("_n").alias("_bn"), F.count("*").alias("_values"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        if not segment:
            sizes = sizes.withColumns({"_start": F.lit(0).cast("long"),
                                       count: F.sum("_bn").over(Window.partitionBy(*keys))})   # buckets, not rows
        upto = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        sizes = sizes.withColumn("_end", F.col("_start") + F.sum("_bn").over(upto)).withColumn(
            "_start", F.col("_end") - F.col("_bn"))
        low, high = _middle(count)
        holds = [(rank > F.col("_start")) & (rank <= F.col("_end")) for rank in (low, high)]
        chosen = stages(sizes.where(holds[0] | holds[1]).select(
            *part, "_b", "_start", "_min", "_max", "_values", count, F.when(holds[0], 0).otherwise(1).alias("_which")), "middle")
        rows = attach(rows.withColumn("_b", bucket).drop("_start", count, "_min", "_max", "_values"), chosen,
                      [*part, "_b"], "inner")
        rows = rows.drop("_b", *segment).withColumnRenamed("_which", "_segment")
        segment = ["_segment"]
        spread = F.col("_min") < F.col("_max")
        largest = chosen.agg(F.max(F.when(spread, F.col("_values")))).first()[0]     # one number
        if (largest or 0) <= ordered_limit:
            break
        width = (F.col("_max") - F.col("_min")) / 4096
        bucket = F.when(spread, F.floor((v - F.col("_min")) / width)).otherwise(F.lit(0)).cast("int")
    inside = Window.partitionBy(*keys, "_segment").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_upto", F.col("_start") + F.sum("_n").over(inside))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank), v))

    low, high = _middle(count)
    return rows.groupBy(*keys).agg((at(low) * 0.5 + at(high) * 0.5).alias(name), F.max(count).alias(count))


def _middle(count: str) -> tuple[Column, Column]:
    """The two middle ranks (equal for an odd count)."""
    return F.floor((F.col(count) + 1) / 2), F.floor((F.col(count) + 2) / 2)


def sample_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 5) -> DataFrame:
    """First `n` rows per key. Spark prunes each task to its own first n before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def latest(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The newest row per key as one aggregate (no sort of the group)."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(time)).alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
