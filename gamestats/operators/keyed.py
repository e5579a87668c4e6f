"""Keyed aggregations (A1-A5, A9): means, percentages and ratios per key.

Each is one ``groupBy(...).agg(...)``: Spark plans a partial HashAggregate
before the shuffle and a final one after it, so a hot key (one event or band
holding a third of all games) reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestats.sources.scratch import written

Keys = str | Column | Sequence[str | Column]


def _keys(keys: Keys) -> list[str | Column]:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean_of(measure: str | Column) -> Column:
    return F.avg(_col(measure).cast("double"))


def pct_of(flag: str | Column) -> Column:
    """Percentage of rows whose 0/1 flag is 1: mean * 100 (double)."""
    return F.avg(_col(flag).cast("double")) * F.lit(100.0)


def keyed_mean(df: DataFrame, keys: Keys, measure: str | Column, alias: str) -> DataFrame:
    """A1: mean of a measure per key."""
    return df.groupBy(*_keys(keys)).agg(mean_of(measure).alias(alias))


def keyed_pct(df: DataFrame, keys: Keys, flag: str | Column, alias: str) -> DataFrame:
    """A2: percentage of a 0/1 flag per key."""
    return df.groupBy(*_keys(keys)).agg(pct_of(flag).alias(alias))


def keyed_sum(df: DataFrame, keys: Keys, measure: str | Column, alias: str) -> DataFrame:
    """A3."""
    return df.groupBy(*_keys(keys)).agg(F.sum(_col(measure)).alias(alias))


def keyed_count(df: DataFrame, keys: Keys, alias: str) -> DataFrame:
    """A4."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(alias))


def keyed_ratio(df: DataFrame, key: str, flag: str | Column, alias: str) -> DataFrame:
    """A5 in the reference's form: a keyed sum of the flag and a keyed count,
    inner-joined on the key (J1), then ``sum / count * 100``.

    A NULL key is a group like any other.  The input is scanned once per side
    and only per-key totals are joined; ``keyed_pct`` gives the same values in
    one scan and one aggregation.
    """
    sums = keyed_sum(df, key, _col(flag).cast("long"), "_flag_sum")
    counts = keyed_count(df, key, "_games").withColumnRenamed(key, "_key")
    joined = sums.join(counts, on=F.col(key).eqNullSafe(F.col("_key")), how="inner")
    return joined.select(
        F.col(key),
        ((F.col("_flag_sum").cast("double") / F.col("_games").cast("double"))
         * F.lit(100.0)).alias(alias))


def grouping_label(set_names: Mapping[str, Sequence[str]], all_keys: Sequence[str]) -> Column:
    """Name of the grouping set a row belongs to, from ``grouping_id()``.

    Bit ``i`` (counting from the left of ``all_keys``) is 1 when key ``i`` is
    not in the set, the SQL standard rule shared by Spark and DuckDB.
    """
    gid = F.grouping_id(*all_keys)
    n = len(all_keys)
    expr = None
    for name, members in set_names.items():
        code = sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in members)
        expr = (F.when if expr is None else expr.when)(gid == F.lit(code), F.lit(name))
    return expr


def multi_keyed(df: DataFrame, sets: Mapping[str, Sequence[str]],
                aggs: Mapping[str, Column], label: str = "grouping_set") -> DataFrame:
    """A9: several keyed aggregations over one scan with GROUPING SETS.

    ``sets`` maps a label to the key columns of one grouping set.  The result
    has every key column (NULL where not grouped), the label column, and the
    aggregates.  One Expand + one partial/final aggregation replace one job per
    key.
    """
    all_keys: list[str] = []
    for members in sets.values():
        for k in members:
            if k not in all_keys:
                all_keys.append(k)
    grouped = df.groupingSets([list(m) for m in sets.values()], *all_keys)
    return grouped.agg(grouping_label(sets, all_keys).alias(label),
                       *[c.alias(n) for n, c in aggs.items()])


def rolled_up(df: DataFrame, sets: Mapping[str, Sequence[str]], means: Mapping[str, str],
              count: str = "games", label: str = "grouping_set") -> DataFrame:
    """A9 without copying the detail: the means of whole-number measures
    (``{alias: column}``) and a count per grouping set, as ``multi_keyed`` gives
    them.

    The detail is aggregated once, by all keys together, to sums and counts;
    that state is written and every grouping set is added up from it.  The state
    has a row per combination of keys: where there are about as many of those as
    rows, ``multi_keyed`` is the better plan (see ``state_is_smaller``).
    """
    all_keys = list(dict.fromkeys(k for members in sets.values() for k in members))
    measures = list(dict.fromkeys(means.values()))
    partial = df.groupBy(*all_keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.col(m).cast("long")).alias(f"_sum{i}") for i, m in enumerate(measures)],
        *[F.count(F.col(m)).alias(f"_n{i}") for i, m in enumerate(measures)])
    state = written(partial, "grouping-state")
    types = dict(df.dtypes)
    out = None
    for name, members in sets.items():
        grouped = state.groupBy(*members).agg(
            F.sum("_rows").alias("_rows"),
            *[F.sum(f"_sum{i}").alias(f"_sum{i}") for i in range(len(measures))],
            *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(measures))])
        part = grouped.select(
            *[(F.col(k) if k in members else F.lit(None).cast(types[k])).alias(k) for k in all_keys],
            F.lit(name).alias(label), F.col("_rows").alias(count),
            *[F.when(F.col(f"_n{i}") > 0, F.col(f"_sum{i}").cast("double") / F.col(f"_n{i}")).alias(a)
              for a, i in ((a, measures.index(m)) for a, m in means.items())])
        out = part if out is None else out.unionByName(part)
    return out


def state_is_smaller(df: DataFrame, sets: Mapping[str, Sequence[str]]) -> bool:
    """Whether the state of ``rolled_up`` has fewer rows than the copies of the
    input that grouping sets make, by an estimate of the number of key
    combinations: one narrow pass without a shuffle of rows.  The state is made
    by as many partial states as there are tasks, so it must be clearly smaller."""
    all_keys = list(dict.fromkeys(k for members in sets.values() for k in members))
    row = df.agg(F.approx_count_distinct(F.struct(*all_keys)).alias("states"),
                 F.count(F.lit(1)).alias("rows")).first()
    tasks = max(1, df.sparkSession.sparkContext.defaultParallelism)
    return min(row["states"] * tasks, row["rows"]) + row["states"] < len(sets) * row["rows"]
