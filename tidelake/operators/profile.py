"""Column profiles, audits and descriptive statistics, each in one aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.times import iso_utc
from tidelake.operators.small import join_small, settle

HISTOGRAM_BINS = 24
# fixed values: column prefix -> silver dataset it came from (first match counts)
COLUMN_SOURCE = {
    "option_trades_": "option_trades_1m_feature",
    "spot_": "spot_1m",
    "perp_": "perp_1m",
    "oi_": "oi_1m_feature",
    "funding_": "funding_1m_feature",
    "trades_": "perp_trades_1m_feature",
}
MERGED_SOURCE = "gold_merged"
# fixed values: display order of numeric columns by prefix; the rest comes last
NUMERIC_GROUPS = [("spot_", "perp_"), ("oi_", "funding_"), ("l2_",)]


def source_of_column(name: Column) -> Column:
    out = F.lit(MERGED_SOURCE)
    for prefix, dataset in reversed(COLUMN_SOURCE.items()):
        out = F.when(name.startswith(prefix), F.lit(dataset)).otherwise(out)
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in display order."""

    def group(name: str) -> int:
        return next((i for i, prefixes in enumerate(NUMERIC_GROUPS) if name.startswith(prefixes)), len(NUMERIC_GROUPS))

    return sorted((f.name for f in df.schema if isinstance(f.dataType, T.NumericType)), key=group)


def numeric_column_order(df: DataFrame) -> dict[str, int]:
    return {name: i for i, name in enumerate(numeric_columns(df))}


def metadata_parts(df: DataFrame, time: str) -> tuple[list[Column], dict[str, Column]]:
    """Aggregates over ``df`` and, per column, what they say of it: type, null counts, source, time range, statistics.

    The cells also need the group's row count as ``_rows``.
    """
    aggs, cells = [], {}
    for i, field in enumerate(df.schema):
        c, numeric = F.col(field.name), isinstance(field.dataType, T.NumericType)
        present = F.when(c.isNotNull(), F.col(time)) if field.name != time else F.col(time)
        aggs += [
            F.count(c).alias(f"_n{i}"),
            F.min(present).alias(f"_a{i}"),
            F.max(present).alias(f"_z{i}"),
        ]
        stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
        if numeric:
            aggs += [fn(c).cast("double").alias(f"_{name}{i}") for name, fn in stats.items()]
        nothing = F.lit(None).cast("double")
        cells[field.name] = F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("dtype"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
            F.col(f"_n{i}").alias("non_null_count"),
            source_of_column(F.lit(field.name)).alias("source_dataset"),
            iso_utc(F.col(f"_a{i}")).alias("min_timestamp"),
            iso_utc(F.col(f"_z{i}")).alias("max_timestamp"),
            *[(F.col(f"_{name}{i}") if numeric else nothing).alias(name) for name in stats],
        )
    return aggs, cells


def metadata_json(cells: dict[str, Column]) -> Column:
    """The cells of :func:`metadata_parts` as one JSON object, keyed by column."""
    return F.to_json(F.struct(*[cell.dropFields("column_name").alias(name) for name, cell in cells.items()]), {"ignoreNullFields": "false"})


def _by_column(df: DataFrame, by: list[str], time: str | None, names: list[str]) -> DataFrame:
    """A row per row and column: group, time ``_t``, column number ``_c`` and value ``_v`` as double.

    What is no number is 0.0 where it is present. Wide tables are counted this way, column after column: the aggregate over
    these rows has a handful of buffers however many columns there are, so it stays in generated code and is reduced in the
    map tasks.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    values = [
        (F.col(c).cast("double") if c in numeric else F.when(F.col(c).isNotNull(), F.lit(0.0))).alias(str(i)) for i, c in enumerate(names)
    ]
    keys = [F.col(b).alias(f"_by_{b}") for b in by]
    clock = F.lit(None).cast("timestamp") if time is None else F.col(time)
    long = df.select(*keys, clock.alias("_t"), *values).unpivot([*[f"_by_{b}" for b in by], "_t"], [str(i) for i in range(len(names))], "_c", "_v")
    return long.withColumn("_c", F.col("_c").cast("int"))


def _column_counts(df: DataFrame, by: list[str], time: str | None, names: list[str], *aggs: Column) -> DataFrame:
    long = _by_column(df, by, time, names)
    return long.groupBy(*[F.col(f"_by_{b}").alias(b) for b in by], "_c").agg(F.count(F.lit(1)).alias("_rows"), F.count("_v").alias("_n"), *aggs)


def _told(column: Column, values: list) -> Column:
    """What a list says of the column of that number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), column + 1)


def feature_metadata(df: DataFrame, by: list[str], time: str) -> DataFrame:
    """One row per group and column: type, null counts, source, time range, and statistics of numeric columns."""
    present = F.when(F.col("_v").isNotNull(), F.col("_t"))
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    counts = _column_counts(
        df, by, time, df.columns, F.min(present).alias("_a"), F.max(present).alias("_z"), *[fn("_v").alias(f"_{name}") for name, fn in stats.items()]
    )
    c = F.col("_c")
    numeric = _told(c, [isinstance(f.dataType, T.NumericType) for f in df.schema])
    return counts.select(
        *by,
        _told(c, df.columns).alias("column_name"),
        _told(c, [f.dataType.simpleString() for f in df.schema]).alias("dtype"),
        (F.col("_rows") - F.col("_n")).alias("null_count"),
        F.col("_n").alias("non_null_count"),
        source_of_column(_told(c, df.columns)).alias("source_dataset"),
        iso_utc(F.col("_a")).alias("min_timestamp"),
        iso_utc(F.col("_z")).alias("max_timestamp"),
        *[F.when(numeric, F.col(f"_{name}")).alias(name) for name in stats],
    )


def missing_audit(df: DataFrame, by: list[str]) -> DataFrame:
    """Nulls per group and column, with the group's total."""
    counts = _column_counts(df, by, None, df.columns).withColumn("missing", F.col("_rows") - F.col("_n"))
    total = F.sum("missing").over(Window.partitionBy(*by))
    return counts.select(*by, total.alias("missing_total"), _told(F.col("_c"), df.columns).alias("column_name"), "missing")


def span_coverage(df: DataFrame, by: list[str], time: str) -> DataFrame:
    """Time span, minutes it should hold, minutes missing and the observed share."""
    expected = F.expr(f"(unix_micros(max({time})) - unix_micros(min({time}))) div 60000000") + 1
    out = df.groupBy(*by).agg(
        F.min(time).alias("min_timestamp"),
        F.max(time).alias("max_timestamp"),
        F.count(F.lit(1)).alias("rows_out"),
        expected.alias("expected_minutes"),
    )
    return out.withColumns(
        {
            "missing_minutes": F.greatest(F.col("expected_minutes") - F.col("rows_out"), F.lit(0)),
            "coverage_ratio": F.col("rows_out") / F.col("expected_minutes"),
        }
    )


def source_summary(frame: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Columns, rows and symbol names of one gold input per group."""
    return frame.groupBy(*by).agg(
        F.lit(name).alias("source_dataset"),
        F.lit(",".join(c for c in frame.columns if c not in by or c == "exchange")).alias("columns"),
        F.count(F.lit(1)).alias("rows"),
        F.array_join(F.array_sort(F.collect_set("symbol")), ",").alias("source_symbols"),
    )


def profile_stats(df: DataFrame, by: list[str], time: str) -> DataFrame:
    """Available and missing rows, mean, variance, 1-3 sigma and first time of every numeric column.

    ``missing_pct`` is taken of the available rows, ``missing_pct_total`` of all rows.
    """
    names = numeric_columns(df)
    first = F.min(F.when(F.col("_v").isNotNull(), F.col("_t")))
    counts = _column_counts(df, by, time, names, F.avg("_v").alias("mean"), F.var_samp("_v").alias("var"), first.alias("first_timestamp"))
    n, missing, sigma = F.col("_n"), F.col("_rows") - F.col("_n"), F.sqrt("var")
    return counts.select(
        *by,
        _told(F.col("_c"), names).alias("feature"),
        n.alias("available"),
        missing.alias("missing"),
        F.when(n > 0, missing * 100.0 / n).otherwise(F.lit(0.0)).alias("missing_pct"),
        (missing * 100.0 / F.col("_rows")).alias("missing_pct_total"),
        "mean",
        "var",
        sigma.alias("std_1"),
        (sigma * 2.0).alias("std_2"),
        (sigma * 3.0).alias("std_3"),
        "first_timestamp",
    )


def _ranges(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    aggs = [fn(c).cast("double").alias(f"_{p}{i}") for i, c in enumerate(columns) for p, fn in (("lo", F.min), ("hi", F.max))]
    return df.groupBy(*by).agg(*aggs)


def minmax_scale(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Columns rescaled to 0..1 per group; a constant column becomes 0 and missing values NaN.

    The rows are written once, as their ranges are needed before the first of them can be rescaled.
    """
    source = settle(df, "minmax")
    rows = join_small(source, _ranges(source, by, columns), by)
    scaled = {}
    for i, name in enumerate(columns):
        lo, hi, x = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(name).cast("double")
        value = F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))
        scaled[f"{name}_scaled"] = F.when(x.isNull(), F.lit(float("nan"))).otherwise(value)
    return rows.withColumns(scaled).select(*df.columns, *scaled)


def histogram(df: DataFrame, by: list[str], columns: list[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bin counts of each column over all rows; one bin when all values are equal.

    The rows are written once, as their ranges are needed before the first of them has a bin. Values become (column, bin)
    pairs that are counted in the map tasks, so only bin counts are shuffled.
    """
    source = settle(df.select(*by, *columns), "histogram")
    rows = join_small(source, _ranges(source, by, columns), by)
    cells = []
    for i, name in enumerate(columns):
        lo, hi, x = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(name).cast("double")
        place = F.least(F.floor((x - lo) / ((hi - lo) / bins)), F.lit(bins - 1)) + 1
        cells.append(
            F.struct(F.lit(name).alias("feature"), F.when(hi == lo, F.lit(1)).otherwise(place).alias("bin"), x.alias("x"))
        )
    return (
        rows.select(*by, F.inline(F.array(*cells)))
        .where(F.col("x").isNotNull())
        .groupBy(*by, "feature", "bin")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("x").alias("lowest"), F.max("x").alias("highest"))
    )


def descriptive_stats(df: DataFrame, variables: list[str]) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per variable; variables that are not columns are null."""
    have = set(df.columns)
    stats = {"Mean": F.avg, "Std": F.stddev_samp, "Min": F.min, "Max": F.max}
    nothing = F.lit(None).cast("double")
    wide = df.agg(
        *[
            (fn(F.col(v).cast("double")) if v in have else F.max(nothing)).alias(f"_{name}_{v}")
            for v in variables
            for name, fn in stats.items()
        ]
    )
    cells = [
        F.struct(F.lit(v).alias("Variable"), *[F.col(f"_{name}_{v}").alias(name) for name in stats]) for v in variables
    ]
    return wide.select(F.inline(F.array(*cells)))
