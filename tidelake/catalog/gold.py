"""Feature families, the minute grid, gold datasets, audits and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.catalog import sql as S
from tidelake.catalog.base import query, rounded
from tidelake.functions.times import trunc_minute
from tidelake.operators import lagging, profile, quality
from tidelake.operators.grid import minute_grid as build_minute_grid
from tidelake.plans import gold, silver
from tidelake.schemas import GOLD_INPUTS, GOLD_WITH_L2, L2_INPUT, PROFILE_SAMPLE_ROWS, SILVER_COLUMNS, source_key

SYMBOL = ["exchange", "symbol"]
CTE_OF = {
    "spot": "g_spot",
    "perp": "g_perp",
    "oi_1m_feature": "g_oi",
    "funding_1m_feature": "g_funding",
    "perp_trades_1m_feature": "g_trades",
    "option_trades_1m_feature": "g_options",
    L2_INPUT: "g_l2",
}
TRADE_SUMS = [f"{p}_{c}" for p in ("trades", "option_trades") for c in ("volume", "quote_volume", "buy_volume", "sell_volume", "buy_volume_share")]


def _inputs(dataset_id: str) -> list[str]:
    return GOLD_INPUTS[dataset_id] + ([L2_INPUT] if dataset_id in GOLD_WITH_L2 else [])


def _cte(dataset_id: str) -> str:
    return dataset_id.replace(".", "_")


for _id in GOLD_INPUTS:
    S.gold_cte(_cte(_id), [CTE_OF[i] for i in _inputs(_id)])

# the lenient order-book rule: symbols with a bad row keep only rows whose check is known and fine
_L2_BAD = "(l2_coverage_ratio < 0 OR l2_coverage_ratio > 1 OR l2_snapshot_count < 0 OR l2_first_snapshot_ts > l2_last_snapshot_ts)"
S.CTES["l2_found"] = (
    [_cte("gold.hybrid.full_l2.m1")],
    f"""SELECT exchange AS e_, symbol AS s_, count(*) FILTER (WHERE {_L2_BAD}) AS found, count(*) AS rows,
      count(*) FILTER (WHERE NOT {_L2_BAD}) AS good FROM {_cte("gold.hybrid.full_l2.m1")} GROUP BY 1, 2""",
)
S.CTES["hybrid_lenient"] = (
    ["l2_found"],
    f"""SELECT g.* FROM {_cte("gold.hybrid.full_l2.m1")} g JOIN l2_found ON exchange = e_ AND symbol = s_
      WHERE found = 0 OR NOT {_L2_BAD}""",
)


def _round_sql(columns: list[str], source: str, digits: int = 6) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {digits}) AS {c}' for c in columns)}) FROM {source}"


def frame(f, dataset_id: str, l2_mode: str = "lenient"):
    return gold.gold_frame({n: f.silver(n) for n in _inputs(dataset_id)}, dataset_id, l2_mode)


# ---- prepared families ----------------------------------------------------------------------------


@query("prep_spot", "SELECT * FROM g_spot", "g_spot")
def prep_spot(f):
    return gold.prepare("spot", f.silver("spot"))


@query("prep_perp", "SELECT * FROM g_perp", "g_perp")
def prep_perp(f):
    return gold.prepare("perp", f.silver("perp"))


@query("prep_oi", "SELECT * FROM g_oi", "g_oi")
def prep_oi(f):
    return gold.prepare("oi_1m_feature", f.silver("oi_1m_feature"))


@query("prep_funding", "SELECT * FROM g_funding", "g_funding")
def prep_funding(f):
    return gold.prepare("funding_1m_feature", f.silver("funding_1m_feature"))


@query("prep_trades", _round_sql(TRADE_SUMS[:5], "g_trades"), "g_trades")
def prep_trades(f):
    return rounded(gold.prepare("perp_trades_1m_feature", f.silver("perp_trades_1m_feature")), 6, *TRADE_SUMS[:5])


@query("prep_option_trades", _round_sql(TRADE_SUMS[5:], "g_options"), "g_options")
def prep_option_trades(f):
    return rounded(gold.prepare("option_trades_1m_feature", f.silver("option_trades_1m_feature")), 6, *TRADE_SUMS[5:])


@query("prep_l2", "SELECT * FROM g_l2", "g_l2")
def prep_l2(f):
    return gold.prepare(L2_INPUT, f.l2())


# ---- grid and datasets ----------------------------------------------------------------------------


@query(
    "minute_grid",
    "SELECT timestamp_m1, exchange, symbol FROM gold_market_core_m1",
    "gold_market_core_m1",
)
def minute_grid(f):
    prepared = {n: gold.prepare(n, f.silver(n)) for n in ("spot", "perp")}
    return build_minute_grid(gold.family_spans(prepared))


def _register(name: str, dataset_id: str, sums: list[str]) -> None:
    source = "hybrid_lenient" if dataset_id in GOLD_WITH_L2 else _cte(dataset_id)
    sql = _round_sql(sums, source) if sums else f"SELECT * FROM {source}"

    @query(name, sql, source)
    def build(f):
        return rounded(frame(f, dataset_id), 6, *sums)


_register("gold_core", "gold.market.core.m1", [])
_register("gold_core_funding", "gold.market.core_funding.m1", [])
_register("gold_perp_trades", "gold.market.perp_trades.m1", TRADE_SUMS[:5])
_register("gold_option_trades", "gold.market.option_trades.m1", TRADE_SUMS[5:])
_register("grid_left_join", "gold.market.full.m1", TRADE_SUMS)
_register("gold_hybrid_lenient", "gold.hybrid.full_l2.m1", TRADE_SUMS)


@query(
    "symbol_intersection",
    "SELECT exchange, symbol FROM l2_found_symbols",
    "l2_found_symbols",
)
def symbol_intersection(f):
    listed = None
    for name in GOLD_INPUTS["gold.market.full.m1"]:
        part = f.silver(name).select(F.lit(name).alias("dataset_type"), "exchange", "symbol").distinct()
        listed = part if listed is None else listed.unionByName(part)
    return gold.gold_symbols(listed, "gold.market.full.m1")


S.CTES["l2_found_symbols"] = (
    ["g_spot", "g_perp", "g_oi", "g_funding", "g_trades", "g_options"],
    " INTERSECT ".join(f"SELECT exchange, symbol FROM {c}" for c in ("g_spot", "g_perp", "g_oi", "g_funding", "g_trades", "g_options")),
)


# a symbol universe in which inputs are missing for some symbols: suppliers stand for symbols, nations for inputs
_DATASETS = ["spot", "perp", "oi_1m_feature", "funding_1m_feature", "perp_trades_1m_feature", "option_trades_1m_feature"]
S.CTES["universe"] = (
    [],
    f"""SELECT list_extract({_DATASETS!r}, (c_nationkey % 6 + 1)::BIGINT) AS dataset_type, 'deribit' AS exchange,
      'S' || (c_custkey // 10) || '_USDC' AS symbol FROM customer""",
)


def universe(f):
    names = F.array(*[F.lit(d) for d in _DATASETS])
    return f.table("customer").select(
        F.element_at(names, F.pmod("c_nationkey", F.lit(6)) + 1).alias("dataset_type"),
        F.lit("deribit").alias("exchange"),
        F.concat(F.lit("S"), F.floor(F.col("c_custkey") / 10).cast("string"), F.lit("_USDC")).alias("symbol"),
    )


@query(
    "discover_gold_symbols",
    f"""SELECT exchange, split_part(symbol, '_', 1) AS symbol FROM universe
    WHERE dataset_type IN ('spot', 'perp', 'funding_1m_feature') GROUP BY 1, 2 HAVING count(DISTINCT dataset_type) = 3""",
    "universe",
)
def discover_gold_symbols(f):
    return gold.gold_symbols(universe(f), "gold.market.core_funding.m1")


# expected values, written out: what each gold dataset is joined from
_EXPECTED_INPUTS = {
    "gold.market.perp_trades.m1": ["perp_trades_1m_feature"],
    "gold.market.option_trades.m1": ["option_trades_1m_feature"],
    "gold.market.core.m1": ["spot", "perp"],
    "gold.market.core_funding.m1": ["spot", "perp", "funding_1m_feature"],
    "gold.market.full.m1": ["spot", "perp", "oi_1m_feature", "funding_1m_feature", "perp_trades_1m_feature", "option_trades_1m_feature"],
    "gold.hybrid.full_l2.m1": ["spot", "perp", "oi_1m_feature", "funding_1m_feature", "perp_trades_1m_feature", "option_trades_1m_feature"],
}


@query(
    "version_skip_policy",
    " UNION ALL ".join(
        f"""SELECT '{d}' AS dataset_id, exchange, symbol, len(missing) = 0 AS buildable, array_to_string(missing, ',') AS missing_inputs
        FROM (SELECT exchange, symbol, list_sort(list_filter({_EXPECTED_INPUTS[d]!r}, lambda x: NOT list_contains(have, x))) AS missing
          FROM (SELECT exchange, split_part(symbol, '_', 1) AS symbol, list(DISTINCT dataset_type) AS have FROM universe GROUP BY 1, 2))"""
        for d in _EXPECTED_INPUTS
    ),
    "universe",
)
def version_skip_policy(f):
    return gold.build_availability(universe(f), list(GOLD_INPUTS))


@query(
    "set_intersection_column_subset",
    """SELECT symbol, len(have) = 6 AS full_set, list_has_all(have, ['perp', 'spot']) AS has_core,
      len(list_intersect(have, ['perp', 'spot'])) AS core_inputs
    FROM (SELECT symbol, list(DISTINCT dataset_type) AS have FROM universe GROUP BY 1)""",
    "universe",
)
def set_intersection_column_subset(f):
    core = F.array(F.lit("perp"), F.lit("spot"))
    have = universe(f).groupBy("symbol").agg(F.collect_set("dataset_type").alias("have"))
    return have.select(
        "symbol",
        (F.size("have") == 6).alias("full_set"),
        (F.size(F.array_except(core, "have")) == 0).alias("has_core"),
        F.size(F.array_intersect("have", core)).cast("bigint").alias("core_inputs"),
    )


@query(
    "row_max_min",
    """SELECT run_id, greatest(open_price, close_price) AS body_high, least(open_price, close_price) AS body_low
    FROM candles""",
    "candles",
)
def row_max_min(f):
    return f.candles().select(
        "run_id",
        F.greatest("open_price", "close_price").alias("body_high"),
        F.least("open_price", "close_price").alias("body_low"),
    )


# ---- order-book checks ----------------------------------------------------------------------------


@query(
    "l2_quality_mask",
    f"SELECT timestamp_m1, symbol, l2_snapshot_count, l2_coverage_ratio, {_L2_BAD} AS is_bad FROM g_l2",
    "g_l2",
)
def l2_quality_mask(f):
    rows = gold.prepare(L2_INPUT, f.l2())
    return rows.select(
        "timestamp_m1", "symbol", "l2_snapshot_count", "l2_coverage_ratio", quality.l2_invalid(rows.columns).alias("is_bad")
    )


@query(
    "l2_strict_or_lenient",
    """SELECT e_ AS exchange, s_ AS symbol, found AS l2_invalid_rows_found,
      CASE WHEN found > 0 THEN rows - good ELSE 0 END AS l2_invalid_rows_dropped FROM l2_found""",
    "l2_found",
)
def l2_strict_or_lenient(f):
    prepared = {n: gold.prepare(n, f.silver(n)) for n in _inputs("gold.hybrid.full_l2.m1")}
    return gold.l2_counts(gold.family_spans(prepared), prepared[L2_INPUT])


# ---- audits and profiles --------------------------------------------------------------------------

_FUNDING_GOLD = "gold_market_core_funding_m1"


def funding_gold(f):
    return frame(f, "gold.market.core_funding.m1")


_GOLD_COLUMNS = (
    ["timestamp_m1", "exchange", "symbol"]
    + [f"{p}_{c}" for p in ("spot", "perp") for c in ("open_price", "high_price", "low_price", "close_price", "volume")]
    + ["funding_rate_last_known", "minutes_since_funding", "is_funding_observation_minute", "funding_data_available"]
)
_NUMERIC = _GOLD_COLUMNS[3:15]
# expected values, written out: the source that the beginning of a column's name stands for
_SOURCES = [
    ("option_trades_", "option_trades_1m_feature"), ("spot_", "spot_1m"), ("perp_", "perp_1m"), ("oi_", "oi_1m_feature"),
    ("funding_", "funding_1m_feature"), ("trades_", "perp_trades_1m_feature"), ("", "gold_merged"),
]
# expected values, written out: the widest gold table without order-book rows, by type
_BARS = "open_price high_price low_price close_price volume quote_volume buy_volume sell_volume buy_volume_share".split()
_BAR_COUNTS = "trade_count buy_trade_count sell_trade_count".split()
_FULL_GOLD = "gold_market_full_m1"
_FULL_TYPES = {
    **dict.fromkeys(["exchange", "symbol"], "string"),
    "timestamp_m1": "timestamp",
    **{f"{p}_{c}": "double" for p in ("spot", "perp") for c in ("open_price", "high_price", "low_price", "close_price", "volume")},
    **dict.fromkeys(["oi_open_interest", "funding_rate_last_known"], "double"),
    **dict.fromkeys(["oi_is_observed", "oi_is_ffill", "is_funding_observation_minute", "funding_data_available"], "boolean"),
    **dict.fromkeys(["minutes_since_oi_observation", "oi_observation_lag_sec", "minutes_since_funding"], "bigint"),
    **{f"{p}_{c}": "double" for p in ("trades", "option_trades") for c in _BARS},
    **{f"{p}_{c}": "bigint" for p in ("trades", "option_trades") for c in _BAR_COUNTS},
}
_FULL_NUMERIC = [c for c, kind in _FULL_TYPES.items() if kind in ("double", "bigint")]


def full_gold(f):
    return frame(f, "gold.market.full.m1")


def _digits_sql(x: str) -> str:
    """Nine digits behind the point, or behind the first digit: long sums depend on addition order in their last ones."""
    unit = f"pow(10.0::DOUBLE, floor(log10(abs({x}))))"
    return f"CASE WHEN abs({x}) >= 1 THEN round({x} / {unit}, 9) * {unit} ELSE round({x}, 9) END"


def _digits(df, *names: str):
    def cut(name):
        unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(name))).cast("double"))
        return F.when(F.abs(name) >= 1, F.round(F.col(name) / unit, 9) * unit).otherwise(F.round(name, 9))

    return df.withColumns({n: cut(n) for n in names})


def _source(c: str) -> str:
    return next(source for prefix, source in _SOURCES if c.startswith(prefix))


def _meta_sql(c: str) -> str:
    numeric = c in _FULL_NUMERIC
    present = "timestamp_m1" if c == "timestamp_m1" else f"CASE WHEN {c} IS NOT NULL THEN timestamp_m1 END"
    stats = {"mean": "avg({0})", "std": "stddev_samp({0})", "min": "min({0})::DOUBLE", "max": "max({0})::DOUBLE"}
    cells = [f"{_digits_sql(s.format(c)) if numeric else 'NULL::DOUBLE'} AS {n}" for n, s in stats.items()]
    return f"""SELECT exchange, symbol, '{c}' AS column_name, '{_FULL_TYPES[c]}' AS dtype, count(*) - count({c}) AS null_count,
      count({c}) AS non_null_count, '{_source(c)}' AS source_dataset,
      strftime(min({present}), '%Y-%m-%dT%H:%M:%SZ') AS min_timestamp,
      strftime(max({present}), '%Y-%m-%dT%H:%M:%SZ') AS max_timestamp, {', '.join(cells)}
    FROM {_FULL_GOLD} GROUP BY exchange, symbol"""


@query("feature_metadata", " UNION ALL ".join(_meta_sql(c) for c in _FULL_TYPES), _FULL_GOLD)
def feature_metadata(f):
    meta = profile.feature_metadata(full_gold(f), SYMBOL, "timestamp_m1")
    return _digits(meta, "mean", "std", "min", "max")


@query(
    "source_of_column",
    "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{_source(c)}')" for c in _FULL_TYPES) + f""") v(column_name, source_dataset)
    WHERE (SELECT count(*) > 0 FROM {_FULL_GOLD})""",
    _FULL_GOLD,
)
def source_of_column(f):
    audit = profile.missing_audit(full_gold(f), SYMBOL)
    names = audit.select("column_name").distinct()
    return names.withColumn("source_dataset", profile.source_of_column(F.col("column_name")))


@query(
    "numeric_column_order",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS position, count({c}) AS available FROM {_FUNDING_GOLD}"
        for i, c in enumerate(_NUMERIC)
    ),
    _FUNDING_GOLD,
)
def numeric_column_order(f):
    joined = funding_gold(f)
    cells = [
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), F.col(f"_{i}").alias("available"))
        for c, i in profile.numeric_column_order(joined).items()
    ]
    counts = joined.agg(*[F.count(c).alias(f"_{i}") for c, i in profile.numeric_column_order(joined).items()])
    return counts.select(F.inline(F.array(*cells)))


_TOTAL = " + ".join(f"(count(*) - count({c}))" for c in _FULL_TYPES)


@query(
    "missing_audit",
    " UNION ALL ".join(
        f"SELECT exchange, symbol, {_TOTAL} AS missing_total, '{c}' AS column_name, count(*) - count({c}) AS missing "
        f"FROM {_FULL_GOLD} GROUP BY exchange, symbol"
        for c in _FULL_TYPES
    ),
    _FULL_GOLD,
)
def missing_audit(f):
    return profile.missing_audit(full_gold(f), SYMBOL)


@query(
    "span_coverage",
    """SELECT *, greatest(expected_minutes - rows_out, 0) AS missing_minutes,
      round(rows_out / expected_minutes::DOUBLE, 9) AS coverage_ratio
    FROM (SELECT exchange, symbol, min(timestamp_m1) AS min_timestamp, max(timestamp_m1) AS max_timestamp,
      count(*) AS rows_out,
      CAST(floor((epoch_us(max(timestamp_m1)) - epoch_us(min(timestamp_m1))) / 60000000) AS BIGINT) + 1 AS expected_minutes
      FROM g_trades GROUP BY 1, 2)""",
    "g_trades",
)
def span_coverage(f):
    bars = gold.prepare("perp_trades_1m_feature", f.silver("perp_trades_1m_feature"))
    return rounded(profile.span_coverage(bars, SYMBOL, "timestamp_m1"), 9, "coverage_ratio")


@query(
    "source_summary",
    f"""SELECT exchange, 'perp_trades_1m_feature' AS source_dataset,
      '{",".join(SILVER_COLUMNS["trades_1m_feature"])}' AS columns, count(*) AS rows,
      string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS source_symbols FROM t_bars GROUP BY exchange""",
    "t_bars",
)
def source_summary(f):
    return profile.source_summary(f.silver("perp_trades_1m_feature"), "perp_trades_1m_feature", ["exchange"])


@query(
    "profile_stats",
    " UNION ALL ".join(
        f"""SELECT exchange, symbol, '{c}' AS feature, count({c}) AS available, count(*) - count({c}) AS missing,
      round(CASE WHEN count({c}) > 0 THEN (count(*) - count({c})) * 100.0::DOUBLE / count({c}) ELSE 0 END, 9) AS missing_pct,
      round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 9) AS missing_pct_total, {_digits_sql(f'avg({c})')} AS mean,
      {_digits_sql(f'var_samp({c})')} AS var, {_digits_sql(f'stddev_samp({c})')} AS std_1, {_digits_sql(f'2 * stddev_samp({c})')} AS std_2,
      {_digits_sql(f'3 * stddev_samp({c})')} AS std_3, min(CASE WHEN {c} IS NOT NULL THEN timestamp_m1 END) AS first_timestamp
    FROM {_FULL_GOLD} GROUP BY exchange, symbol"""
        for c in _FULL_NUMERIC
    ),
    _FULL_GOLD,
)
def profile_stats(f):
    stats = profile.profile_stats(full_gold(f), SYMBOL, "timestamp_m1")
    return _digits(rounded(stats, 9, "missing_pct", "missing_pct_total"), "mean", "var", "std_1", "std_2", "std_3")


@query(
    "histogram_24",
    " UNION ALL ".join(
        f"""SELECT exchange, symbol, '{c}' AS feature,
      CASE WHEN hi = lo THEN 1 ELSE least(floor((x - lo) / ((hi - lo) / 24)), 23)::BIGINT + 1 END AS bin,
      count(*) AS rows, min(x) AS lowest, max(x) AS highest
    FROM (SELECT exchange, symbol, {c}::DOUBLE AS x, min({c}::DOUBLE) OVER w AS lo, max({c}::DOUBLE) OVER w AS hi
      FROM {_FUNDING_GOLD} WINDOW w AS (PARTITION BY exchange, symbol)) WHERE x IS NOT NULL GROUP BY 1, 2, 3, 4"""
        for c in _NUMERIC
    ),
    _FUNDING_GOLD,
)
def histogram_24(f):
    return profile.histogram(funding_gold(f), SYMBOL, _NUMERIC)


@query(
    "minmax_scale",
    f"""SELECT timestamp_m1, exchange, symbol, {", ".join(_NUMERIC)}, {", ".join(
        f"CASE WHEN {c} IS NULL THEN 'NaN'::DOUBLE WHEN h{i} = l{i} THEN 0 ELSE ({c} - l{i}) / (h{i} - l{i}) END AS {c}_scaled"
        for i, c in enumerate(_NUMERIC)
    )} FROM (SELECT *, {", ".join(f"min({c}) OVER w AS l{i}, max({c}) OVER w AS h{i}" for i, c in enumerate(_NUMERIC))}
      FROM {_FUNDING_GOLD} WINDOW w AS (PARTITION BY exchange, symbol))""",
    _FUNDING_GOLD,
)
def minmax_scale(f):
    joined = funding_gold(f).select("timestamp_m1", *SYMBOL, *_NUMERIC)
    return profile.minmax_scale(joined, SYMBOL, _NUMERIC)


@query(
    "even_sample",
    f"""SELECT timestamp_m1, exchange, symbol, spot_close_price FROM (
      SELECT *, row_number() OVER (PARTITION BY exchange, symbol ORDER BY timestamp_m1) - 1 AS i,
        count(*) OVER (PARTITION BY exchange, symbol) AS n FROM gold_market_core_m1) g
    WHERE n <= {PROFILE_SAMPLE_ROWS} OR i IN (SELECT round_even(j * ((g.n - 1) / {PROFILE_SAMPLE_ROWS - 1}.0::DOUBLE), 0)::BIGINT
      FROM range({PROFILE_SAMPLE_ROWS}) r(j))""",
    "gold_market_core_m1",
)
def even_sample(f):
    joined = frame(f, "gold.market.core.m1").select("timestamp_m1", *SYMBOL, "spot_close_price")
    return lagging.even_sample(joined, SYMBOL, "timestamp_m1", PROFILE_SAMPLE_ROWS)


# ---- manifest -------------------------------------------------------------------------------------

_BUILT = "2024-02-01 00:00:00"
_SPOT_COLUMNS = SILVER_COLUMNS["ohlcv"]
_CORE_COLUMNS = _GOLD_COLUMNS[:13]


def _sql_list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


_FACTS = ", ".join(
    f"""'{source_key(n)}': {{'columns': {_sql_list(_SPOT_COLUMNS)}, 'rows': (SELECT count(*) FROM {n}_s WHERE split_part(replace(symbol, '_', '-'), '-', 1) = g.symbol),
      'source_symbols': (SELECT list_sort(list(DISTINCT symbol)) FROM {n}_s WHERE split_part(replace(symbol, '_', '-'), '-', 1) = g.symbol)}}"""
    for n in ("perp", "spot")
)
_SIGNATURE = (
    f"{{'columns': {_sql_list(_CORE_COLUMNS)}, 'join_policy': 'minute_grid_left_join_coalesce', "
    "'source_dataset_keys': ['perp_1m', 'spot_1m']}"
)


@query(
    "manifest_gold",
    f"""SELECT *, feature_set_hash || '_' || source_data_hash AS hash_string,
      feature_set_hash || '_' || source_data_hash || '_abcdef12' AS build_id,
      greatest(expected_minutes_in_span - rows_out, 0) AS missing_minutes_in_span,
      round(rows_out / expected_minutes_in_span::DOUBLE, 9) AS observed_row_coverage_ratio
    FROM (SELECT 'gold.market.core.m1' AS dataset_id, exchange, symbol,
      substring(sha256('{"|".join(_CORE_COLUMNS)}'), 1, 12) AS column_hash,
      substring(sha256(to_json({{'contract_signature': {_SIGNATURE}, 'dataset_id': 'gold.market.core.m1'}})::VARCHAR), 1, 12) AS feature_set_hash,
      substring(sha256(to_json({{'source_silver_datasets': {{{_FACTS}}}}})::VARCHAR), 1, 12) AS source_data_hash,
      count(*) AS rows_out, strftime(min(timestamp_m1), '%Y-%m-%dT%H:%M:%SZ') AS min_timestamp,
      strftime(max(timestamp_m1), '%Y-%m-%dT%H:%M:%SZ') AS max_timestamp,
      CAST(floor((epoch_us(max(timestamp_m1)) - epoch_us(min(timestamp_m1))) / 60000000) AS BIGINT) + 1 AS expected_minutes_in_span,
      {" + ".join(f"(count(*) - count({c}))" for c in _CORE_COLUMNS)} AS missing_value_count_total,
      to_json({{{", ".join(f"'{c}': count(*) - count({c})" for c in _CORE_COLUMNS)}}})::VARCHAR AS missing_value_count_by_column,
      to_json({{{_FACTS}}})::VARCHAR AS source_silver_datasets, to_json({_SIGNATURE})::VARCHAR AS contract,
      TIMESTAMP '{_BUILT}' AS built_at, '{_BUILT.replace(" ", "T")}Z' AS build_date_utc, 'abcdef1234567890' AS git_commit_hash
      FROM gold_market_core_m1 g GROUP BY exchange, symbol)""",
    "gold_market_core_m1", "spot_s", "perp_s",
)
def manifest_gold(f):
    raw = {n: f.silver(n) for n in ("spot", "perp")}
    merged = gold.gold_frame(raw, "gold.market.core.m1")
    rows = gold.gold_manifest(merged, raw, "gold.market.core.m1", _BUILT, "abcdef1234567890")
    rows = rows.withColumn("contract", F.to_json(F.struct("contract.columns", "contract.join_policy", "contract.source_dataset_keys")))
    return rounded(rows, 9, "observed_row_coverage_ratio").select(
        "missing_value_count_by_column", "source_silver_datasets", "contract", "built_at", "build_date_utc", "git_commit_hash", "dataset_id", "exchange", "symbol", "column_hash", "feature_set_hash", "source_data_hash", "hash_string", "build_id",
        "rows_out", "min_timestamp", "max_timestamp", "expected_minutes_in_span", "missing_minutes_in_span",
        "observed_row_coverage_ratio", "missing_value_count_total",
    )


@query(
    "with_minute_column",
    """SELECT date_trunc('minute', ts) AS timestamp_m1, asset AS symbol, count(*) AS rows FROM ev GROUP BY 1, 2""",
    "ev",
)
def with_minute_column(f):
    from tidelake.operators.grid import with_minute_column as named

    rows = named(f.events().select(F.col("asset").alias("symbol"), trunc_minute(F.col("ts")).alias("open_time")))
    return rows.groupBy("timestamp_m1", "symbol").agg(F.count(F.lit(1)).alias("rows"))


@query("funding_abs", "SELECT symbol, funding_time, abs(funding_rate) AS funding_abs FROM f_obs", "f_obs")
def funding_abs(f):
    observed = silver.funding_observed(f.funding(), _BUILT)
    return observed.select("symbol", "funding_time", F.abs("funding_rate").alias("funding_abs"))
