"""Contracts, drift and version history over hourly builds derived from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.catalog import sql as S
from tidelake.catalog.base import EXCHANGE, query
from tidelake.functions.hashing import canonical_json, columns_hash, hash12
from tidelake.operators import governance
from tidelake.operators.dedup import keep_latest
from tidelake.schemas import JOIN_POLICY, JOIN_POLICY_OLD

DATASET = "gold.market.full.m1"

# A build per symbol and hour: its columns are the kinds of events seen (in falling order after an odd start), its
# sources depend on the spread of k, and hours with small k only still have the old join policy.
S.CTES["history"] = (
    ["ev"],
    f"""SELECT '{DATASET}' AS dataset_id, 'deribit' AS exchange, asset AS symbol, date_trunc('hour', ts) AS built_at,
      CASE WHEN min(k) < 5 THEN list_sort(list(DISTINCT event_type), 'DESC') ELSE list_sort(list(DISTINCT event_type)) END AS columns,
      CASE WHEN max(k) < 20 THEN '{JOIN_POLICY_OLD}' ELSE '{JOIN_POLICY}' END AS join_policy,
      list_sort(list(DISTINCT CASE WHEN k < 33 THEN 'spot_1m' WHEN k < 66 THEN 'perp_1m' ELSE 'oi_1m_feature' END)) AS keys,
      substring(sha256(count(*)::VARCHAR), 1, 12) AS source_data_hash FROM ev GROUP BY ALL""",
)


def history(f):
    kinds = F.collect_set("event_type")
    source = F.when(F.col("k") < 33, "spot_1m").when(F.col("k") < 66, "perp_1m").otherwise("oi_1m_feature")
    builds = (
        f.events()
        .groupBy(F.col("asset").alias("symbol"), F.date_trunc("hour", "ts").alias("built_at"))
        .agg(
            F.sort_array(kinds, False).alias("falling"),
            F.sort_array(kinds).alias("rising"),
            F.min("k").alias("lo"),
            F.max("k").alias("hi"),
            F.collect_set(source).alias("keys"),
            hash12(F.count(F.lit(1)).cast("string")).alias("source_data_hash"),
        )
    )
    columns = F.when(F.col("lo") < 5, F.col("falling")).otherwise(F.col("rising"))
    policy = F.when(F.col("hi") < 20, JOIN_POLICY_OLD).otherwise(JOIN_POLICY)
    return builds.select(
        F.lit(DATASET).alias("dataset_id"),
        F.lit(EXCHANGE).alias("exchange"),
        "symbol",
        "built_at",
        governance.contract(columns, F.col("keys"), policy).alias("contract"),
        "source_data_hash",
    )


_JSON = "to_json({'contract_signature': {'columns': columns, 'join_policy': join_policy, 'source_dataset_keys': keys}, 'dataset_id': dataset_id})::VARCHAR"


@query(
    "contract_signature",
    f"""SELECT symbol, built_at, {_JSON} AS payload, substring(sha256({_JSON}), 1, 12) AS feature_set_hash,
      substring(sha256({_JSON}), 1, 12) || '_' || source_data_hash || '_nogit' AS build_id FROM history""",
    "history",
)
def contract_signature(f):
    signature = governance.feature_set_hash(F.col("contract"), F.col("dataset_id"))
    return history(f).select(
        "symbol",
        "built_at",
        canonical_json(F.struct(F.col("contract").alias("contract_signature"), "dataset_id")).alias("payload"),
        signature.alias("feature_set_hash"),
        governance.build_id(signature, F.col("source_data_hash"), "nogit").alias("build_id"),
    )


@query(
    "hash12",
    """SELECT symbol, built_at, substring(sha256(array_to_string(columns, '|')), 1, 12) AS column_hash FROM history""",
    "history",
)
def hash12_query(f):
    return history(f).select("symbol", "built_at", columns_hash(F.col("contract.columns")).alias("column_hash"))


S.CTES["steps"] = (
    ["history"],
    """SELECT *, lag(columns) OVER w AS c0, lag(join_policy) OVER w AS p0, lag(keys) OVER w AS k0,
      lag(source_data_hash) OVER w AS h0, row_number() OVER w AS nth
    FROM history WINDOW w AS (PARTITION BY dataset_id, exchange, symbol ORDER BY built_at)""",
)
S.CTES["drifts"] = (
    ["steps"],
    """SELECT *, split_part(step, ':', 1) AS level, split_part(step, ':', 2) AS reason FROM (SELECT *, CASE
      WHEN nth = 1 THEN 'initial:no_previous_manifest'
      WHEN p0 <> join_policy THEN 'major:join_policy_changed'
      WHEN NOT list_has_all(keys, k0) THEN 'major:source_dataset_removed'
      WHEN NOT list_has_all(k0, keys) THEN 'minor:source_dataset_added'
      WHEN NOT list_has_all(columns, c0) THEN 'major:column_removed_or_renamed'
      WHEN NOT list_has_all(c0, columns) THEN 'minor:column_added'
      WHEN c0 <> columns THEN 'major:column_order_changed'
      WHEN h0 <> source_data_hash THEN 'patch:source_data_changed' ELSE 'none:no_change' END AS step FROM steps)""",
)


@query("contract_drift", "SELECT symbol, built_at, level, reason FROM drifts", "drifts")
def contract_drift(f):
    return governance.contract_drift(history(f)).select("symbol", "built_at", "level", "reason")


@query(
    "semver_timeline",
    """SELECT symbol, built_at, level, 'v' || (2 + majors) || '.' || (minors + CASE WHEN majors = 0 THEN 3 ELSE 0 END) || '.' ||
      (count(*) FILTER (WHERE level = 'patch') OVER (PARTITION BY symbol, majors, minors ORDER BY built_at)
        + CASE WHEN majors = 0 AND minors = 0 THEN 4 ELSE 0 END) AS dataset_version
    FROM (SELECT *, count(*) FILTER (WHERE level = 'minor') OVER (PARTITION BY symbol, majors ORDER BY built_at) AS minors
      FROM (SELECT *, count(*) FILTER (WHERE level = 'major') OVER (PARTITION BY symbol ORDER BY built_at) AS majors FROM drifts))""",
    "drifts",
)
def semver_timeline(f):
    timeline = governance.semver_timeline(governance.contract_drift(history(f)), "v2.3.4")
    return timeline.select("symbol", "built_at", "level", "dataset_version")


@query(
    "latest_per_key",
    """SELECT symbol, built_at, source_data_hash FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY built_at DESC) AS rn FROM history)
    WHERE rn = 1""",
    "history",
)
def latest_per_key(f):
    newest = keep_latest(history(f), ["dataset_id", "exchange", "symbol"], ["built_at"])
    return newest.select("symbol", "built_at", "source_data_hash")
