"""Dataset contracts, contract drift and version history."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.hashing import json_hash
from tidelake.operators.dedup import keep_latest
from tidelake.schemas import JOIN_POLICY

ARTIFACT = ["dataset_id", "exchange", "symbol"]
SEMVER = r"v(\d+)\.(\d+)\.(\d+)"


def contract(columns: Column, source_keys: Column, join_policy: Column | None = None) -> Column:
    """Contract struct: column list, join policy and sorted source names."""
    policy = F.lit(JOIN_POLICY) if join_policy is None else join_policy
    return F.struct(
        columns.alias("columns"), policy.alias("join_policy"), F.array_sort(source_keys).alias("source_dataset_keys")
    )


def feature_set_hash(signature: Column, dataset_id: Column) -> Column:
    return json_hash(F.struct(signature.alias("contract_signature"), dataset_id.alias("dataset_id")))


def build_id(feature_hash: Column, data_hash: Column, code_version: str) -> Column:
    """``<feature hash>_<data hash>_<first 8 characters of the caller's code version>``."""
    return F.concat_ws("_", feature_hash, data_hash, F.lit(code_version[:8]))


def drift(previous: Column, current: Column, previous_hash: Column, current_hash: Column) -> Column:
    """How far ``current`` departs from ``previous``: a struct (level, reason); the first rule that applies counts."""
    was, now = previous.getField, current.getField
    lost = F.size(F.array_except(was("source_dataset_keys"), now("source_dataset_keys"))) > 0
    gained = F.size(F.array_except(now("source_dataset_keys"), was("source_dataset_keys"))) > 0
    columns_lost = F.size(F.array_except(was("columns"), now("columns"))) > 0
    columns_gained = F.size(F.array_except(now("columns"), was("columns"))) > 0
    rules = [
        (was("columns").isNull() | now("columns").isNull(), "major", "invalid_contract_signature"),
        (~was("join_policy").eqNullSafe(now("join_policy")), "major", "join_policy_changed"),
        (
            was("source_dataset_keys").isNull() | now("source_dataset_keys").isNull(),
            "major",
            "invalid_source_dataset_keys",
        ),
        (lost, "major", "source_dataset_removed"),
        (gained, "minor", "source_dataset_added"),
        (columns_lost, "major", "column_removed_or_renamed"),
        (columns_gained, "minor", "column_added"),
        (was("columns") != now("columns"), "major", "column_order_changed"),
        (~previous_hash.eqNullSafe(current_hash), "patch", "source_data_changed"),
    ]
    out = F.struct(F.lit("none").alias("level"), F.lit("no_change").alias("reason"))
    for rule, level, reason in reversed(rules):
        verdict = F.struct(F.lit(level).alias("level"), F.lit(reason).alias("reason"))
        out = F.when(rule, verdict).otherwise(out)
    return out


def contract_drift(history: DataFrame) -> DataFrame:
    """Add ``level`` and ``reason`` against the build before, per artifact; the first build is ``initial``.

    ``history`` has the artifact columns, ``built_at``, ``contract`` and ``source_data_hash``, one row per build.
    """
    builds = Window.partitionBy(*ARTIFACT).orderBy("built_at")
    step = drift(F.col("_was"), F.col("contract"), F.col("_was_hash"), F.col("source_data_hash"))
    first = F.struct(F.lit("initial").alias("level"), F.lit("no_previous_manifest").alias("reason"))
    return (
        history.withColumns(
            {
                "_was": F.lag("contract").over(builds),
                "_was_hash": F.lag("source_data_hash").over(builds),
                "_nth": F.row_number().over(builds),
            }
        )
        .withColumn("_step", F.when(F.col("_nth") == 1, first).otherwise(step))
        .select(*history.columns, "_step.level", "_step.reason")
    )


def parse_version(text: str) -> tuple[int, int, int]:
    found = re.fullmatch(SEMVER, text)
    if not found:
        raise ValueError(f"not a version like v1.0.0: {text!r}")
    major, minor, patch = map(int, found.groups())
    return major, minor, patch


def version_text(major: Column, minor: Column, patch: Column) -> Column:
    return F.concat(F.lit("v"), major.cast("string"), F.lit("."), minor.cast("string"), F.lit("."), patch.cast("string"))


def bump_version(version: Column, level: Column) -> Column:
    """The version after one step of the given level; malformed versions and unknown levels raise."""
    n = [F.regexp_extract(version, f"^{SEMVER}$", i).try_cast("bigint") for i in (1, 2, 3)]
    zero = F.lit(0)
    wrong = F.raise_error(F.concat(F.lit("cannot bump "), version, F.lit(" by "), level)).cast("string")
    return (
        F.when(~version.rlike(f"^{SEMVER}$"), wrong)
        .when(level == "major", version_text(n[0] + 1, zero, zero))
        .when(level == "minor", version_text(n[0], n[1] + 1, zero))
        .when(level == "patch", version_text(n[0], n[1], n[2] + 1))
        .when(level.isin("none", "initial"), version)
        .otherwise(wrong)
    )


def semver_timeline(drifts: DataFrame, base: str = "v1.0.0") -> DataFrame:
    """``dataset_version`` of every build: running counts of each level since the last higher one."""
    major, minor, patch = parse_version(base)
    builds = Window.partitionBy(*ARTIFACT).orderBy("built_at")
    upto = (Window.unboundedPreceding, Window.currentRow)

    def seen(level: str) -> Column:
        return F.count_if(F.col("level") == level)

    return (
        drifts.withColumn("_major", seen("major").over(builds.rowsBetween(*upto)))
        .withColumn(
            "_minor", seen("minor").over(Window.partitionBy(*ARTIFACT, "_major").orderBy("built_at").rowsBetween(*upto))
        )
        .withColumn(
            "_patch",
            seen("patch").over(
                Window.partitionBy(*ARTIFACT, "_major", "_minor").orderBy("built_at").rowsBetween(*upto)
            ),
        )
        .withColumn(
            "dataset_version",
            version_text(
                F.col("_major") + major,
                F.col("_minor") + F.when(F.col("_major") == 0, F.lit(minor)).otherwise(F.lit(0)),
                F.col("_patch")
                + F.when((F.col("_major") == 0) & (F.col("_minor") == 0), F.lit(patch)).otherwise(F.lit(0)),
            ),
        )
        .drop("_major", "_minor", "_patch")
    )


def latest_manifest(manifests: DataFrame, time: str = "built_at") -> DataFrame:
    """Newest manifest row per artifact."""
    return keep_latest(manifests, ARTIFACT, [time])
