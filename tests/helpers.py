"""Small bronze rows for the layer tests."""

from __future__ import annotations

from conftest import ts
from tidelake.operators.dedup import pad_columns
from tidelake.schemas import BRONZE_SCHEMAS


def bronze(spark, dataset: str, rows: list[dict], **shared):
    """Bronze rows from dicts; times are ISO text, missing columns null."""
    instrument = {"spot": "spot", "option_trades": "option"}.get(dataset, "perp")
    base = {
        "schema_version": "v1", "dataset_type": dataset, "exchange": "deribit", "instrument_type": instrument,
        "timeframe": "1m", "run_id": "r1", "source_endpoint": "x", **shared,
    }
    names = {f.name: f.dataType.simpleString() for f in BRONZE_SCHEMAS[dataset]}
    whole = [{**base, **r} for r in rows]
    for r in whole:
        for c in ("open_time", "close_time", "ingested_at", "event_time"):
            if isinstance(r.get(c), str):
                r[c] = ts(r[c])
    used = list(dict.fromkeys(c for r in whole for c in r))
    schema = ", ".join(f"{c} {names[c]}" for c in used)
    frame = spark.createDataFrame([tuple(r.get(c) for c in used) for r in whole], schema)
    return pad_columns(frame, names)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
