"""Landed exchange payloads (JSON pages) to typed rows.

A page frame has ``page_no`` (delivery order), ``symbol`` (storage name) and ``payload`` (the response text). Rows
carry ``page_no`` and ``pos`` so that :func:`page_dedup` can keep the last delivery of overlapping pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.symbols import float_or_default, is_maker, option_fields, strip_quote_symbol, trade_side
from tidelake.functions.times import ms_to_ts
from tidelake.operators.dedup import keep_latest

CANDLE_ARRAYS = ["ticks", "open", "high", "low", "close", "volume"]


def _fail(text: str, kind: str) -> Column:
    return F.raise_error(F.lit(text)).cast(kind)


def _items(found: Column, payload: Column, what: str, kind: str) -> Column:
    """The list of a page, or an error that shows the page's beginning when there is none."""
    shown = F.concat(F.lit(f"page without {what}: "), F.coalesce(F.substring(payload, 1, 200), F.lit("null")))
    return F.when(found.isNull(), F.raise_error(shown).cast(kind)).otherwise(found)


def _number(text: Column, what: str, kind: str = "double") -> Column:
    """Numbers, also written as text; text that is none is an error, null stays null."""
    value = text.try_cast(kind)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit(f"{what} is no number: "), text)).cast(kind)).otherwise(value)


def normalize_klines(pages: DataFrame, interval_ms: int, exchange: str, timeframe: str = "1m") -> DataFrame:
    """Chart pages (parallel arrays) to candles.

    ``no_data`` pages are empty; any other status than ``ok`` and arrays that are missing or of unequal length fail.
    """
    shape = "struct<result: struct<status: string, " + ", ".join(f"{a}: array<string>" for a in CANDLE_ARRAYS) + ">>"
    # inline makes columns of the one parsed struct; fields taken from from_json directly would each parse the text
    result = F.from_json("payload", shape).getField("result")
    parsed = pages.select("page_no", "symbol", F.inline(F.array(result)))
    arrays = [F.col(a) for a in CANDLE_ARRAYS]
    zipped = F.arrays_zip(*[a.alias(n) for a, n in zip(arrays, CANDLE_ARRAYS)])
    kind = "array<struct<" + ", ".join(f"{a}: string" for a in CANDLE_ARRAYS) + ">>"
    missing = F.lit(False)
    uneven = F.lit(False)
    for a in arrays:
        missing = missing | a.isNull()
        uneven = uneven | (F.size(a) != F.size(arrays[0]))
    status = F.col("status")
    rows = (
        F.when(status == "no_data", F.array().cast(kind))
        .when(status.isNotNull() & (status != "ok"), _fail("unexpected chart status", kind))
        .when(missing, _fail("chart arrays missing", kind))
        .when(uneven, _fail("chart arrays differ in length", kind))
        .otherwise(zipped)
    )
    tick = F.col("c.ticks").cast("bigint")
    return parsed.select("page_no", "symbol", F.posexplode(rows).alias("pos", "c")).select(
        "page_no",
        "pos",
        F.lit(exchange).alias("exchange"),
        "symbol",
        F.lit(timeframe).alias("timeframe"),
        ms_to_ts(tick).alias("open_time"),
        ms_to_ts(tick + (interval_ms - 1)).alias("close_time"),
        *[F.col(f"c.{n}").cast("double").alias(f"{n}_price") for n in ("open", "high", "low", "close")],
        F.col("c.volume").cast("double").alias("volume"),
        F.lit(None).cast("double").alias("quote_volume"),
        F.lit(0).cast("bigint").alias("trade_count"),
    )


def normalize_funding(pages: DataFrame, exchange: str, timeframe: str = "8h") -> DataFrame:
    """Funding pages to rows; items without a timestamp are dropped.

    The 8-hour rate counts whenever its key is present, even with a null (then 0.0); only without the key does the
    1-hour rate count. The mark price falls back to the index price.
    """
    page = F.from_json("payload", "struct<result: array<string>>")
    whole = F.json_object_keys("payload").isNotNull()
    # An object whose result is missing or no list is an empty page; text that is no object is an error.
    items = _items(F.when(whole, F.coalesce(page.getField("result"), F.array().cast("array<string>"))), F.col("payload"), "an object", "array<string>")
    fields = ["timestamp", "interest_8h", "interest_1h", "index_price", "prev_index_price"]
    rate = F.when(F.array_contains(F.json_object_keys("item"), "interest_8h"), F.col("interest_8h")).otherwise(
        F.col("interest_1h")
    )
    index = float_or_default(F.col("index_price"), 0.0)
    moment = ms_to_ts(F.col("timestamp").cast("bigint"))
    return (
        pages.select("page_no", "symbol", F.posexplode(items).alias("pos", "item"))
        .select("*", F.json_tuple("item", *fields).alias(*fields))
        .where("timestamp is not null")
        .select(
            "page_no",
            "pos",
            F.lit(exchange).alias("exchange"),
            F.lit("perp").alias("instrument_type"),
            "symbol",
            F.lit(timeframe).alias("timeframe"),
            moment.alias("open_time"),
            moment.alias("close_time"),
            float_or_default(rate, 0.0).alias("funding_rate"),
            index.alias("index_price"),
            float_or_default(F.col("prev_index_price"), index).alias("mark_price"),
        )
    )


def normalize_oi(pages: DataFrame, exchange: str, timeframe: str = "1m") -> DataFrame:
    """Settlement pages to open-interest rows; items without timestamp or position are dropped."""
    shape = "struct<result: struct<settlements: array<struct<timestamp: string, position: string>>>>"
    kind = "array<struct<timestamp: string, position: string>>"
    items = _items(F.from_json("payload", shape).getField("result").getField("settlements"), F.col("payload"), "settlements", kind)
    moment = ms_to_ts(F.col("s.timestamp").cast("bigint"))
    return (
        pages.select("page_no", "symbol", F.posexplode(items).alias("pos", "s"))
        .where("s.timestamp is not null and s.position is not null")
        .select(
            "page_no",
            "pos",
            F.lit(exchange).alias("exchange"),
            F.lit("perp").alias("instrument_type"),
            "symbol",
            F.lit(timeframe).alias("timeframe"),
            moment.alias("open_time"),
            moment.alias("close_time"),
            _number(F.col("s.position"), "position").alias("open_interest"),
            F.lit(0.0).alias("open_interest_value"),
        )
    )


_TRADE_FIELDS = ["timestamp", "trade_id", "price", "amount", "direction", "liquidation", "instrument_name"]


def _trades(pages: DataFrame, exchange: str, instrument_type: str, symbol: Column) -> DataFrame:
    """Ticks; fields are read as text and cast strictly, and only a missing key takes a default, not a null."""
    found = F.from_json("payload", "struct<result: struct<trades: array<string>>>").getField("result").getField("trades")
    items = _items(found, F.col("payload"), "trades", "array<string>")
    listed = pages.select("page_no", symbol.alias("symbol"), F.posexplode(items).alias("pos", "item"))
    fields = F.struct(*[F.get_json_object("item", f"$.{n}").alias(n) for n in _TRADE_FIELDS])
    rows = listed.select("page_no", "symbol", "pos", fields.alias("t"), F.json_object_keys("item").alias("keys"))

    def required(name: str, kind: str, default: str) -> Column:
        """A number; its default only where the key is absent."""
        value, there = F.col(f"t.{name}"), F.array_contains("keys", name)
        null = F.raise_error(F.lit(f"trade with a null {name}")).cast("string")
        return _number(F.when(~there, F.lit(default)).when(value.isNull(), null).otherwise(value), name, kind)

    moment = ms_to_ts(required("timestamp", "bigint", "0"))
    return rows.select(
        "page_no",
        "pos",
        F.lit(exchange).alias("exchange"),
        F.lit(instrument_type).alias("instrument_type"),
        "symbol",
        F.lit("tick").alias("timeframe"),
        moment.alias("open_time"),
        moment.alias("close_time"),
        F.coalesce("t.trade_id", F.lit("")).alias("trade_id"),
        required("price", "double", "0.0").alias("price"),
        required("amount", "double", "0.0").alias("quantity"),
        trade_side(F.col("t.direction")).alias("side"),
        is_maker(F.col("t.liquidation")).alias("is_maker"),
        F.coalesce("t.instrument_name", F.lit("")).alias("instrument_name"),
    )


def normalize_trades(pages: DataFrame, exchange: str, market: str = "perp") -> DataFrame:
    """Trade pages to ticks."""
    return _trades(pages, exchange, market, F.col("symbol")).drop("instrument_name")


def normalize_option_trades(pages: DataFrame, exchange: str) -> DataFrame:
    """Option trade pages to ticks of the underlying, with the contract's expiry, strike and type."""
    rows = _trades(pages, exchange, "option", strip_quote_symbol(F.col("symbol")))
    return rows.withColumn("_o", option_fields(F.col("instrument_name"))).select(*rows.columns, "_o.*")


def page_dedup(rows: DataFrame, key: list[str], start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """Rows within ``[start_ms, end_ms]``, the last delivery of each key."""
    inside = rows
    if start_ms is not None:
        inside = inside.where(F.col("open_time") >= ms_to_ts(F.lit(start_ms)))
    if end_ms is not None:
        inside = inside.where(F.col("open_time") <= ms_to_ts(F.lit(end_ms)))
    return keep_latest(inside, key, ["page_no", "pos"]).drop("page_no", "pos")


# Keys of :func:`page_dedup` per dataset kind.
PAGE_KEYS = {
    "candles": ["symbol", "open_time"],
    "funding": ["symbol", "open_time"],
    "oi": ["symbol", "open_time"],
    "perp_trades": ["symbol", "open_time", "trade_id"],
    "option_trades": ["symbol", "open_time", "trade_id", "instrument_name"],
}
