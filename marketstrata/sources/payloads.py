"""Landed market payloads: JSON files or JSON text columns, read with a contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstrata.contracts import CHART, NARROW, PAYLOAD, SPARKLINE
from marketstrata.operators.conform import fit_contract, stamp_batch

# Sort keys a market page may be asked for.
ORDER_KEYS = {
    "market_cap": "market_cap",
    "volume": "total_volume",
    "id": "id",
    "price": "current_price",
}

# Epoch milliseconds of the years 1 to 9999.
EPOCH_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)

REJECTED = "_rejected"


def scan_market_payload(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = PAYLOAD,
    multi_line: bool = True,
    keep_rejected: bool = False,
) -> DataFrame:
    """One row per coin from landed files holding an object or a list of objects each.

    With ``multi_line=False`` every line is such a document, which lets Spark split big files.
    ``keep_rejected`` adds the text of unreadable documents as ``_rejected``.
    """
    if keep_rejected:
        schema = T.StructType(schema.fields + [T.StructField(REJECTED, T.StringType(), True)])
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", REJECTED).json(path)


def decode_market_payload(df: DataFrame, text: str, schema: T.StructType = PAYLOAD) -> DataFrame:
    """One row per coin from a column of JSON text, a list of coins or a single one.

    Text that is not JSON gives no rows here; ``rejected_payloads`` returns it.
    """
    return df.select(F.inline(_decoded(text, schema)))


def scan_raw_market(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Landed files as ``raw_market`` rows; with ``multi_line=False`` every line is a document, so big files are split."""
    return raw_market(spark.read.text(path, wholetext=multi_line), "value")


def raw_market(df: DataFrame, text: str) -> DataFrame:
    """One row per coin from a column of JSON text, every payload column as the text it came as.

    The document is held as VARIANT, which keeps each value as it was written, so the rules can judge it before it is
    typed: a number in quotes, a fraction in a rank, an amount no double or decimal holds. Objects and lists give
    their JSON. An element that is no object gives a row of NULLs, which the rules report; text that is not JSON gives
    no row, ``rejected_payloads`` returns it.
    """
    body = F.try_parse_json(text)
    listed = F.schema_of_variant(body).startswith("ARRAY")
    coins = F.when(listed, F.try_variant_get(body, "$", "array<variant>")).when(body.isNotNull(), F.array(body))
    held = df.select(F.explode(coins).alias("_coin"))
    return held.select(*[F.try_variant_get("_coin", f"$.{name}", "string").alias(name) for name in PAYLOAD.fieldNames()])


def rejected_payloads(df: DataFrame, text: str, schema: T.StructType = PAYLOAD) -> DataFrame:
    """The rows of ``df`` whose text cannot be decoded."""
    return df.filter(_decoded(text, schema).isNull())


def _decoded(text: str, schema: T.StructType) -> Column:
    body = F.ltrim(F.col(text))
    listed = F.when(body.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    return F.from_json(listed, T.ArrayType(schema))


def require_rows(df: DataFrame) -> DataFrame:
    """Raise ``ValueError`` when there is nothing to process; looks for one row only."""
    if df.isEmpty():
        raise ValueError("the payload holds no rows")
    return df


def market_page(
    df: DataFrame,
    ids: list[str] | None = None,
    order: str = "market_cap_desc",
    per_page: int = 100,
    page: int = 1,
    category: str | None = None,
    vs_currency: str | None = None,
    sparkline: bool = True,
    price_change_percentage: str | None = None,
) -> DataFrame:
    """One page of a market snapshot: filter, order (ties by id), cut.

    ``category`` and ``vs_currency`` filter columns of that name where the data has them.
    ``price_change_percentage`` lists the periods, such as ``"24h,7d"``, whose in-currency
    changes are kept; the others are dropped.
    """
    key, _, direction = order.rpartition("_")
    if key not in ORDER_KEYS or direction not in ("asc", "desc"):
        raise ValueError(f"unknown order {order!r}")
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page start at 1")
    if ids:
        df = df.filter(F.col("id").isin(ids))
    for column, wanted in (("category", category), ("vs_currency", vs_currency)):
        if wanted is not None and column in df.columns:
            df = df.filter(F.col(column) == wanted)
    if not sparkline:
        df = df.drop("sparkline_in_7d")
    if price_change_percentage is not None:
        kept = {f"price_change_percentage_{p.strip()}_in_currency" for p in price_change_percentage.split(",")}
        periods = [c for c in df.columns if c.startswith("price_change_") and c.endswith("_in_currency")]
        df = df.drop(*[c for c in periods if c not in kept])
    value = F.col(ORDER_KEYS[key])
    sort = value.desc_nulls_last() if direction == "desc" else value.asc_nulls_last()
    return df.orderBy(sort, F.col("id").asc_nulls_last()).offset((page - 1) * per_page).limit(per_page)


def project_narrow_snapshot(
    df: DataFrame,
    now: dt.datetime | Column | None = None,
    run_id: str | Column | None = None,
    fill_text: bool = False,
) -> DataFrame:
    """Eight payload fields plus batch metadata.

    ``fill_text`` upper-cases the symbol and turns NULL text into ``''``.
    """
    if fill_text:
        df = df.withColumns(
            {
                "symbol": F.upper(F.coalesce(F.col("symbol"), F.lit(""))),
                "name": F.coalesce(F.col("name"), F.lit("")),
                "last_updated": F.coalesce(F.col("last_updated"), F.lit("")),
            }
        )
    return fit_contract(stamp_batch(df, now, run_id), NARROW)


def decode_chart(df: DataFrame, text: str, coin: str = "coin_id") -> DataFrame:
    """A column of market-chart JSON text as ``coin_id, prices, market_caps, total_volumes``.

    ``inline`` keeps the parsed text in one place; a plain projection would be merged into later
    filters and parse it again for every series they look at.
    """
    body = T.StructType([f for f in CHART.fields if f.name != "coin_id"])
    return df.select(F.col(coin).alias("coin_id"), F.inline(F.array(F.from_json(text, body))))


def same_grid() -> Column:
    """True where the three series of a chart carry the same valid times in the same order."""
    times = [f"transform({series}, p -> get(p, 0))" for series in ("prices", "market_caps", "total_volumes")]
    first, last = (str(limit) for limit in EPOCH_MILLIS)
    valid = f"forall({times[0]}, t -> t between {first} and {last})"
    return F.expr(f"coalesce({times[0]} = {times[1]} and {times[0]} = {times[2]} and {valid}, false)")


def split_charts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(charts with one time grid, rejects)``."""
    return df.filter(same_grid()), df.filter(~same_grid())


def explode_market_chart(
    df: DataFrame,
    days: int | str | None = None,
    interval: str | None = None,
    as_of: dt.datetime | Column | None = None,
) -> DataFrame:
    """Charts to ``coin_id, ts, price, market_cap, total_volume``, one row per time.

    ``days`` keeps the times after ``as_of - days``, all of them for ``"max"``;
    ``interval="daily"`` keeps the last point of each day.
    """
    good, _ = split_charts(df)
    points = good.select("coin_id", F.inline(F.arrays_zip("prices", "market_caps", "total_volumes"))).selectExpr(
        "coin_id",
        "timestamp_millis(cast(get(prices, 0) as bigint)) as ts",
        "get(prices, 1) as price",
        "get(market_caps, 1) as market_cap",
        "get(total_volumes, 1) as total_volume",
    )
    if days is not None and days != "max":
        if as_of is None:
            raise ValueError("days needs as_of")
        moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
        points = points.filter(F.col("ts") > moment - F.make_dt_interval(F.lit(int(days))))
    if interval is None:
        return points
    if interval != "daily":
        raise ValueError(f"unknown interval {interval!r}")
    last = F.max(F.struct("ts", "price", "market_cap", "total_volume")).alias("p")
    daily = points.groupBy("coin_id", F.date_trunc("day", "ts").alias("day")).agg(last)
    return daily.select("coin_id", F.col("day").alias("ts"), "p.price", "p.market_cap", "p.total_volume")


def explode_sparkline(df: DataFrame) -> DataFrame:
    """``id, position, price`` from the price array of each coin."""
    return df.select("id", F.posexplode("sparkline_in_7d.price").alias("position", "price"))


def decode_sparkline(df: DataFrame, text: str) -> DataFrame:
    return decode_market_payload(df, text, SPARKLINE)
