"""Inner join of quotes with validity windows: same asset, ``start <= date <= end``.

The windows are measured first, by one aggregate: how many bytes, from which day
to which, and how many windows an asset has at most.  Quotes outside that range
of days are filtered before anything is shuffled.

* Assets with few windows are joined on the asset, with the range as residual.
* With many windows an asset, that compares too many pairs, so time takes part
  in the key.  A window gets the smallest span 8^k that holds it and is filed
  under the one or two slots of that span which it touches; a quote looks up one
  slot for each span that windows of its asset have.  A window sits once in the
  slot of any day, so no pair is met twice.  A slot is up to eight times as long
  as its windows, and so may be the pairs looked at against those that match.

Below a byte limit the windows are broadcast and the quotes are not shuffled.
Beyond it both sides are shuffled on the key, after a semi-join of the quotes
with the assets where these can be broadcast.  A key with more rows than a task
should take is laid out over a grid of quote parts and window parts in which
every pair meets once.  Which keys those are only decides where rows go, so they
are found in a sample large enough to show them; they are kept as a table, any
number of them, split into any number of parts.  A row's part goes by its number
in the input, taken before the first shuffle here: a task that is run again after
a lost executor may get the rows of a shuffle in another order, but not with
other numbers.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.dates import day_or_error, day_or_null, with_quote_day
from tickerloom.functions.text import quoted
from tickerloom.operators.equities import require_columns
from tickerloom.scratch import saved

# Windows up to this size, counted generously on their filed copies, are broadcast.
BROADCAST_BYTES = 128 * 1024 * 1024
# A shuffle key with more rows than this is split over several tasks.
ROWS_PER_TASK = 4_000_000
# A key worth splitting has about this many rows in the sample that looks for them.
SAMPLED_PER_HEAVY_KEY = 1_000
# Up to so many windows of one asset are compared with each of its quotes.
FEW_WINDOWS = 64
# Bytes that a row of assets or of heavy keys takes in a broadcast, generously.
KEY_ROW_BYTES = 200

SPAN_BITS = 3  # spans grow by 2^3, from one day to 8^8 days, past the year 9999
SPAN_STEPS = 9
KEY = ("asset", "_span", "_slot")
ROW = "_validity_row"  # a row's number in its input
FIXED_SIZE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


@dataclass(frozen=True)
class WindowSize:
    """Rows, assets and broadcast bytes of the windows, most windows of one asset, and first and last day."""

    rows: int
    filed_bytes: int
    assets: int
    most: int
    first: date | None
    last: date | None

    def fits(self, broadcast_bytes: int) -> bool:
        return self.filed_bytes <= broadcast_bytes

    @property
    def few(self) -> bool:
        return self.most <= FEW_WINDOWS


def _as_windows(members: DataFrame) -> DataFrame:
    require_columns(members, "asset", "start", "end")
    bounds = {}
    for name in ("start", "end"):
        is_text = isinstance(members.schema[name].dataType, T.StringType)
        convert = day_or_error if is_text else day_or_null
        bounds[name] = convert(F.col(name))
    return members.withColumns(bounds)


def _span_step() -> Column:
    """Which power of eight holds a window's days; null when it has none."""
    days = F.datediff("end", "start") + 1
    return F.ceil(F.log2(days) / SPAN_BITS).cast("int")


def measure_windows(members: DataFrame) -> WindowSize:
    """Counts per asset, then one row; its size is fixed."""
    windows = _as_windows(members)
    row_bytes = F.lit(16 * (len(windows.columns) + 3))
    for field in windows.schema.fields:
        if field.name == "asset" or not isinstance(field.dataType, FIXED_SIZE):
            text = F.col(quoted(field.name)).cast("string")
            row_bytes = row_bytes + F.coalesce(F.octet_length(text), F.lit(0))
    row = (
        windows.groupBy("asset")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(2 * row_bytes).alias("bytes"),
            F.min("start").alias("first"),
            F.max("end").alias("last"),
        )
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.count("asset").alias("assets"),
            F.coalesce(F.max(F.when(F.col("asset").isNotNull(), F.col("rows"))), F.lit(0)).alias("most"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .first()
    )
    return WindowSize(row["rows"], row["bytes"], row["assets"], row["most"], row["first"], row["last"])


def _slot(day: Column, span: Column) -> Column:
    return F.floor(F.unix_date(day) / span).cast("int")


def _filed_windows(members: DataFrame) -> DataFrame:
    span = F.pow(F.lit(2), SPAN_BITS * _span_step()).cast("int")
    windows = members.withColumn("_span", span)
    slots = F.sequence(_slot(F.col("start"), F.col("_span")), _slot(F.col("end"), F.col("_span")))
    return windows.where(F.col("_span").isNotNull() & F.col("asset").isNotNull()).withColumn(
        "_slot", F.explode(slots)
    )


def _asset_spans(windows: DataFrame) -> DataFrame:
    """Per asset the spans its windows need."""
    span = F.pow(F.lit(2), SPAN_BITS * _span_step()).cast("int")
    known = windows.where(F.col("asset").isNotNull()).withColumn("_span", span).where("_span IS NOT NULL")
    return known.groupBy("asset").agg(F.collect_set("_span").alias("_spans"))  # nine at most


def _keyed_quotes(quotes: DataFrame, spans: DataFrame, fits: bool) -> DataFrame:
    """Quotes of assets that have windows, once per span of their asset, with their slots."""
    side = F.broadcast(spans) if fits else spans
    known = quotes.join(side, "asset").withColumn("_span", F.explode("_spans")).drop("_spans")
    return known.withColumn("_slot", _slot(F.col("date"), F.col("_span")))


def _heavy_keys(side: DataFrame, key: tuple[str, ...], rows_per_task: int, name: str) -> DataFrame:
    """Keys too big for one task and the number of tasks for each, as column ``name``."""
    keys = side.where(F.col("asset").isNotNull()).select(*key)
    fraction = min(1.0, SAMPLED_PER_HEAVY_KEY / rows_per_task)
    if fraction < 1:
        keys = keys.sample(fraction=fraction, seed=1)
    share = rows_per_task * fraction
    counts = keys.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > share)
    return counts.select(*key, F.ceil(F.col("rows") / share).cast("int").alias(name))


def _numbered(side: DataFrame) -> DataFrame:
    """``side`` with ``ROW``, the row's number in its input, unless it has one; to be taken before any shuffle."""
    return side if ROW in side.columns else side.withColumn(ROW, F.monotonically_increasing_id())


def _spread(side: DataFrame, heavy: DataFrame, key: tuple[str, ...], own: str, other: str) -> DataFrame:
    """Give each numbered row one part of its own side and copies for the parts of the other.

    The part is a hash of the row's number: rows that are equal in everything go
    to different parts, and a recomputed task repeats it.
    """
    part = F.pmod(F.xxhash64(ROW), F.col(f"_{own}_parts")).cast("int")
    copies = F.sequence(F.lit(0), F.col(f"_{other}_parts") - 1)
    return (
        side.join(heavy, on=list(key), how="left")
        .fillna(1, subset=["_quote_parts", "_window_parts"])
        .withColumn(f"_{own}", part)
        .withColumn(f"_{other}", F.explode(copies))
        .drop("_quote_parts", "_window_parts", ROW)
    )


def _spread_heavy_keys(
    quotes: DataFrame, windows: DataFrame, key: tuple[str, ...], rows_per_task: int
) -> tuple[DataFrame, DataFrame, tuple[str, ...]]:
    """Split heavy keys over a grid of quote parts x window parts, exactly once per pair.

    There are at most rows / ``rows_per_task`` heavy keys a side.  They are
    broadcast if their count allows, else joined by shuffling.  Sides that come
    out of a shuffle must have been numbered before it.
    """
    quotes, windows = _numbered(quotes), _numbered(windows)
    left = _heavy_keys(quotes, key, rows_per_task, "_quote_parts")
    right = _heavy_keys(windows, key, rows_per_task, "_window_parts")
    heavy = left.join(right, list(key), "full").fillna(1, subset=["_quote_parts", "_window_parts"])
    heavy = saved(heavy, "heavy_keys")  # both sides must see the same parts
    count = heavy.count()
    if not count:
        return quotes, windows, key
    if count * KEY_ROW_BYTES <= BROADCAST_BYTES:
        heavy = F.broadcast(heavy)
    return (
        _spread(quotes, heavy, key, "quote", "window"),
        _spread(windows, heavy, key, "window", "quote"),
        (*key, "_quote", "_window"),
    )


def validity_join(
    quotes: DataFrame,
    members: DataFrame,
    size: WindowSize | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Quotes inside a validity window of their asset, both ends included.

    Overlapping windows and repeated members multiply rows.  The result has the
    quote columns, ``date``, and the member columns but ``asset``; a member
    column whose name is taken gets the suffix ``_range``.  With windows too large
    for a broadcast, inputs that come out of a shuffle of the caller's should be
    written first: a row's number is as repeatable as its input.
    """
    require_columns(quotes, "asset")
    dated = with_quote_day(quotes)
    windows = _as_windows(members)
    size = size or measure_windows(members)

    if size.first is not None and size.last is not None:
        # Literals, so that a scan with a date column skips what lies outside.
        first, last = (F.lit(day.isoformat()).cast("date") for day in (size.first, size.last))
        dated = dated.where(F.col("date").between(first, last))
    fits = size.fits(broadcast_bytes)
    assets_fit = size.assets * KEY_ROW_BYTES <= BROADCAST_BYTES
    columns_of = dated.columns, windows.columns
    if not fits:
        dated, windows = _numbered(dated), _numbered(windows)
    if size.few:
        left, right, key = dated, windows.where(F.col("asset").isNotNull()), ("asset",)
        if not fits and assets_fit:
            left = left.join(F.broadcast(right.select("asset").distinct()), "asset", "left_semi")
    else:
        left = _keyed_quotes(dated, _asset_spans(windows), assets_fit)
        right, key = _filed_windows(windows), KEY
    if fits:
        right = F.broadcast(right)
    else:
        left, right, key = _spread_heavy_keys(left, right, key, rows_per_task)
        right = right.hint("merge")

    left, right = left.alias("q"), right.alias("m")
    same_key = [F.col(f"q.{name}") == F.col(f"m.{name}") for name in key]
    inside = F.col("q.date").between(F.col("m.start"), F.col("m.end"))
    joined = left.join(right, reduce(lambda a, b: a & b, same_key) & inside, "inner")

    taken = {name.lower() for name in columns_of[0]}
    columns = [F.col(f"q.{quoted(name)}") for name in columns_of[0]]
    for name in columns_of[1]:
        if name != "asset":
            shown = f"{name}_range" if name.lower() in taken else name
            columns.append(F.col(f"m.{quoted(name)}").alias(shown))
    return joined.select(*columns)
