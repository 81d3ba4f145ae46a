"""Indicators over each symbol's own rows. All windows share one partitioning by symbol and order by
date, so any number of them costs one exchange and one sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meadowlark.functions.arrays import states
from meadowlark.operators.rank import percentile


def rows():
    return Window.partitionBy("symbol").orderBy("dt")


def last(n: int):
    return rows().rowsBetween(-(n - 1), 0)


def full(aggregate, value: Column, n: int) -> Column:
    """An aggregate of the last n rows, null unless all n have a value."""
    return F.when(F.count(value).over(last(n)) == n, aggregate(value).over(last(n)))


def diff(value: str) -> Column:
    return F.col(value) - F.lag(value).over(rows())


def sma(n: int, value: str = "close") -> Column:
    return full(F.avg, F.col(value), n)


def with_smas(bars: DataFrame, spans: tuple[int, ...] = (20, 50, 200)) -> DataFrame:
    return bars.withColumns({f"sma{n}": sma(n) for n in spans})


def ema(bars: DataFrame, span: int = 21, value: str = "close", out: str = "ema") -> DataFrame:
    """(symbol, dt, value, ema): the recursion e = a x + (1 - a) e, from the first value on; rows with a
    null value carry none. A symbol's rows are gathered to an array: as many as its dates."""
    a = 2.0 / (span + 1)
    gathered = bars.where(F.col(value).isNotNull()).groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("dt", F.col(value).alias("x")))).alias("xs"))

    def step(e: Column, x: Column) -> Column:
        return F.when(e.isNull(), x).otherwise(F.lit(a) * x + F.lit(1 - a) * e)

    before = states(F.transform("xs", lambda r: r["x"]), step, F.lit(None), "double")
    each = F.zip_with("xs", before, lambda r, e: F.struct(r["dt"].alias("dt"), r["x"].alias("x"), step(e, r["x"]).alias("e")))
    done = gathered.select("symbol", F.explode(each).alias("r"))
    return done.select("symbol", "r.dt", F.col("r.x").alias(value), F.col("r.e").alias(out))


def ema_scan(bars: DataFrame, bucket: Column, span: int = 21, value: str = "close", order: str = "dt", rows_at_once: int = 256) -> DataFrame:
    """Adds ``ema`` to the rows with a value, for symbols of any length, without gathering their rows.

    e = a x + q e' (q = 1 - a) over a chunk of rows is one affine map of what came before it. A chunk is at most
    ``rows_at_once`` rows of a symbol's ``bucket`` (a day of intraday bars, a year of daily ones), which has to grow with
    ``order``. Within a chunk sums of x / q^i, all of one size of numbers, give each row's own part; the chunks' maps
    are one pair each, composed in order from the symbol's first value on."""
    a = 2.0 / (span + 1)
    q = 1 - a
    if q <= 0:
        return bars.where(F.col(value).isNotNull()).withColumn("ema", F.col(value).cast("double"))
    by_bucket = Window.partitionBy("symbol", "_bucket").orderBy(order)
    numbered = bars.where(F.col(value).isNotNull()).withColumn("_bucket", bucket).withColumn("_at", F.row_number().over(by_bucket) - 1)
    cut = numbered.withColumns({"_chunk": F.floor(F.col("_at") / rows_at_once), "_i": F.col("_at") % rows_at_once + 1})
    within = Window.partitionBy("symbol", "_bucket", "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = cut.withColumn("_own", F.sum(a * F.col(value) / F.pow(F.lit(q), F.col("_i"))).over(within))
    maps = own.groupBy("symbol", "_bucket", "_chunk").agg(F.max("_i").alias("n"), F.max_by("_own", "_i").alias("s"), F.min_by(value, "_i").cast("double").alias("x"))
    gathered = maps.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("_bucket", "_chunk", "n", "s", "x"))).alias("m"))  # a pair a chunk
    start = gathered.withColumn("_x", F.col("m")[0]["x"])
    before = states(F.col("m"), lambda e, m: F.pow(F.lit(q), m["n"]) * (e + m["s"]), F.col("_x"), "double")
    told = start.select("symbol", F.explode(F.arrays_zip(F.col("m"), before.alias("b"))).alias("r")).select("symbol", F.col("r.m._bucket").alias("_bucket"), F.col("r.m._chunk").alias("_chunk"), F.col("r.b").alias("_before"))
    met = own.join(told, ["symbol", "_bucket", "_chunk"])
    return met.withColumn("ema", F.pow(F.lit(q), F.col("_i")) * (F.col("_before") + F.col("_own"))).select(*bars.columns, "ema")


def rsi(bars: DataFrame, n: int = 14) -> DataFrame:
    """Adds ``rsi`` of simple means of gains and losses; 100 where there is no loss."""
    moved = bars.withColumn("_d", diff("close"))
    gain, loss = (full(F.avg, F.greatest(sign * F.col("_d"), F.lit(0.0) + F.col("_d") * 0), n) for sign in (1, -1))
    out = moved.withColumn("_g", gain).withColumn("_l", loss)
    value = F.when(F.col("_l") == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide(F.col("_g"), F.col("_l"))))
    return out.withColumn("rsi", F.when(F.col("_g").isNotNull(), value)).drop("_d", "_g", "_l")


def true_range() -> Column:
    before = F.lag("close").over(rows())
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def with_atr(bars: DataFrame, n: int = 14) -> DataFrame:
    """Adds ``tr`` and ``atr``, the simple mean of n true ranges."""
    out = bars.withColumn("tr", true_range())
    return out.withColumn("atr", full(F.avg, F.col("tr"), n))


def with_atr_extension(bars: DataFrame) -> DataFrame:
    """Adds ``atr_extension``: how many true ranges the close lies above its 200-row mean."""
    return with_atr(bars).withColumn("atr_extension", F.try_divide(F.col("close") - sma(200), F.col("atr")))


def vwap(bars: DataFrame, reset: Column | None = None) -> DataFrame:
    """Adds ``vwap``: cumulative typical price by volume, over all of a symbol's rows or anew for each
    value of ``reset`` (a day, for bars within days)."""
    keys = ["symbol"] + ([] if reset is None else ["_reset"])
    per = bars if reset is None else bars.withColumn("_reset", reset)
    w = Window.partitionBy(*keys).orderBy("ts" if "ts" in bars.columns else "dt").rowsBetween(Window.unboundedPreceding, 0)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    return per.withColumn("vwap", F.try_divide(F.sum(typical * F.col("volume")).over(w), F.sum("volume").over(w))).drop("_reset")


def benchmark(bars: DataFrame) -> DataFrame:
    """(dt, high, low, close): the mean of all bars by date, standing for an index."""
    return bars.groupBy("dt").agg(*[F.avg(c).alias(c) for c in ("high", "low", "close")])


def rrs(bars: DataFrame, index: DataFrame, n: int = 12, digits: int | None = None) -> DataFrame:
    """(symbol, dt, rrs, rrs_percentile): a symbol's move beyond the index's, in true ranges, summed over
    n rows and ranked by date. ``index`` is a row a date. ``digits`` rounds the sums before ranking."""
    one = with_atr(index.withColumn("symbol", F.lit(0))).withColumn("b_move", diff("close")).select("dt", "b_move", F.col("atr").alias("b_atr"))
    moved = with_atr(bars).withColumn("move", diff("close")).join(F.broadcast(one), "dt")
    beyond = F.try_divide(F.col("move") - F.try_divide(F.col("b_move") * F.col("atr"), F.col("b_atr")), F.col("atr"))
    summed = moved.withColumn("beyond", beyond).withColumn("rrs", full(F.sum, F.col("beyond"), n)).where("rrs is not null")
    summed = summed.withColumn("rrs", F.round("rrs", digits)) if digits is not None else summed
    return percentile(summed.select("symbol", "dt", "rrs"), "rrs", ["dt"], "rrs_percentile")


def buying_pressure(bars: DataFrame, n: int = 20, share: float = 0.3) -> DataFrame:
    """Adds ``buying_pressure``: of the money traded on days that moved at least ``share`` of a true
    range, the part of the days that rose, over n rows."""
    moved = with_atr(bars).withColumn("_d", diff("close"))
    money = F.coalesce(F.col("close") * F.col("volume"), F.lit(0.0))
    big = F.abs("_d") >= F.col("atr") * share
    moved = moved.withColumn("_up", F.when(big & (F.col("_d") > 0), money).otherwise(0.0)).withColumn("_down", F.when(big & (F.col("_d") < 0), money).otherwise(0.0))
    up, down = full(F.sum, F.col("_up"), n), full(F.sum, F.col("_down"), n)
    moved = moved.withColumn("_u", up).withColumn("_t", up + down)
    return moved.withColumn("buying_pressure", F.when(F.col("_t") > 0, F.col("_u") / F.col("_t"))).drop("_d", "_up", "_down", "_u", "_t")
