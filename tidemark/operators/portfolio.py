"""Portfolio returns with costs as table operators. Between rebalances a book is buy-and-hold, so weights, value and equity have
a closed form: no loop over days. Every table carries a strategy key; nothing is pivoted.

prices: asset, date, price. targets: strategy, asset, date (of the signal), weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import written
from .factors import asof_backward

#: A return of no more than this is none: sums of equal numbers differ by so much.
NOTHING = 1e-12
#: A path of books stays as it is when no book moves by more than this share of it.
SAME = 1e-14
# Fixed cost tiers: monthly dollar volume from which on the one-way spread holds.
SPREADS = ((1e9, 0.0005), (1e8, 0.0010), (1e7, 0.0025), (1e6, 0.0060), (0.0, 0.0150))


def calendar(prices: DataFrame) -> DataFrame:
    """date, its row number t and the last one. One row a trading day whatever the number of assets, some 250 a year: small enough to
    be sent to all tasks. A date with two prices of an asset is an error, as is an empty date."""
    days = prices.groupBy("date").agg(F.count("asset").alias("_n"), F.countDistinct("asset").alias("_m"))
    whole = F.when(F.col("date").isNull(), F.raise_error(F.lit("prices without a date"))).when(F.col("_n") > F.col("_m"), F.raise_error(F.concat(F.lit("two prices of an asset on "), F.col("date").cast("string")))).otherwise(F.col("date"))
    return days.select(whole.alias("date")).withColumns({"t": F.row_number().over(Window.orderBy("date")), "last": F.count("*").over(Window.partitionBy()).cast("int")})


def month_ends(prices: DataFrame) -> DataFrame:
    """The last trading day of each month."""
    return prices.groupBy(F.trunc("date", "MM").alias("month")).agg(F.max("date").alias("date"))


def schedule(signals: DataFrame, days: DataFrame, lag: int = 0) -> DataFrame:
    """signals (strategy, date) with fill_t, exec_t and the calendar's last row; those beyond the calendar, or off it, drop out."""
    out = signals.join(F.broadcast(days), "date").withColumns({"fill_t": F.col("t") + lag, "exec_t": F.col("t") + lag + 1})
    return out.where("exec_t <= last").drop("t")


def returns(prices: DataFrame, days: DataFrame) -> DataFrame:
    """asset, t, ret over the whole calendar: price over the last known price before, null without one."""
    grid = prices.select("asset").distinct().crossJoin(F.broadcast(days.select("date", "t")))
    w = Window.partitionBy("asset").orderBy("t")
    out = grid.join(prices.select("asset", "date", "price"), ["asset", "date"], "left")
    out = out.withColumn("known", F.last("price", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("ret", F.try_divide("price", F.lag("known").over(w)) - 1)


def written_off(rets: DataFrame, loss: float | DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """The return on the row after an asset's last print becomes `loss`: one number, or a table of asset and loss in which assets
    without one are held flat. dates: asset and date of delistings, which then decide instead of last prints: the write-off falls on the
    row after the last calendar row on or before the date, if that lies in the calendar before its last row; assets without a date
    keep theirs. The last print's own return is kept. A loss below -1 is an error."""
    if not isinstance(loss, DataFrame):
        if loss < -1:
            raise ValueError("a delisting return must be -1 or more")
        if dates is None:
            last = rets.groupBy("asset").agg(F.max(F.when(F.col("price").isNotNull(), F.col("t"))).alias("_t"), F.lit(float(loss)).alias("_loss"))
        else:
            last = _last_rows(rets, dates).withColumn("_loss", F.lit(float(loss)))
    else:
        own = F.when(F.col("loss") < -1, F.raise_error(F.concat(F.lit("a delisting return must be -1 or more, not "), F.col("loss").cast("string")))).otherwise(F.col("loss").cast("double"))
        last = _last_rows(rets, dates) if dates is not None else rets.groupBy("asset").agg(F.max(F.when(F.col("price").isNotNull(), F.col("t"))).alias("_t"))
        last = last.join(loss.select("asset", own.alias("_loss")), "asset").where("_loss is not null and not isnan(_loss)")
    return rets.join(last, "asset", "left").withColumn("ret", F.when(F.col("t") == F.col("_t") + 1, F.col("_loss")).otherwise(F.col("ret"))).drop("_t", "_loss")


def _last_rows(rets: DataFrame, dates: DataFrame) -> DataFrame:
    """asset and the last row of the calendar on or before its date."""
    rows = rets.join(dates.select("asset", F.col("date").alias("_date")), "asset").where(F.col("date") <= F.col("_date"))
    return rows.groupBy("asset").agg(F.max("t").alias("_t"))


def spread(dollar_volume: Column) -> Column:
    """The spread of the highest tier cleared; unknown volume has the worst."""
    out = F.lit(max(c for _, c in SPREADS))
    for least, cost in sorted(SPREADS):
        out = F.when(dollar_volume >= least, cost).otherwise(out)
    return out


def slots(targets: DataFrame, plan: DataFrame) -> DataFrame:
    """Targets at their execution: strategy, asset, exec_t, weight, the row end_t before the next execution (or null), and the row
    upto_t to which they are held. plan: schedule(), a row for each of a strategy's signals."""
    turn = plan.withColumn("end_t", F.lead("exec_t").over(Window.partitionBy("strategy").orderBy("exec_t")) - 1)
    turn = turn.select("strategy", "date", "exec_t", "fill_t", "end_t", F.coalesce("end_t", "last").alias("upto_t"))
    return targets.join(turn, ["strategy", "date"]).select("strategy", "asset", "exec_t", "fill_t", "end_t", "upto_t", "weight")


def drifted(held: DataFrame, rets: DataFrame) -> DataFrame:
    """strategy, exec_t, t, asset, weight, growth since the execution, value of the book (1 at it) and drifted weight. Holdings are laid
    out by their days first, so they meet returns by asset and day: no return travels that nobody holds."""
    own = held.select("strategy", "asset", "exec_t", "fill_t", "end_t", "weight", F.explode(F.sequence("exec_t", "upto_t")).alias("t"))
    out = own.join(rets.select("asset", "t", "ret"), ["asset", "t"])
    w = Window.partitionBy("strategy", "exec_t", "asset").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("growth", F.product(1 + F.coalesce("ret", F.lit(0.0))).over(w))
    out = out.withColumn("value", 1 + F.sum(F.col("weight") * (F.col("growth") - 1)).over(Window.partitionBy("strategy", "exec_t", "t")))
    return out.withColumn("drift", F.when(F.col("value") > 0, F.col("weight") * F.col("growth") / F.col("value")))


def trades(held: DataFrame, drift: DataFrame) -> DataFrame:
    """Weight before and after each execution, of all assets held before or after: w_before, w_after, traded."""
    before = drift.where(F.col("t") == F.col("end_t")).select("strategy", "asset", (F.col("end_t") + 1).alias("exec_t"), F.coalesce("drift", F.lit(0.0)).alias("w_before"))
    out = held.select("strategy", "asset", "exec_t", F.col("weight").alias("w_after")).join(before, ["strategy", "asset", "exec_t"], "full").na.fill(0.0, ["w_before", "w_after"])
    # A book's first execution has nothing before it; rows without an execution of the strategy are the books' own ends.
    return out.withColumn("traded", F.abs(F.col("w_after") - F.col("w_before")))


def rebalances(moves: DataFrame, rate: Column, short_multiple: float = 1.0) -> DataFrame:
    """strategy, exec_t, turnover (half of what is traded) and cost, capped at 0.999."""
    dear = F.when(F.col("w_after") < 0, short_multiple).otherwise(1.0)
    return moves.groupBy("strategy", "exec_t").agg((F.sum("traded") / 2).alias("turnover"), F.least(F.sum(rate * F.col("traded") * dear), F.lit(0.999)).alias("cost"))


def tradable(held: DataFrame, rets: DataFrame) -> DataFrame:
    """held with a weight of 0 where the asset has no price on the fill row, so that a held name is closed, and fill_price, the
    last known one."""
    at = rets.select("asset", F.col("t").alias("fill_t"), F.col("price").alias("_price"), F.col("known").alias("fill_price"))
    out = held.join(at, ["asset", "fill_t"], "left")
    return out.withColumn("weight", F.when(F.col("_price").isNotNull(), F.col("weight")).otherwise(0.0)).drop("_price")


def vanished(held: DataFrame, rets: DataFrame) -> DataFrame:
    """strategy and n: names with a weight other than 0 at some time whose last price precedes the end of the calendar."""
    last = rets.groupBy("asset").agg(F.max(F.when(F.col("price").isNotNull(), F.col("t"))).alias("_last"))
    edge = rets.agg(F.max("t").alias("_edge"))
    names = held.where("weight <> 0").select("strategy", "asset").distinct().join(last, "asset").crossJoin(F.broadcast(edge))
    return names.groupBy("strategy").agg(F.count_if(F.col("_last") < F.col("_edge")).alias("n"))


def in_force(points: DataFrame, source: DataFrame | float, value: str, closed: str | None = None) -> DataFrame:
    """points (asset, date) with the source's value of the last row on or before the date. Unknown ones fail closed: they take the
    highest ("max", for a rate) or the lowest ("min", for a capacity) value of the whole source; without `closed` they stay null.
    A source without dates holds for all of them, and a number for all assets too; a number below 0 is an error."""
    own = points.select("asset", "date").distinct()
    if not isinstance(source, DataFrame):
        if source < 0:
            raise ValueError(f"{value} must be 0 or more")
        return own.withColumn(value, F.lit(float(source)))
    met = asof_backward(own, source, ["asset"], [value]) if "date" in source.columns else own.join(source.select("asset", value), "asset", "left")
    if closed is None:
        return met.select("asset", "date", value)
    worst = source.agg((F.max if closed == "max" else F.min)(value).alias("_worst"))
    return met.crossJoin(F.broadcast(worst)).select("asset", "date", F.coalesce(value, "_worst").alias(value))


def commission(notional: Column, price: Column, per_share: float, least: float, share: float) -> Column:
    """The fee of one trade: by share, no less than `least`, no more than a share of the notional; null without a price."""
    return F.when((price > 0) & (notional > 0), F.least(F.greatest(per_share * notional / price, F.lit(least)), share * notional))


def impact(notional: Column, volume: Column, coefficient: float) -> Column:
    """Square-root impact as a share of the notional; none where the volume isn't known."""
    return F.when(volume > 0, coefficient * F.sqrt(notional / volume)).otherwise(0.0)


def borrowed(drift: DataFrame, fee: Column, freq: float = 252.0) -> DataFrame:
    """strategy, t, borrow: the fee on short weights at the start of each period, which at an execution are the targets."""
    before = F.lag("drift").over(Window.partitionBy("strategy", "exec_t", "asset").orderBy("t"))
    own = drift.withColumn("_w", F.when(F.col("t") == F.col("exec_t"), F.col("weight")).otherwise(before))
    return own.groupBy("strategy", "t").agg(F.least(F.sum(F.greatest(-F.col("_w"), F.lit(0.0)) * fee) / freq, F.lit(0.999)).alias("borrow"))


def sized_costs(moves: DataFrame, drift: DataFrame, borrow: DataFrame, capital: float, per_share: float = 0.0, least: float = 0.0, share: float = 0.0, coefficient: float = 0.0, short_multiple: float = 1.0) -> DataFrame:
    """strategy, exec_t, book, turnover, cost, commission, impact: costs that depend on the size of the book, which is the equity before
    the execution times the capital. moves: strategy, asset, exec_t, w_after, traded, rate, price, volume.

    Costs feed back through one number, the book, from each execution to the next. Spreads are one sum of an execution, impact is one
    over the root of the book, and a commission is a line in the book between the points where another of its bounds holds. A round
    adds up these lines by execution, as they are at the books of the round before, and folds the executions in order; when the
    books stay as they are, every line was the right one. Trades never meet in one task, only a strategy's executions do, a row of
    a few sums for each."""
    if capital < 0:
        raise ValueError("capital must be 0 or more")
    short = F.when(F.col("w_after") < 0, short_multiple).otherwise(1.0)
    deep = F.when(F.col("volume") > 0, coefficient * F.pow("traded", 1.5) / F.sqrt("volume")).otherwise(0.0)
    sums = moves.groupBy("strategy", "exec_t").agg((F.sum("traded") / 2).alias("turnover"), F.sum(F.col("traded") * F.col("rate") * short).alias("spread"), F.sum(deep).alias("deep"))
    days = drift.groupBy("strategy", "exec_t", "t").agg(F.first("value").alias("value"), F.first("end_t").alias("end_t")).join(borrow, ["strategy", "t"])
    span = days.groupBy("strategy", "exec_t").agg(F.product(1 - F.col("borrow")).alias("kept"), F.max(F.when(F.col("t") == F.col("end_t"), F.col("value"))).alias("close"))
    slot = written(sums.join(span, ["strategy", "exec_t"], "left").withColumn("held", F.coalesce("close", F.lit(1.0)) * F.coalesce("kept", F.lit(1.0))).drop("close", "kept"), "slots")
    trade = written(moves.where((F.col("traded") > 0) & (F.col("price") > 0)).select("strategy", "exec_t", "traded", (per_share / F.col("price")).alias("rate")), "trades") if per_share and capital else None

    def charged(x, book: Column) -> tuple[Column, Column, Column]:
        live, cash = (book > 0) & F.lit(capital > 0), book * capital
        fees, moved = (F.when(live, y).otherwise(0.0) for y in (x("flat") / cash + x("slope"), F.sqrt(cash) * x("deep")))
        return fees, moved, F.least(x("spread") + fees + moved, F.lit(0.999))

    def folded(lines: DataFrame) -> DataFrame:
        order = F.array_sort(F.collect_list(F.struct("exec_t", "turnover", "spread", "deep", "held", "flat", "slope")))
        start = F.struct(F.lit(1.0).alias("book"), F.array().cast("array<double>").alias("path"))
        step = lambda acc, x: F.struct((acc["book"] * (1 - charged(lambda c: x[c], acc["book"])[2]) * x["held"]).alias("book"), F.concat(acc["path"], F.array(acc["book"])).alias("path"))
        own = lines.groupBy("strategy").agg(order.alias("slot")).withColumn("book", F.aggregate("slot", start, step)["path"])
        return own.select("strategy", F.explode(F.arrays_zip("slot", "book")).alias("x")).select("strategy", "x.slot.*", "x.book")

    own = written(folded(slot.withColumns({"flat": F.lit(0.0), "slope": F.lit(0.0)})), "path")
    while trade is not None:
        # The bound that holds at these books: the most of the notional, the fee by share, or the least fee.
        n = F.col("book") * capital * F.col("traded")
        top, by_share = F.lit(bool(share)) & (share * n <= F.greatest(F.col("rate") * n, F.lit(least))), F.col("rate") * n >= least
        line = trade.join(own.select("strategy", "exec_t", "book"), ["strategy", "exec_t"]).groupBy("strategy", "exec_t").agg(
            F.sum(F.when(top | by_share, 0.0).otherwise(least)).alias("flat"), F.sum(F.when(top, share * F.col("traded")).when(by_share, F.col("rate") * F.col("traded")).otherwise(0.0)).alias("slope")
        )
        then = folded(slot.join(line, ["strategy", "exec_t"], "left").na.fill(0.0, ["flat", "slope"]))
        then = written(then.join(own.select("strategy", "exec_t", F.col("book").alias("was")), ["strategy", "exec_t"]), "path")
        apart = then.agg(F.max(F.abs(F.col("book") - F.col("was")) / F.greatest(F.abs("was"), F.lit(1e-300)))).first()[0]
        own = then.drop("was")
        if apart is None or apart <= SAME:
            break
    fees, moved, cost = charged(F.col, F.col("book"))
    return own.select("strategy", "exec_t", "book", "turnover", cost.alias("cost"), fees.alias("commission"), moved.alias("impact"))


def blotter(moves: DataFrame, books: DataFrame, days: DataFrame, capital: float, per_share: float = 0.0, least: float = 0.0, share: float = 0.0, coefficient: float = 0.0, short_multiple: float = 1.0) -> DataFrame:
    """One row for each name traded at an execution, dated at the close that it fills on: action, side, weights before and after, price,
    cost as a share of what is traded, and amounts of money, null without capital. moves: as for sized_costs; books: strategy, exec_t, book."""
    own = moves.where(F.col("traded") > NOTHING).select("strategy", "asset", "exec_t", "w_before", "w_after", "traded", "rate", "price", "volume").join(books.select("strategy", "exec_t", "book"), ["strategy", "exec_t"], "left")
    own = own.join(F.broadcast(days.select("date", (F.col("t") + 1).alias("exec_t"))), "exec_t")
    sized = F.when(F.lit(capital > 0) & (F.col("book") > 0), F.col("book") * capital * F.col("traded"))
    cost = F.col("rate") * F.when(F.col("w_after") < 0, short_multiple).otherwise(1.0)
    if per_share:
        fee = commission(sized, F.col("price"), per_share, least, share) if share else F.when(F.col("price") > 0, F.greatest(per_share * sized / F.col("price"), F.lit(least)))
        cost = cost + F.coalesce(fee / sized, F.lit(0.0))
    if coefficient:
        cost = cost + F.coalesce(impact(sized, F.col("volume"), coefficient), F.lit(0.0))
    own = own.withColumns({"notional": sized, "cost_frac": cost})
    return own.select(
        "strategy", "date", "asset", F.when(F.col("w_before") == 0, "OPEN").when(F.col("w_after") == 0, "CLOSE").otherwise("REBALANCE").alias("action"), F.when(F.col("w_after") > F.col("w_before"), "BUY").otherwise("SELL").alias("side"),
        "w_before", "w_after", (F.col("w_after") - F.col("w_before")).alias("dw"), F.col("traded").alias("weight_traded"), "price", "cost_frac", "notional", F.when(F.col("price") > 0, F.col("notional") / F.col("price")).alias("shares"), (F.col("notional") * F.col("cost_frac")).alias("cost"),
    )


def equity(drift: DataFrame, costs: DataFrame, borrow: DataFrame | None = None) -> DataFrame:
    """strategy, t, equity (1 before the first execution) and ret: values within slots chained over slots, less costs and, if
    given, borrow fees."""
    value = drift.select("strategy", "exec_t", "end_t", "t", "value").distinct()
    close = value.where(F.col("t") == F.col("end_t")).select("strategy", "exec_t", F.col("value").alias("_close"))
    w = Window.partitionBy("strategy").orderBy("exec_t")
    base = costs.join(close, ["strategy", "exec_t"], "left").withColumn("_start", F.product(1 - F.col("cost")).over(w.rowsBetween(Window.unboundedPreceding, 0)) * F.coalesce(F.product("_close").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(1.0)))
    out = value.join(base.select("strategy", "exec_t", "_start"), ["strategy", "exec_t"]).select("strategy", "t", (F.col("_start") * F.col("value")).alias("equity"))
    by_day = Window.partitionBy("strategy").orderBy("t")
    if borrow is not None:
        kept = F.product(1 - F.coalesce("borrow", F.lit(0.0))).over(by_day.rowsBetween(Window.unboundedPreceding, 0))
        out = out.join(borrow, ["strategy", "t"], "left").withColumn("equity", F.col("equity") * kept).drop("borrow")
    before = F.coalesce(F.lag("equity").over(by_day), F.lit(1.0))
    return out.withColumn("ret", F.col("equity") / before - 1)


def drag(fractions: DataFrame, column: str, periods: DataFrame, freq: float = 252.0) -> DataFrame:
    """strategy and {column}_drag: what the fractions of a period cost in a year. periods: strategy, n (returns of the curve)."""
    kept = F.product(1 - F.least(F.greatest(F.col(column), F.lit(0.0)), F.lit(0.999)))
    own = fractions.groupBy("strategy").agg(kept.alias("_kept")).join(periods, "strategy")
    return own.select("strategy", F.when(F.col("_kept") <= 0, -1.0).otherwise(1 - F.pow("_kept", freq / F.col("n"))).alias(f"{column}_drag"))


def tail_mean(df: DataFrame, column: str, keys: list[str], share: float = 0.95) -> DataFrame:
    """Mean of the worst 1 - share of a column, of all of it where that is no row."""
    n = F.count("*").over(Window.partitionBy(*keys))
    k = F.ceil((1 - share) * n - 1e-9)
    ranked = df.withColumns({"_r": F.row_number().over(Window.partitionBy(*keys).orderBy(column)), "_k": k})
    return ranked.where("_k <= 0 or _r <= _k").groupBy(*keys).agg(F.avg(column).alias("tail_mean"))


def metrics(curve: DataFrame, freq: float = 252.0, rf: float = 0.0) -> DataFrame:
    """One row for each strategy from its equity curve; the first row is no period."""
    up = Window.partitionBy("strategy").orderBy("t")
    own = curve.withColumns({"_n": F.row_number().over(up), "drawdown": F.col("equity") / F.max("equity").over(up.rowsBetween(Window.unboundedPreceding, 0)) - 1})
    r = F.when(F.col("_n") > 1, F.col("ret"))
    agg = own.groupBy("strategy").agg(
        F.count(r).alias("n"), F.max_by("equity", "t").alias("_last"), F.min_by("equity", "t").alias("_first"), F.avg(r).alias("expectancy"), F.stddev_samp(r).alias("_sd"),
        F.stddev_samp(F.when(r < -NOTHING, r)).alias("_down"), F.avg(F.when(r > NOTHING, 1.0).when(r.isNotNull(), 0.0)).alias("win_rate"), F.min("drawdown").alias("max_drawdown"), F.coalesce(F.avg(F.when(F.col("drawdown") < -NOTHING, F.col("drawdown"))), F.lit(0.0)).alias("avg_drawdown"),
    )
    factor, excess = F.col("_last") / F.col("_first"), (F.col("expectancy") - ((1 + rf) ** (1 / freq) - 1)) * freq
    return agg.select(
        "strategy", "n", (factor - 1).alias("total_return"), F.when(factor <= 0, -1.0).otherwise(F.pow(factor, freq / F.col("n")) - 1).alias("ann_return"), (F.col("_sd") * freq**0.5).alias("ann_vol"),
        F.when(F.col("_sd") > 0, excess / (F.col("_sd") * freq**0.5)).alias("sharpe"), F.when(F.col("_down") > 0, excess / (F.col("_down") * freq**0.5)).alias("sortino"), "expectancy", "win_rate", "max_drawdown", "avg_drawdown",
    )


def _with_costs(curve: DataFrame, costs: DataFrame, fees: DataFrame) -> DataFrame:
    """curve with what a period costs: turnover, cost, commission and impact on the rows of executions (0 where costs lack the
    column), and borrow."""
    parts = ("turnover", "cost", "commission", "impact")
    own = costs.select("strategy", F.col("exec_t").alias("t"), *(F.col(c) if c in costs.columns else F.lit(0.0).alias(c) for c in parts))
    return curve.join(own, ["strategy", "t"], "left").join(fees.select("strategy", "t", "borrow"), ["strategy", "t"], "left").na.fill(0.0, [*parts, "borrow"])


def comparison(curve: DataFrame, costs: DataFrame, fees: DataFrame, freq: float = 252.0, rf: float = 0.0) -> DataFrame:
    """metrics() and: means of the worst 5 % of drawdowns (cdar) and, annualised, of returns (cvar_ann), downside deviation, turnover
    and the drags of all costs, of the commissions and impact among them, and of borrow fees."""
    by = Window.partitionBy("strategy")
    own = _with_costs(curve, costs, fees).withColumns({"_n": F.row_number().over(by.orderBy("t")), "_dd": F.col("equity") / F.max("equity").over(by.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)) - 1})
    own = own.withColumn("_r", F.when(F.col("_n") > 1, F.col("ret")))
    own = own.withColumns({"_all": F.count("*").over(by), "_per": F.count("_r").over(by), "_low": F.row_number().over(by.orderBy(F.col("_r").asc_nulls_last())), "_deep": F.row_number().over(by.orderBy("_dd"))})

    def worst(value: str, place: str, of: str) -> Column:
        k = F.ceil(0.05 * F.col(of) - 1e-9)
        return F.avg(F.when((k <= 0) | (F.col(place) <= k), F.col(value)))

    def year(column: str) -> Column:
        kept = F.product(F.when(F.col("_n") >= 1, 1 - F.least(F.greatest(F.col(column), F.lit(0.0)), F.lit(0.999))))
        return F.when(kept <= 0, -1.0).otherwise(1 - F.pow(kept, freq / F.max("_per"))).alias(f"{column}_drag")

    more = own.groupBy("strategy").agg(
        worst("_dd", "_deep", "_all").alias("cdar"), (worst("_r", "_low", "_per") * freq**0.5).alias("cvar_ann"), (F.stddev_samp(F.when(F.col("_r") < -NOTHING, F.col("_r"))) * freq**0.5).alias("downside_deviation"),
        (F.avg("turnover") * freq).alias("ann_turnover"), year("cost"), year("commission"), year("impact"), year("borrow"),
    )
    return metrics(curve, freq, rf).join(more, "strategy")


def yearly(curve: DataFrame, days: DataFrame, costs: DataFrame, fees: DataFrame, trades: DataFrame, freq: float = 252.0, rf: float = 0.0) -> DataFrame:
    """One row for each strategy and year: returns chained within the year, volatility, Sharpe and Sortino ratios, drawdown from the
    year's first value, best and worst period, win rate, sums of turnover and costs, and trades and rebalances by the date that they
    fill on. trades: strategy, date."""
    own = _with_costs(curve, costs, fees).join(F.broadcast(days.select("t", "date")), "t").withColumn("year", F.year("date"))
    w = Window.partitionBy("strategy", "year").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("_dd", F.col("equity") / F.max("equity").over(w) - 1)
    sd, down = F.stddev_samp("ret") * freq**0.5, F.stddev_samp(F.when(F.col("ret") < -NOTHING, F.col("ret"))) * freq**0.5
    excess = (F.avg("ret") - ((1 + rf) ** (1 / freq) - 1)) * freq
    out = own.groupBy("strategy", "year").agg(
        F.count("*").alias("periods"), (F.product(1 + F.col("ret")) - 1).alias("total"), sd.alias("vol"), F.when(sd > 0, excess / sd).alias("sharpe"), F.when(down > 0, excess / down).alias("sortino"),
        F.min("_dd").alias("max_drawdown"), F.max("ret").alias("best"), F.min("ret").alias("worst"), F.avg(F.when(F.col("ret") > NOTHING, 1.0).otherwise(0.0)).alias("win_rate"),
        *(F.sum(c).alias(c) for c in ("turnover", "cost", "borrow", "commission", "impact")),
    )
    done = trades.groupBy("strategy", F.year("date").alias("year")).agg(F.count("*").alias("trades"), F.countDistinct("date").alias("rebalances"))
    return out.join(done, ["strategy", "year"], "left").na.fill(0, ["trades", "rebalances"])


def folds(days: DataFrame, train: int, test: int) -> DataFrame:
    """fold, train and test rows of a walk forward: tests follow each other, training lies strictly before. The last test ends with the
    calendar. A calendar of fewer than train + test rows is an error."""
    if train <= 0 or test <= 0:
        raise ValueError("train and test must be positive")
    last = days.agg(F.max("t").alias("_last"))
    enough = F.when(F.coalesce("_last", F.lit(0)) < train + test, F.raise_error(F.concat(F.lit(f"train and test take {train + test} rows, there are "), F.coalesce("_last", F.lit(0)).cast("string")))).otherwise(F.col("_last"))
    count = F.ceil((enough - train) / test).cast("int")
    k = last.select("_last", F.explode(F.sequence(F.lit(0), count - 1)).alias("fold"))
    start = F.col("fold") * test + train
    return k.select("fold", (start - train + 1).alias("train_from"), start.alias("train_to"), (start + 1).alias("test_from"), F.least(start + test, F.col("_last")).alias("test_to"))


def training_rows(prices: DataFrame, days: DataFrame, train: int, test: int) -> DataFrame:
    """prices with the fold whose training they belong to, once for each. Row t is in the training of the folds whose start lies in
    the train rows from it on, which is counted, not searched: no join of rows with ranges."""
    last = F.ceil((F.col("last") - train) / test) - 1
    low, high = F.greatest(F.ceil((F.col("t") - train) / test), F.lit(0)), F.least(F.floor((F.col("t") - 1) / test), last)
    at = prices.join(F.broadcast(days), "date").where(high >= low)
    return at.withColumn("fold", F.explode(F.sequence(low.cast("int"), high.cast("int")))).select("fold", *prices.columns, "t")


def walk_forward(prices: DataFrame, fit, train: int, test: int, days: DataFrame | None = None) -> DataFrame:
    """fold, asset, date, weight: the targets of a rolling fit, every one of them out of sample. Each fold's training rows, no later
    ones, go to one call of fit(pandas frame of asset, date, price, in the order of date and asset), which returns a frame of asset
    and weight, held through the test, or of date, asset and weight, of which only rows of test dates count. Weights without a date
    are stamped once, on the test's first date, so that the book drifts from there; assets that the fit leaves out are then flat.

    A task holds one fold's slice: train rows of the calendar, whatever the number of folds."""
    import pandas as pd

    days = calendar(prices) if days is None else days
    plan = folds(days, train, test)
    kinds = {f.name: f.dataType.simpleString() for f in prices.schema}

    def run(slice_: pd.DataFrame) -> pd.DataFrame:
        fold, own = slice_["fold"].iloc[0], slice_.sort_values(["date", "asset"], kind="stable")
        out = fit(own[["asset", "date", "price"]].reset_index(drop=True))
        if "date" not in out.columns:
            names = own["asset"].drop_duplicates().sort_values()
            given = out.set_index("asset")["weight"].reindex(names).fillna(0.0)
            out = pd.DataFrame({"asset": names.to_numpy(), "date": None, "weight": given.to_numpy(float)})
        return out.assign(fold=fold)[["fold", "asset", "date", "weight"]]

    made = training_rows(prices.select("asset", "date", "price"), days, train, test).groupBy("fold").applyInPandas(run, f"fold int, asset {kinds['asset']}, date {kinds['date']}, weight double")
    bounds = plan.select("fold", "test_from", "test_to")
    first = made.where("date is null").join(F.broadcast(bounds), "fold").join(F.broadcast(days.select(F.col("t").alias("test_from"), F.col("date").alias("_first"))), "test_from").select("fold", "asset", F.col("_first").alias("date"), "weight")
    dated = made.where("date is not null").join(F.broadcast(days.select("date", "t")), "date").join(F.broadcast(bounds), "fold").where("t between test_from and test_to").select("fold", "asset", "date", "weight")
    return first.unionByName(dated)
