"""Cleaning and segmenting long panels of daily bars. A series is one security; its rows are ordered by date."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sources.stored import written

PRICES = ("open", "high", "low", "close")
BLANKED = (*PRICES, "adjusted_close", "volume")
# Fixed thresholds of the data model.
SPIKE_LN, UNWIND, SPLICE_LN, GUARD_DAYS, GAP_DAYS, SPAN_BARS, LEVEL_LN, SEGMENT_BARS = 0.80, 0.15, 2.0, 5, 365, 5, 1.60, 5


def by_date():
    return Window.partitionBy("security_id").orderBy("date")


def date_floor(bars: DataFrame, floor: str) -> DataFrame:
    """Rows on or after floor; rows without a date go too."""
    return bars.where(F.col("date") >= F.lit(floor).cast("date"))


def blank_non_positive(bars: DataFrame) -> DataFrame:
    """Prices and volume of bars with a price of 0 or less become null; row and date stay."""
    bad = F.least(*(F.col(c) for c in PRICES)) <= 0
    return bars.withColumns({c: F.when(F.coalesce(~bad, F.lit(True)), F.col(c)) for c in BLANKED})


def clamp_range(bars: DataFrame) -> DataFrame:
    """high and low become the largest and smallest of the prices present."""
    present = [F.col(c) for c in PRICES]
    return bars.withColumns({"high": F.greatest(*present), "low": F.least(*present)})


def gap_segments(bars: DataFrame, days: int = GAP_DAYS) -> DataFrame:
    """seg: number of holes of more than `days` days before the row in its series. Rows without a date go."""
    new = F.when(F.datediff("date", F.lag("date").over(by_date())) > days, 1).otherwise(0)
    return bars.where("date is not null").withColumn("_new", new).withColumn("seg", F.sum("_new").over(by_date().rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def listing_span(bars: DataFrame, days: int = GAP_DAYS, least: int = SPAN_BARS) -> DataFrame:
    """The first segment of more than `least` bars of each series, or else its longest, the earliest of equals. All windows are
    within a security: one exchange, whatever came before it."""
    whole, seg = Window.partitionBy("security_id"), Window.partitionBy("security_id", "seg")
    cut = gap_segments(bars, days).withColumn("_n", F.count("*").over(seg))
    first = F.min(F.when(F.col("_n") > least, F.col("seg"))).over(whole)
    longest = F.max(F.struct(F.col("_n"), (-F.col("seg")).alias("s"))).over(whole)
    best = cut.withColumn("_best", F.coalesce(first, -longest["s"]))
    return best.where("seg = _best").select(*bars.columns)


def print_flag(spike: float, unwind: float) -> Column:
    """Whether a bar's adjusted close jumps from the last printing bar's and is back on the next printing bar."""
    p = F.when(F.col("adjusted_close") > 0, F.col("adjusted_close"))
    before = F.last(p, ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, -1))
    # From the latest on: a frame that only grows is one step a row, one that shrinks is begun anew for each.
    latest_first = Window.partitionBy("security_id").orderBy(F.desc("date"))
    after = F.last(p, ignorenulls=True).over(latest_first.rowsBetween(Window.unboundedPreceding, -1))
    jump = F.abs(F.ln(p / before))
    return F.coalesce((jump > spike) & (F.abs(F.ln(after / before)) < unwind * jump), F.lit(False))


def isolated_prints(bars: DataFrame, spike: float = SPIKE_LN, unwind: float = UNWIND) -> DataFrame:
    """Bars whose adjusted close jumps and is back on the next printing bar."""
    p = bars.where("adjusted_close > 0").withColumns({"prev": F.lag("adjusted_close").over(by_date()), "next": F.lead("adjusted_close").over(by_date())})
    jump = F.abs(F.ln(F.col("adjusted_close") / F.col("prev")))
    return p.where((jump > spike) & (F.abs(F.ln(F.col("next") / F.col("prev"))) < unwind * jump))


def prints_to_blank(p: np.ndarray, spike: float, unwind: float) -> np.ndarray:
    """Places of the isolated prints of a series, the largest jump first and never two neighbours in one pass, until none is left."""
    live, blank = np.flatnonzero(np.nan_to_num(p) > 0), np.zeros(len(p), bool)
    while len(live) > 2:
        y = np.log(p[live])
        jump, back = np.abs(y[1:-1] - y[:-2]), np.abs(y[2:] - y[:-2])
        at = np.flatnonzero((jump > spike) & (back < unwind * jump)) + 1
        if not len(at):
            break
        taken = np.zeros(len(live), bool)
        for j in at[np.lexsort((-at, -jump[at - 1]))]:
            if not taken[j - 1] and not taken[j + 1]:
                taken[j] = True
        blank[live[taken]] = True
        live = live[~taken]
    return blank


def neutralize_prints(bars: DataFrame, spike: float = SPIKE_LN, unwind: float = UNWIND) -> DataFrame:
    """Isolated prints blanked (prints_to_blank). Only series that have a candidate go through the grouped function, each a few
    thousand rows; bars with their flag are stored first, so what comes before runs once for both kinds of series."""
    names = bars.columns
    flagged = bars.withColumn("_flag", print_flag(spike, unwind)).withColumn("_some", F.max("_flag").over(Window.partitionBy("security_id"))).drop("_flag")
    flagged = written(flagged, "flagged")

    def settle(key, own):
        own = own.sort_by("date")
        blank = prints_to_blank(own.column("adjusted_close").to_numpy(zero_copy_only=False).astype(float), spike, unwind)
        for k, name in enumerate(own.column_names):
            if name in BLANKED and blank.any():
                own = own.set_column(k, own.schema.field(k), pc.if_else(pa.array(~blank), own.column(k), pa.scalar(None, own.schema.field(k).type)))
        return own

    dirty = flagged.where("_some").select(*names).groupBy("security_id").applyInArrow(settle, StructType([StructField(f.name, f.dataType) for f in bars.schema]))
    return flagged.where("not _some").select(*names).unionByName(dirty)


def guard_days(splits: DataFrame, days: int = GUARD_DAYS) -> DataFrame:
    """security_id and each date within `days` of a split."""
    every = F.sequence(F.date_sub("date", days), F.date_add("date", days))
    return splits.select("security_id", F.explode(every).alias("date")).distinct()


def splice_cut(bars: DataFrame, splits: DataFrame, jump: float = SPLICE_LN, days: int = GUARD_DAYS) -> DataFrame:
    """Bars before the first unexplained break of the adjusted close in their series: a break within `days` of a split of the
    security is explained. A series' split days, a few, come to its rows as one array."""
    held = splits.groupBy("security_id").agg(F.collect_set("date").alias("_days"))
    p = F.when(F.col("adjusted_close") > 0, F.col("adjusted_close"))
    before = F.last(p, ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, -1))
    broken = F.abs(F.ln(p) - F.ln(before)) > jump
    out = bars.join(held, "security_id", "left").withColumn("_broken", broken)
    near = F.coalesce(F.exists("_days", lambda d: F.abs(F.datediff("date", d)) <= days), F.lit(False))
    out = out.withColumn("_cut", F.min(F.when(F.col("_broken") & ~near, F.col("date"))).over(Window.partitionBy("security_id")))
    return out.where("_cut is null or date < _cut").select(*bars.columns)


def trim_events(events: DataFrame, bars: DataFrame, floor: str, slack: int = 7, lead: int = 365) -> DataFrame:
    """Events inside their series' listing; an end that is the data's own end doesn't bound it."""
    span = bars.groupBy("security_id").agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    edge = bars.agg(F.max("date").alias("_last"))
    out = events.join(span, "security_id", "left").crossJoin(F.broadcast(edge))
    late = (F.col("date") <= F.col("_hi")) | (F.col("_hi") >= F.date_sub("_last", slack))
    soon = (F.col("date") >= F.col("_lo")) | (F.col("_lo") <= F.date_add(F.lit(floor).cast("date"), lead))
    return out.where(F.col("_lo").isNull() | (late & soon)).select(*events.columns)


def build_bars(raw: DataFrame, splits: DataFrame, floor: str) -> DataFrame:
    """The cleaning chain in its fixed order. Every rule is within a security: the bars are exchanged by it up to the flag of prints
    and stored, those with a print once more for the grouped function, and all once more for the cut."""
    bars = listing_span(clamp_range(blank_non_positive(date_floor(raw, floor))))
    return splice_cut(neutralize_prints(bars), splits)


def admissible(panel: DataFrame) -> DataFrame:
    return panel.where("adj > 0 and close > 0")


def reversal_flags(panel: DataFrame, spike: float = SPIKE_LN, revert: float = UNWIND) -> DataFrame:
    """bad: the bar belongs to a jump of `spike` or more that is back within three bars. Judged on the series as it was."""
    y = {f"_y{k}": F.lead("_y", k).over(by_date()) for k in (1, 2, 3)} | {"_p": F.lag("_y").over(by_date())}
    r = F.abs(F.col("_y") - F.col("_p"))
    reach = F.lit(0)
    for k in (3, 2, 1):
        reach = F.when(F.abs(F.col(f"_y{k}") - F.col("_p")) < revert * r, k).otherwise(reach)
    out = panel.withColumn("_y", F.ln("adj")).withColumns(y).withColumn("_reach", F.when(r >= spike, reach).otherwise(0))
    bad = (F.col("_reach") > 0) | (F.lag("_reach", 1, 0).over(by_date()) > 1) | (F.lag("_reach", 2, 0).over(by_date()) > 2)
    return out.withColumn("bad", bad).select(*panel.columns, "bad")


def level_segments(panel: DataFrame, level: float = LEVEL_LN, days: int = GAP_DAYS) -> DataFrame:
    """seg: a new one at each level break or gap."""
    new = (F.abs(F.ln("adj") - F.ln(F.lag("adj").over(by_date()))) > level) | (F.datediff("date", F.lag("date").over(by_date())) > days)
    return panel.withColumn("_new", F.when(new, 1).otherwise(0)).withColumn("seg", F.sum("_new").over(by_date().rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def segment():
    return Window.partitionBy("security_id", "seg")


def long_segments(panel: DataFrame, least: int = SEGMENT_BARS) -> DataFrame:
    return panel.withColumn("_n", F.count("*").over(segment())).where(F.col("_n") >= least).drop("_n")


def centred(panel: DataFrame) -> DataFrame:
    """y: log price less its mean over the segment."""
    return panel.withColumn("y", F.ln("adj") - F.avg(F.ln("adj")).over(segment()))


def trend_panel(panel: DataFrame) -> DataFrame:
    clean = reversal_flags(admissible(panel)).where("not bad").drop("bad")
    return centred(long_segments(level_segments(clean)))


def filing_date(end: str = "period_end", filed: str = "filing_date") -> Column:
    """A filing before the period's end is no date."""
    return F.when(F.col(filed) >= F.col(end), F.col(filed))
