"""JSON documents to tables: a scan that skips what can't be read, and a company's facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

# A fact's section and key in the document, and its column and type.
FACTS = (
    ("General", "Name", "name", "string"), ("General", "Sector", "sector", "string"), ("General", "Industry", "industry", "string"), ("General", "GicSector", "gic_sector", "string"),
    ("General", "GicIndustry", "gic_industry", "string"), ("General", "ISIN", "isin", "string"), ("General", "CIK", "cik", "string"), ("General", "IPODate", "ipo_date", "date"),
    ("General", "IsDelisted", "is_delisted", "boolean"), ("General", "DelistedDate", "delisted_date", "date"), ("General", "FiscalYearEnd", "fiscal_year_end", "string"), ("General", "FullTimeEmployees", "full_time_employees", "long"),
    ("Highlights", "MarketCapitalization", "market_cap", "double"), ("Highlights", "EBITDA", "ebitda", "double"), ("Highlights", "PERatio", "pe_ratio", "double"), ("Highlights", "PEGRatio", "peg_ratio", "double"),
    ("Highlights", "BookValue", "book_value", "double"), ("Highlights", "DividendShare", "dividend_share", "double"), ("Highlights", "DividendYield", "dividend_yield", "double"), ("Highlights", "EarningsShare", "earnings_share", "double"),
    ("Highlights", "ProfitMargin", "profit_margin", "double"), ("Highlights", "OperatingMarginTTM", "operating_margin_ttm", "double"), ("Highlights", "ReturnOnAssetsTTM", "return_on_assets_ttm", "double"), ("Highlights", "ReturnOnEquityTTM", "return_on_equity_ttm", "double"),
    ("Highlights", "RevenueTTM", "revenue_ttm", "double"), ("Highlights", "RevenuePerShareTTM", "revenue_per_share_ttm", "double"), ("Highlights", "GrossProfitTTM", "gross_profit_ttm", "double"), ("Highlights", "DilutedEpsTTM", "diluted_eps_ttm", "double"),
    ("Valuation", "TrailingPE", "trailing_pe", "double"), ("Valuation", "ForwardPE", "forward_pe", "double"), ("Valuation", "PriceSalesTTM", "price_sales_ttm", "double"), ("Valuation", "PriceBookMRQ", "price_book_mrq", "double"),
    ("Valuation", "EnterpriseValue", "enterprise_value", "double"), ("SharesStats", "SharesOutstanding", "shares_outstanding", "double"), ("SharesStats", "SharesFloat", "shares_float", "double"), ("SharesStats", "PercentInsiders", "percent_insiders", "double"),
    ("SharesStats", "PercentInstitutions", "percent_institutions", "double"), ("Technicals", "Beta", "beta", "double"), ("Technicals", "52WeekHigh", "week_52_high", "double"), ("Technicals", "52WeekLow", "week_52_low", "double"),
    ("General", "UpdatedAt", "updated_at", "string"),
)
SECTIONS = MapType(StringType(), MapType(StringType(), StringType()))


def scan(ledger: DataFrame, bodies: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Documents of the ledger's ok rows: (keys, body) of those that hold a JSON object or array, and (keys, reason) of the
    others, for the log. A document that can't be read is passed over, it never ends the job."""
    met = ledger.where("status = 'ok'").select(*keys).distinct().join(bodies.select(*keys, "body"), keys, "left")
    # The engine's parser answers null for what it can't read.
    kind = F.substring(F.ltrim(F.get_json_object("body", "$")), 1, 1)
    reason = F.when(F.col("body").isNull(), "missing").when(kind.isNull() | ~kind.isin("{", "["), "unreadable")
    own = met.withColumn("reason", reason)
    return own.where("reason is null").drop("reason"), own.where("reason is not null").select(*keys, "reason")


def company_facts(docs: DataFrame) -> DataFrame:
    """docs: security_id, api_ticker, body. One row a document that isn't an ETF's: the facts of FACTS as they stand, null where a
    section or key is missing, empty or not of the type. is_delisted is false where it is missing."""
    own = docs.withColumn("_s", F.from_json("body", SECTIONS)).where("_s is not null")
    at = lambda section, key: F.nullif(F.try_element_at(F.try_element_at("_s", F.lit(section)), F.lit(key)), F.lit(""))

    def fact(section, key, kind):
        raw = at(section, key)
        if kind == "boolean":
            return F.coalesce(F.lower(raw).isin("true", "1"), F.lit(False))
        if kind == "long":
            return raw.try_cast("double").try_cast("long")
        return raw if kind == "string" else raw.try_cast(kind)

    facts = own.where(~F.coalesce(at("General", "Type") == "ETF", F.lit(False)))
    return facts.select("security_id", "api_ticker", *(fact(s, k, t).alias(c) for s, k, c, t in FACTS))


def exchanges(docs: DataFrame, snapshot: str) -> DataFrame:
    """docs: body, JSON lists of exchanges. One row for each exchange, as it stands, with the day of the snapshot."""
    own = docs.select(F.try_parse_json("body").alias("v"))
    each = own.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("v").outer()))
    # The documents' keys and the table's columns.
    names = (("Code", "code"), ("Name", "name"), ("OperatingMIC", "operating_mic"), ("Country", "country"), ("Currency", "currency"), ("CountryISO2", "country_iso2"), ("CountryISO3", "country_iso3"))
    return each.select(*(F.try_variant_get("value", f"$.{k}", "string").alias(c) for k, c in names), F.lit(snapshot).cast("date").alias("snapshot_date"))


def coverage(universe: DataFrame, docs: DataFrame) -> DataFrame:
    """One row for each security: what its document holds. universe: security_id, type, is_delisted; docs: security_id, body.

    Periods are the names of the income statement's yearly and quarterly sections, which are data, so the sections are taken apart
    as variants. A security without a document has a row of zeros and nulls; one whose document can't be read has none."""
    own = docs.select("security_id", F.try_parse_json("body").alias("v"), F.octet_length("body").cast("long").alias("doc_bytes"))
    read = own.where("v is not null")

    def names(section: str, *aggs) -> DataFrame:
        part = read.select("security_id", F.try_variant_get("v", section, "variant").alias("part")).where("part is not null")
        return part.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("part").outer())).groupBy("security_id").agg(*aggs)

    income = "$.Financials.Income_Statement"
    annual = names(f"{income}.yearly", F.count("key").alias("n_annual_periods"), F.min("key").alias("first_fiscal_year"), F.max("key").alias("last_fiscal_year"))
    quarterly = names(f"{income}.quarterly", F.count("key").alias("n_quarterly_periods"))
    shares = names("$.outstandingShares.annual", F.count("*").alias("_a")).join(names("$.outstandingShares.quarterly", F.count("*").alias("_q")), "security_id", "full")
    facts = read.select("security_id", "doc_bytes", F.try_variant_get("v", "$.General.UpdatedAt", "string").alias("updated_at"))
    out = universe.join(own.where("v is null").select("security_id"), "security_id", "left_anti")
    for part in (facts, annual, quarterly, shares):
        out = out.join(part, "security_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "security_id", "type", "is_delisted", (F.col("type") == "ETF").alias("is_etf"), (zero("n_annual_periods") > 0).alias("has_financials"), zero("n_annual_periods").alias("n_annual_periods"), zero("n_quarterly_periods").alias("n_quarterly_periods"),
        "first_fiscal_year", "last_fiscal_year", (zero("_a") + zero("_q") > 0).alias("has_shares"), "updated_at", zero("doc_bytes").alias("doc_bytes"),
    )


def block_selector(securities: DataFrame, only: str) -> DataFrame:
    """The securities whose venue, type or "type · venue" is `only`, whatever the case. None of them is an error, raised where the
    rows are read."""
    said = F.lit(only.strip().lower())
    match = (F.lower("venue") == said) | (F.lower("type") == said) | (F.lower(F.concat("type", F.lit(" · "), "venue")) == said)
    own = securities.withColumn("_match", F.coalesce(match, F.lit(False)))
    met = own.agg(F.count_if("_match").alias("_n")).select(F.when(F.col("_n") == 0, F.raise_error(F.lit(f"no block is named {only}"))).otherwise(F.col("_n")).alias("_n"))
    return own.crossJoin(F.broadcast(met)).where("_match and _n > 0").drop("_match", "_n")


def verified(ledger: DataFrame, archive: DataFrame, keys: list[str], full: bool = True) -> DataFrame:
    """outcome (ok, missing, corrupt) and n over the ledger's rows. ledger: keys, sha; archive: keys, body. Without `full` only the
    archive's keys are read: a body that is there is ok."""
    own = archive.select(*keys, (F.sha2("body", 256) if full else F.lit(None).cast("string")).alias("_sha"), F.lit(True).alias("_there"))
    met = ledger.select(*keys, "sha").join(own, keys, "left")
    outcome = F.when(F.col("_there").isNull(), "missing").when(F.lit(not full) | (F.col("_sha") == F.col("sha")), "ok").otherwise("corrupt")
    return met.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
