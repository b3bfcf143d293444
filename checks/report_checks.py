"""Report files, royalty report and artist ranking on the stand-in records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, table
from checks.standins import (
    CLAIMANT,
    EXACT,
    claims,
    merged_sql,
    quarter_col,
    recordings,
    report_records,
    sales,
    service_col,
    block_records,
    summary_rows,
    with_records,
)
from staveline.functions.numbers import whole_units
from staveline.functions.text import clean_song_code, country_of_sale, distribution_description
from staveline.operators.frames import dedupe
from staveline.operators.royalty import claims_of, pool, royalty_rows
from staveline.operators.usage import (
    artist_maxima,
    artist_stats,
    artist_totals,
    block_join,
    merged_usage,
    residual_totals,
    with_artists,
)
from staveline.plans.ranking import (
    RankingTerms,
    artist_statistics,
    top_artist_songs,
    top_residual_artists,
)
from staveline.plans.report import (
    ReportTerms,
    distinct_rows,
    own_claims,
    royalty_report,
    with_usage_share,
)
from staveline.session import settled
from staveline.sources.dsr import (
    parse_lines,
    record_counts,
    route,
    split_bad_rows,
    summaries,
    to_lines,
    typed_records,
)
from staveline.sources.layouts import LAYOUTS
from staveline.streaming.intake import missing_services

# Payee, store and currency of the report; free to choose.
SHOP = ("YOUTUBE", "youtube_comp", "USD")
TERMS = ReportTerms(CLAIMANT, *SHOP, money_type=EXACT)
TOP = RankingTerms(k=20, money_type=EXACT)

FILE_NAMES = {
    "ads": "ads", "hardware": "hardware", "subs_music": "subscriptionmusic",
    "subs_premium": "subscriptionpremium",
}


def _file_name(service: str = "service", quarter: str = "Quarter"):
    name = F.lit("")
    for short, long in FILE_NAMES.items():
        name = F.when(F.col(service) == short, long).otherwise(name)
    return F.concat(F.lit("dsr/"), F.col(quarter), F.lit("/Report_"), name, F.lit(".tsv"))


def _as_lines(records: DataFrame, code: str) -> DataFrame:
    return to_lines(records, code).select("value", _file_name().alias("file"))


def _padded(records: DataFrame, code: str) -> DataFrame:
    """Fields the stand-in does not have become NULL."""
    have = set(records.columns)
    missing = {
        f.name: F.lit(None).cast(f.type) for f in LAYOUTS[code] if f.name not in have
    }
    return records.withColumns(missing) if missing else records


@check("dsr_parse_roundtrip", with_records("""
SELECT service, "Quarter", "BlockId", "RightsController", "PUBLISHERS_SONGCODE",
    "RightSharePercent", "RightsType", "AllocatedNetRevenue", "AllocatedAmount",
    "AllocatedUsages", "ParentSalesTransactionId"
FROM li"""))
def dsr_parse_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    lines = _as_lines(claims(spark, sf), "LI01.03")
    return typed_records(parse_lines(lines), "LI01.03").select(
        "service", "Quarter", "BlockId", "RightsController", "PUBLISHERS_SONGCODE",
        "RightSharePercent", "RightsType", "AllocatedNetRevenue", "AllocatedAmount",
        "AllocatedUsages", "ParentSalesTransactionId",
    )


def _all_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every record code: the four stand-ins, and eight codes made from orders."""
    lines = _as_lines(claims(spark, sf), "LI01.03")
    for code, frame in (("SU03.02", sales), ("AS01.02", recordings)):
        lines = lines.unionByName(_as_lines(frame(spark, sf), code))
    wide = _padded(summary_rows(spark, sf), "SY05.03")
    lines = lines.unionByName(_as_lines(wide, "SY05.03"))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("BlockId"),
        F.date_format("o_orderdate", "yyyy-MM-dd").cast("date").alias("UsageStartDate"),
        service_col(F.col("o_orderkey")).alias("service"),
        quarter_col(F.col("o_orderdate")).alias("Quarter"),
        (F.col("o_orderkey") % 8).alias("__kind"),
    )
    others = ["HEAD", "SY02.03", "RU01.02", "MW01.02", "LC01", "SY04.02", "SY09.01", "ST01"]
    for kind, code in enumerate(others):
        rows = _padded(orders.where(F.col("__kind") == kind), code)
        lines = lines.unionByName(_as_lines(rows, code))
    return lines


@check("dsr_record_counts", with_records("""
SELECT service, "Quarter" AS quarter, record_type, count(*) AS records FROM (
    SELECT service, "Quarter", 'LI01.03' AS record_type FROM li
    UNION ALL SELECT service, "Quarter", 'SU03.02' FROM su
    UNION ALL SELECT service, "Quarter", 'AS01.02' FROM as_
    UNION ALL SELECT service, "Quarter", 'SY05.03' FROM sy
    UNION ALL SELECT CASE o_orderkey % 4 WHEN 0 THEN 'ads' WHEN 1 THEN 'hardware'
            WHEN 2 THEN 'subs_music' ELSE 'subs_premium' END,
        CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR),
        CASE o_orderkey % 8 WHEN 0 THEN 'HEAD' WHEN 1 THEN 'SY02.03' WHEN 2 THEN 'RU01.02'
            WHEN 3 THEN 'MW01.02' WHEN 4 THEN 'LC01' WHEN 5 THEN 'SY04.02' WHEN 6 THEN 'SY09.01'
            ELSE 'ST01' END
    FROM orders
) GROUP BY ALL"""))
def dsr_record_counts(spark: SparkSession, sf: str) -> DataFrame:
    return record_counts(parse_lines(_all_lines(spark, sf)))


def _generated(code: str) -> dict[str, Column]:
    """Values for all fields of a layout, made from an order."""
    key = F.col("o_orderkey")
    make = {
        "string": lambda i: F.concat(F.lit(f"{i}_"), key.cast("string")),
        "date": lambda i: F.col("o_orderdate").cast("date"),
        "long": lambda i: F.when(key % 3 > 0, key + i),
        "double": lambda i: F.col("o_totalprice") * i,
    }
    return {f.name: make[f.type](i) for i, f in enumerate(LAYOUTS[code], start=1)}


def _generated_sql(code: str) -> str:
    make = {
        "string": "'{0}_' || CAST(o_orderkey AS VARCHAR)",
        "date": "strftime(o_orderdate, '%Y-%m-%d')",
        "long": "CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey + {0} END",
        "double": "o_totalprice * {0}",
    }
    return ", ".join(
        f'{make[f.type].format(i)} AS "{f.name}"' for i, f in enumerate(LAYOUTS[code], start=1)
    )


def _register_layout(code: str) -> None:
    sql = _generated_sql(code)

    @check(f"records_{code.lower().replace('.', '')}", f"""
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'ads' WHEN 1 THEN 'hardware'
        WHEN 2 THEN 'subs_music' ELSE 'subs_premium' END AS service,
    CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
        AS "Quarter", {sql} FROM orders""")
    def records_of_code(spark: SparkSession, sf: str) -> DataFrame:
        values = _generated(code)
        rows = table(spark, sf, "orders").select(
            service_col(F.col("o_orderkey")).alias("service"),
            quarter_col(F.col("o_orderdate")).alias("Quarter"),
            *[value.alias(name) for name, value in values.items()],
        )
        typed = typed_records(parse_lines(_as_lines(rows, code)), code)
        dates = {f.name: F.col(f.name).cast("string") for f in LAYOUTS[code] if f.type == "date"}
        return typed.withColumns(dates) if dates else typed


for _code in LAYOUTS:
    _register_layout(_code)


@check("dsr_variant_summary", """
SELECT service, "Quarter", "SummaryRecordId", "TotalUsages", "Users", "NetRevenue",
    "AllocatedRevenue", "ParentSummaryRecordId"
FROM (
    SELECT CASE o_orderkey % 4 WHEN 0 THEN 'ads' WHEN 1 THEN 'hardware'
            WHEN 2 THEN 'subs_music' ELSE 'subs_premium' END AS service,
        CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
            AS "Quarter",
        CAST(o_orderkey AS VARCHAR) AS "SummaryRecordId", o_custkey AS "TotalUsages",
        CASE WHEN o_orderkey % 4 < 2 THEN NULL ELSE o_custkey + 1 END AS "Users",
        CASE WHEN o_orderkey % 4 < 2 THEN NULL ELSE o_totalprice END AS "NetRevenue",
        o_totalprice AS "AllocatedRevenue",
        CASE WHEN o_orderkey % 4 < 2 THEN 'parent' END AS "ParentSummaryRecordId"
    FROM orders
)""")
def dsr_variant_summary(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    rows = orders.select(
        service_col(F.col("o_orderkey")).alias("service"),
        quarter_col(F.col("o_orderdate")).alias("Quarter"),
        F.col("o_orderkey").cast("string").alias("SummaryRecordId"),
        F.col("o_custkey").alias("TotalUsages"),
        (F.col("o_custkey") + 1).alias("Users"),
        F.col("o_totalprice").alias("NetRevenue"),
        F.col("o_totalprice").alias("AllocatedRevenue"),
        F.lit("parent").alias("ParentSummaryRecordId"),
    )
    first = F.col("service").isin("ads", "hardware")
    wide = _as_lines(_padded(rows.where(first), "SY05.03"), "SY05.03")
    narrow = _as_lines(_padded(rows.where(~first), "SY02.03"), "SY02.03")
    return summaries(parse_lines(wide.unionByName(narrow))).select(
        "service", "Quarter", "SummaryRecordId", "TotalUsages", "Users", "NetRevenue",
        "AllocatedRevenue", "ParentSummaryRecordId",
    )


@check("route_files", """
SELECT name, CASE o_orderkey % 5 WHEN 0 THEN 'ads' WHEN 1 THEN 'hardware'
        WHEN 2 THEN 'subs_music' WHEN 3 THEN 'subs_premium' ELSE '' END AS service,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL
        ELSE CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
        END AS quarter
FROM (
    SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'uploads/'
            || CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
            || '/' END
        || CASE o_orderkey % 5 WHEN 0 THEN 'Ads' WHEN 1 THEN 'HardWare'
            WHEN 2 THEN 'SubscriptionMusic' WHEN 3 THEN 'SubscriptionPremium' ELSE 'other' END
        || '_' || CAST(o_orderkey AS VARCHAR) || '.tsv' AS name
    FROM orders
)""")
def route_files(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.array(
        *[F.lit(x) for x in ("Ads", "HardWare", "SubscriptionMusic", "SubscriptionPremium", "other")]
    )
    folder = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(
        F.concat(F.lit("uploads/"), quarter_col(F.col("o_orderdate")), F.lit("/"))
    )
    names = table(spark, sf, "orders").select(
        F.concat(
            folder, F.get(kinds, (F.col("o_orderkey") % 5).cast("int")), F.lit("_"),
            F.col("o_orderkey").cast("string"), F.lit(".tsv"),
        ).alias("name")
    )
    where = route(F.col("name"))
    return names.select("name", where["service"].alias("service"), where["quarter"].alias("quarter"))


@check("bad_rows", """
SELECT CASE WHEN l_partkey % 10 IN (0, 1) THEN 'bad' ELSE 'good' END AS verdict,
    count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts
FROM lineitem GROUP BY ALL""")
def bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("l_partkey") % 10
    part = F.col("l_partkey").cast("string")
    fields = (
        F.when(kind == 0, F.concat_ws("\t", F.lit("ST01"), F.lit("B"), part))
        .when(kind == 1, F.concat_ws("\t", F.lit("ST01"), F.lit("B"), part, F.lit("S"), F.lit("7"),
                                     F.lit("extra")))
        .when(kind == 2, F.concat(F.concat_ws("\t", F.lit("ST01"), F.lit("B"), part, F.lit("S"),
                                              F.lit("7")), F.lit("\t\t\t")))
        .otherwise(F.concat_ws("\t", F.lit("ST01"), F.lit("B"), part, F.lit("S"), F.lit("7")))
    )
    lines = table(spark, sf, "lineitem").select(
        fields.alias("value"), F.lit("dsr/2024_Q1/ads.tsv").alias("file")
    )
    good, bad = split_bad_rows(parse_lines(lines))

    def counted(df: DataFrame, verdict: str) -> DataFrame:
        return df.groupBy(F.lit(verdict).alias("verdict")).agg(
            F.count("*").alias("n"), F.sum(F.get("f", F.lit(2)).cast("long")).alias("parts")
        )

    return counted(good, "good").unionByName(counted(bad, "bad"))


@check("claim_filter", with_records("""
SELECT service, "Quarter", "BlockId", "ParentSalesTransactionId", "AllocatedUsages"
FROM li WHERE "RightsController" = 'PubA' AND "RightsType" = 'MechanicalRight'"""))
def claim_filter(spark: SparkSession, sf: str) -> DataFrame:
    return claims_of(claims(spark, sf), CLAIMANT).select(
        "service", "Quarter", "BlockId", "ParentSalesTransactionId", "AllocatedUsages"
    )


ROYALTY_JOIN_SQL = """
joined AS (
    SELECT DISTINCT l.service, l."Quarter", l."BlockId", s."SalesTransactionId", s."DspResourceId",
        "RightsController", "PUBLISHERS_SONGCODE", "RightSharePercent", "AllocatedNetRevenue",
        "AllocatedAmount", "AllocatedUsages", "Usages", "NetRevenue", "ValidityPeriodStart",
        "DATE_SALE", "ResourceISRC", "ResourceTitle", "ResourceDisplayArtistName"
    FROM li l
    JOIN su s ON l.service = s.service AND l."BlockId" = s."BlockId"
        AND l."ParentSalesTransactionId" = s."SalesTransactionId" AND l."Quarter" = s."Quarter"
    JOIN as_ a ON l.service = a.service AND l."BlockId" = a."BlockId"
        AND s."DspResourceId" = a."DspResourceId" AND s."Quarter" = a."Quarter"
    WHERE "RightsController" = 'PubA' AND "RightsType" = 'MechanicalRight'
),
scoped AS (
    SELECT service, "Quarter",
        sum(CAST("AllocatedUsages" AS DECIMAL(28,4))) AS usages
    FROM li WHERE "RightsController" = 'PubA' AND "RightsType" = 'MechanicalRight' GROUP BY ALL
),
income AS (
    SELECT service, "Quarter", sum(CAST("AllocatedRevenue" AS DECIMAL(28,4))) AS amount
    FROM sy WHERE "RightsController" = 'PubA' GROUP BY ALL
),
paid AS (
    SELECT service, "Quarter", sum(CAST("AllocatedAmount" AS DECIMAL(28,4))) AS amount
    FROM li WHERE "RightsController" = 'PubA' GROUP BY ALL
),
rows_ AS (
    SELECT DISTINCT * EXCLUDE ("SalesTransactionId", "DspResourceId"),
        NULLIF(split_part("SalesTransactionId", ':', 2), '') AS "COUNTRY_OF_SALE"
    FROM joined
)
"""


def _scalars_sql(by_quarter: bool) -> str:
    def total(name: str, source: str, value: str, out: str) -> str:
        keys = 'service, "Quarter"' if by_quarter else "service"
        return f"{name} AS (SELECT {keys}, sum({value}) AS {out} FROM {source} GROUP BY ALL)"

    return ",".join([
        total("usages_total", "scoped", "usages", "value"),
        total("income_total", "income", "amount", "value"),
        total("paid_total", "paid", "amount", "value"),
    ])


def _report_sql(columns: str, by_quarter: bool = False) -> str:
    also = ' AND r."Quarter" = {0}."Quarter"' if by_quarter else ""

    def on(alias: str) -> str:
        return f"r.service = {alias}.service" + also.format(alias)

    return with_records(f"""
SELECT {columns} FROM (
    SELECT r.*, CAST(i.value - p.value AS DOUBLE) AS pool,
        "AllocatedUsages" / NULLIF(CAST(u.value AS DOUBLE), 0) AS "UsagesShare"
    FROM rows_ r LEFT JOIN usages_total u ON {on("u")} LEFT JOIN income_total i ON {on("i")}
    LEFT JOIN paid_total p ON {on("p")}
) r""", ROYALTY_JOIN_SQL, _scalars_sql(by_quarter))


REPORT_COLUMNS = """
    service, "BlockId", "ResourceISRC" AS "ISRC", "ResourceTitle" AS "SONG_TITLE",
    "ResourceDisplayArtistName", "Quarter", "Usages", "NetRevenue", "ValidityPeriodStart",
    "DATE_SALE", "RightsController",
    CASE WHEN "PUBLISHERS_SONGCODE" LIKE 'C_%' THEN replace("PUBLISHERS_SONGCODE", 'C_', '')
        ELSE "PUBLISHERS_SONGCODE" END AS "PUBLISHERS_SONGCODE",
    "RightSharePercent", "AllocatedNetRevenue", "AllocatedAmount", "AllocatedUsages",
    "UsagesShare", 'YOUTUBE' AS "PAYEE",
    'YOUTUBE ' || upper(service) || ' ' || "Quarter" AS "Distribution_Description",
    'youtube_comp' AS "STORE_ID", "COUNTRY_OF_SALE", 'USD' AS "CURRENCY",
    pool * "UsagesShare" AS "GEPaymentsShare",
    pool * "UsagesShare" + "AllocatedAmount" AS "ROYALTIES_TO_BE_PAID",
    CAST(ceil("AllocatedUsages") AS BIGINT) AS "TOTAL_UNITS"
"""


@check("royalty_join", with_records("SELECT * FROM joined", ROYALTY_JOIN_SQL))
def royalty_join(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    return royalty_rows(claims_of(own_claims(r.li, TERMS), CLAIMANT), r.su, r.as_)


@check("royalty_rows_distinct", with_records("SELECT * FROM rows_", ROYALTY_JOIN_SQL))
def royalty_rows_distinct(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    return distinct_rows(own_claims(r.li, TERMS), r.su, r.as_, TERMS)


@check("usage_share", _report_sql("""service, "BlockId", "ResourceISRC", "AllocatedUsages",
    "RightSharePercent", "UsagesShare" """))
def usage_share(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    own = own_claims(r.li, TERMS)
    rows = with_usage_share(distinct_rows(own, r.su, r.as_, TERMS), own, TERMS)
    return rows.select(
        "service", "BlockId", "ResourceISRC", "AllocatedUsages", "RightSharePercent", "UsagesShare"
    )


@check("pool_share", with_records("""
SELECT service, CAST(i.value - p.value AS DOUBLE) AS "Pool"
FROM income_total i FULL JOIN paid_total p USING (service)""", ROYALTY_JOIN_SQL, _scalars_sql(False)))
def pool_share(spark: SparkSession, sf: str) -> DataFrame:
    return pool(summary_rows(spark, sf), claims(spark, sf), CLAIMANT, money_type=EXACT)


@check("royalty_report", _report_sql(REPORT_COLUMNS))
def royalty_report_all(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    return royalty_report(r.sy, r.li, r.su, r.as_, TERMS)


@check("royalty_report_by_quarter", _report_sql(REPORT_COLUMNS, by_quarter=True))
def royalty_report_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    terms = ReportTerms(CLAIMANT, *SHOP, money_type=EXACT, by_quarter=True)
    return royalty_report(r.sy, r.li, r.su, r.as_, terms)


@check("country_of_sale", with_records("""
SELECT "SalesTransactionId", NULLIF(split_part("SalesTransactionId", ':', 2), '')
    AS "COUNTRY_OF_SALE" FROM su"""))
def country(spark: SparkSession, sf: str) -> DataFrame:
    return sales(spark, sf).select(
        "SalesTransactionId",
        country_of_sale(F.col("SalesTransactionId")).alias("COUNTRY_OF_SALE"),
    )


@check("distribution_description", with_records("""
SELECT "BlockId", 'YOUTUBE ' || upper(service) || ' ' || "Quarter" AS "Distribution_Description",
    'YOUTUBE' AS "PAYEE", 'youtube_comp' AS "STORE_ID", 'USD' AS "CURRENCY" FROM li"""))
def description(spark: SparkSession, sf: str) -> DataFrame:
    text = distribution_description(F.col("service"), F.col("Quarter"))
    return claims(spark, sf).select(
        "BlockId", text.alias("Distribution_Description"), F.lit(TERMS.payee).alias("PAYEE"),
        F.lit(TERMS.store_id).alias("STORE_ID"), F.lit(TERMS.currency).alias("CURRENCY"),
    )


@check("song_code_clean", """
SELECT code, CASE WHEN code LIKE 'C_%' THEN replace(code, 'C_', '') ELSE code END AS cleaned,
    CASE WHEN code LIKE 'C\\_%' ESCAPE '\\' THEN substr(code, 3) ELSE code END AS cleaned_at_start
FROM (
    SELECT c_name AS code FROM customer
    UNION ALL SELECT 'C_' || c_custkey || 'C_' FROM customer
    UNION ALL SELECT 'CAC_' || c_custkey FROM customer
    UNION ALL SELECT 'X_' || c_custkey FROM customer
)""")
def song_code(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    codes = table(spark, sf, "customer").select(
        F.explode(F.array(
            F.col("c_name"), F.concat(F.lit("C_"), key, F.lit("C_")),
            F.concat(F.lit("CAC_"), key), F.concat(F.lit("X_"), key),
        )).alias("code")
    )
    return codes.select(
        "code", clean_song_code(F.col("code")).alias("cleaned"),
        clean_song_code(F.col("code"), strict_prefix=True).alias("cleaned_at_start"),
    )


@check("total_units", with_records("""
SELECT "BlockId", "AllocatedUsages", CAST(ceil("AllocatedUsages") AS BIGINT) AS "TOTAL_UNITS"
FROM li"""))
def total_units(spark: SparkSession, sf: str) -> DataFrame:
    return claims(spark, sf).select(
        "BlockId", "AllocatedUsages", whole_units(F.col("AllocatedUsages")).alias("TOTAL_UNITS")
    )


@check("block_join", with_records("""
SELECT a.service, a."Quarter", a."BlockId", count(DISTINCT ("ResourceISRC",
        "SalesTransactionId", "RightsController", "RightSharePercent")) AS pairs,
    CAST(sum(CAST("AllocatedUsages" AS DECIMAL(28,4))) AS DOUBLE) AS "AUsages",
    CAST(sum(CAST("Usages" AS DECIMAL(28,4))) AS DOUBLE) AS "Usages"
FROM as_ a
JOIN su s ON a.service = s.service AND a."BlockId" = s."BlockId" AND a."Quarter" = s."Quarter"
JOIN li l ON a.service = l.service AND a."BlockId" = l."BlockId" AND a."Quarter" = l."Quarter"
    AND l."ParentSalesTransactionId" = s."SalesTransactionId"
WHERE "RightsType" = 'MechanicalRight' GROUP BY ALL"""))
def blocks(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    return block_join(r.as_, r.su, r.li, EXACT).groupBy("service", "Quarter", "BlockId").agg(
        F.count("*").alias("pairs"),
        F.sum("AUsages").cast("double").alias("AUsages"),
        F.sum("Usages").cast("double").alias("Usages"),
    )


@check("merged_usage", with_records("SELECT * FROM merged", merged_sql()))
def merged(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    return merged_usage(r.as_, r.su, r.li, money_type=EXACT)


COMPAT_SQL = """
read_twice AS (
    SELECT * FROM as_ WHERE service IN ('ads', 'subs_music', 'subs_premium')
    UNION ALL SELECT * FROM as_ WHERE service = 'ads'
)"""


@check("merged_usage_compat", with_records(
    "SELECT * FROM merged", COMPAT_SQL, merged_sql("read_twice")
))
def merged_compat(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    return merged_usage(r.as_, r.su, r.li, current_service="ads", money_type=EXACT)


@check("split_artists", with_records("""
SELECT "BlockId", "ResourceISRC", trim(value) AS "Artist" FROM (
    SELECT *, unnest(regexp_split_to_array(lower("ResourceDisplayArtistName"),
        '[,;/|&+]|\\s(?:feat\\.|ft\\.|featuring|vs\\.)\\s')) AS value
    FROM as_ WHERE "ResourceDisplayArtistName" IS NOT NULL
) WHERE value <> '-'"""))
def artists_of_recordings(spark: SparkSession, sf: str) -> DataFrame:
    return with_artists(recordings(spark, sf)).select("BlockId", "ResourceISRC", "Artist")


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    return artist_statistics(r.as_, r.su, r.li, TOP)


@check("artist_totals", with_records("SELECT * FROM totals", merged_sql()))
def totals(spark: SparkSession, sf: str) -> DataFrame:
    return artist_totals(_stats(spark, sf))


@check("artist_stats", with_records("""
SELECT t.*, r.* EXCLUDE ("Artist", "ResidualObservations"),
    coalesce("ResidualObservations", 0) AS "ResidualObservations",
    "ResidualObservations" IS NOT NULL AS "HasResidual"
FROM totals t LEFT JOIN residual r ON r."Artist" = t."Artist"
""", merged_sql()))
def stats_of_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The same statistics from the merged table itself."""
    r = report_records(spark, sf)
    return artist_stats(merged_usage(r.as_, r.su, r.li, money_type=EXACT), EXACT)


@check("residual_totals", with_records("SELECT * FROM residual", merged_sql()))
def residuals(spark: SparkSession, sf: str) -> DataFrame:
    return residual_totals(_stats(spark, sf))


@check("artist_maxima", with_records("""
SELECT max("ResidualObservations") AS "MaxResidualObservations",
    max("ResidualTotalUsages") AS "MaxResidualTotalUsages" FROM residual""", merged_sql()))
def maxima(spark: SparkSession, sf: str) -> DataFrame:
    return artist_maxima(_stats(spark, sf))


RANKED = 'ranked20 AS (SELECT * FROM ranked ORDER BY "ArtistIndex" DESC, "Artist" LIMIT 20)'


@check("top_residual_artists", with_records("SELECT * FROM ranked20", merged_sql(), RANKED))
def top(spark: SparkSession, sf: str) -> DataFrame:
    r = report_records(spark, sf)
    return top_residual_artists(r.as_, r.su, r.li, TOP)


@check("top_artist_songs", with_records(
    'SELECT * FROM split WHERE "Artist" IN (SELECT "Artist" FROM ranked20)', merged_sql(), RANKED
))
def songs(spark: SparkSession, sf: str) -> DataFrame:
    r = block_records(spark, sf)
    # The ranking is read for its songs and again to tell whose they are.
    best = settled(top_residual_artists(r["as_"], r["su"], r["li"], TOP), "top-artists")
    return top_artist_songs(best, r["as_"], r["su"], r["li"], TOP)


@check("summary_dedupe", with_records('SELECT DISTINCT * FROM sy'))
def summary_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    rows = summary_rows(spark, sf).drop("SummaryRecordId")
    return dedupe(rows.unionByName(rows))


@check("missing_services", """
SELECT "Quarter" AS quarter, array_to_string(list_filter(['ads', 'hardware', 'subs_premium',
    'subs_music'], lambda s: NOT list_contains(seen, s)), ',') AS missing
FROM (
    SELECT CAST(year(o_orderdate) AS VARCHAR) || '_Q' || CAST(quarter(o_orderdate) AS VARCHAR)
            AS "Quarter",
        list(CASE WHEN o_orderkey % 4 = 0 THEN 'ads'
            WHEN o_orderkey % 4 = 1 AND month(o_orderdate) >= 7 THEN 'hardware'
            WHEN o_orderkey % 4 = 2 THEN 'subs_music'
            WHEN o_orderkey % 4 = 3 THEN 'subs_premium' END) AS seen
    FROM orders GROUP BY 1
)""")
def gate(spark: SparkSession, sf: str) -> DataFrame:
    late = (F.col("o_orderkey") % 4 == 1) & (F.month("o_orderdate") < 7)
    files = table(spark, sf, "orders").select(
        F.when(~late, service_col(F.col("o_orderkey"))).alias("service"),
        quarter_col(F.col("o_orderdate")).alias("quarter"),
    )
    return missing_services(files).select(
        "quarter", F.array_join("missing", ",").alias("missing")
    )
