"""Item master: key resolution, activity, payload parsing, prices, categories, the wide item table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinora.functions import stats
from affinora.operators import ranking

# fixed values: countries of each recommendation region and the region's primary country
REGION_COUNTRIES = {
    "anzs": ["AU", "NZ", "SG"],
    "ca": ["CA"],
    "dach": ["DE", "AT", "CH"],
    "eu": ["ES", "PT", "IT", "SE", "DK", "NO", "FI"],
    "frcen": ["FR", "NL", "BE"],
    "in": ["IN"],
    "uk": ["GB", "UK", "IE"],
    "us": ["US"],
}
PRIMARY_COUNTRY = {"anzs": "AU", "ca": "CA", "dach": "DE", "eu": "IT", "frcen": "FR", "in": "IN", "uk": "GB", "us": "US"}

# fixed values: locales of product copy in order of preference
COPY_LOCALES = ["en-us", "en-ca", "en-gb", "en-ie", "en-au", "en-nz", "en-in", "en-sg"]
ALL_COLORS = "all"


def region_table(spark: SparkSession) -> DataFrame:
    rows = [(c, region, PRIMARY_COUNTRY[region]) for region, countries in REGION_COUNTRIES.items() for c in countries]
    return spark.createDataFrame(rows, "country string, region string, primary_country string")


def region_mapping(countries: DataFrame, column: str = "country") -> DataFrame:
    """Add region and primary country. The table holds 22 fixed rows, so it is broadcast."""
    mapping = F.broadcast(region_table(countries.sparkSession)).withColumnRenamed("country", "_country")
    joined = countries.join(mapping, F.col(column) == F.col("_country"), "left").drop("_country")
    return joined.withColumn("region", F.coalesce("region", F.lower(F.col(column))))


def canonical_country(column: str):
    return F.when(F.col(column) == "UK", "GB").otherwise(F.col(column))


def resolve_key_mapping(live: DataFrame, history: DataFrame) -> DataFrame:
    """(country, product_key) -> item; the live mapping wins over the newest historical one."""
    newest = ranking.latest(history, ["country", "product_key"], [F.desc("valid_from"), F.desc("created_on"), F.asc("item")])
    cols = ["country", "product_key", "item"]
    both = live.select(*cols, F.lit(1).alias("priority")).unionByName(newest.select(*cols, F.lit(2).alias("priority")))
    return ranking.latest(both, ["country", "product_key"], [F.asc("priority"), F.asc("item")])


def latest_active_versions(events: DataFrame) -> DataFrame:
    """Newest status per (product, version), then the newest active and current version per product."""
    state = ranking.latest(events, ["product_key", "product_version"], [F.desc("event_date"), F.desc("seq_no")])
    active = state.filter((F.col("status") == "ACTIVE") & F.col("is_current"))
    return ranking.latest(active, ["product_key"], [F.desc("event_date"), F.desc("product_version")]).select(
        "product_key", "product_version"
    )


def active_items(events: DataFrame, live: DataFrame) -> DataFrame:
    return latest_active_versions(events).join(live.select("product_key", "item", "country"), "product_key")


def all_items(mapping: DataFrame, active: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Every mapped item with its active version, taxonomy and activity flag."""
    version = active.select("country", "product_key", "item", "product_version")
    levels = taxonomy.select("product_key", "category", "subcategory", "product_group")
    joined = mapping.join(version, ["country", "product_key", "item"], "left").join(levels, "product_key", "left")
    return joined.withColumn("is_active", F.col("product_version").isNotNull())


def available_items(payload: DataFrame, keys: str = "product_keys") -> DataFrame:
    listed = F.from_json(F.col(keys), "array<string>")
    return payload.select("country", F.explode(listed).alias("product_key")).distinct().withColumn("is_available", F.lit(True))


_CONSTRAINT = (
    "array<struct<productId:string,productVersion:int,type:string,context:array<struct<key:string,value:string>>,"
    "attributeConstraint:array<struct<attributeKey:string,values:array<struct<stringLiteral:string>>>>>>"
)


def parse_constraints(payload: DataFrame, merchant: str, body: str = "body", color_key: str = "Substrate Color") -> DataFrame:
    """Constraints of the merchant per (product, version, country).

    A constraint without attributes blocks all colours; one with a colour attribute blocks its first
    colour, unless a block on all colours of the same product and country precedes it in the payload.
    The precedence is decided inside the payload array: no shuffle. The outer explode parses each payload
    once (a plain one adds a filter that parses it again).
    """

    def first_value(c, key):
        return F.get(F.filter(c["context"], lambda x: x["key"] == key), F.lit(0))["value"]

    def flat(c, position):
        colors = F.filter(c["attributeConstraint"], lambda a: a["attributeKey"] == color_key)
        first = F.get(F.get(colors, F.lit(0))["values"], F.lit(0))["stringLiteral"]
        return F.struct(
            position.alias("position"), c["productId"].alias("product_key"), c["productVersion"].alias("product_version"),
            c["type"].alias("constraint_type"), F.upper(first_value(c, "Merchant")).alias("merchant"),
            first_value(c, "Country").alias("country"),
            F.when(c["attributeConstraint"].isNull(), F.lit(ALL_COLORS)).otherwise(first).alias("color"),
        )

    rows = F.transform(F.from_json(F.col(body), _CONSTRAINT), flat)
    rows = F.filter(rows, lambda r: (r["merchant"] == merchant.upper()) & r["country"].isNotNull() & r["color"].isNotNull())
    kept = F.filter(
        F.col("_rows"),
        lambda r: (r["color"] == ALL_COLORS)
        | ~F.exists(
            F.col("_rows"),
            lambda e: (e["position"] < r["position"]) & (e["color"] == ALL_COLORS)
            & (e["product_key"] == r["product_key"]) & (e["country"] == r["country"]),
        ),
    )
    return (
        payload.select(rows.alias("_rows")).select(F.explode_outer(kept).alias("r")).filter("r is not null")
        .select("r.product_key", "r.product_version", "r.country", "r.constraint_type", "r.color").distinct()
    )


def fully_constrained(constraints: DataFrame) -> DataFrame:
    return (
        constraints.filter(F.col("color") == ALL_COLORS).select("country", "product_key", "product_version").distinct()
        .withColumn("is_constrained", F.lit(True))
    )


def accessory_flags(payload: DataFrame, body: str = "body") -> DataFrame:
    """1 when the accessory service returned a non-empty answer."""
    answer = F.from_json(F.col(body), "array<map<string,string>>")
    return payload.select("product_key", F.coalesce((F.size(answer) > 0).cast("int"), F.lit(0)).alias("is_accessory"))


def logomaker_flags(payload: DataFrame, items: str = "items") -> DataFrame:
    listed = F.from_json(F.col(items), "array<bigint>")
    return payload.select(F.upper("country").alias("country"), F.explode(listed).alias("item")).distinct().withColumn(
        "is_logomaker_enabled", F.lit(1)
    )


def merchandise_dates(mapping: DataFrame, launches: DataFrame, as_of: str) -> DataFrame:
    """First day an item could be sold per (item, country), with source, age in days and epoch seconds."""
    launch = launches.select("product_key", canonical_country("country").alias("country"), "launch_date")
    grouped = (
        mapping.select("item", "product_key", "country", "valid_from").join(launch, ["product_key", "country"], "left")
        .groupBy("item", "country")
        .agg(F.min("launch_date").alias("min_launch_date"), F.min(F.to_date("valid_from")).alias("min_valid_from"))
    )
    by_mapping = F.coalesce("min_launch_date", F.lit("1900-01-01").cast("date")) < F.col("min_valid_from")
    dated = grouped.select(
        "item", "country", "min_launch_date", "min_valid_from",
        F.when(by_mapping, F.col("min_valid_from")).otherwise(F.col("min_launch_date")).alias("merchandise_date"),
        F.when(by_mapping, "mapping_valid_from").otherwise("product_launch").alias("merchandise_date_source"),
    )
    return dated.select(
        "*", F.datediff(F.lit(as_of).cast("date"), "merchandise_date").alias("days_since_merchandisable"),
        F.unix_timestamp(F.col("merchandise_date").cast("timestamp")).alias("creation_timestamp"),
    )


_OFFER = "selectedAttributes map<string,string>, quantitiesSummary struct<moq:int>"
_PRICE = (
    "fractionDigits int, currency string, "
    "prices array<struct<itemTotals:struct<total:struct<listUntaxed:double>,unit:struct<listUntaxed:double>>>>"
)


def moq_prices(offers: DataFrame, items: DataFrame, countries: DataFrame) -> DataFrame:
    """Price at the minimum order quantity, asked in the region's primary country, valid in all its countries.

    An answer without both totals gives a row of nulls.
    """
    first = ranking.latest(offers, ["product_key", "country"], [F.asc("seq_no")])
    primary = countries.select("region", F.col("primary_country").alias("country")).distinct()
    wanted = items.select("product_key", "country").join(primary, "country").distinct()
    offer, price = F.from_json("offer", _OFFER), F.from_json("price", _PRICE)
    parsed = first.join(wanted, ["product_key", "country"]).select(
        "product_key", "region", F.coalesce(offer["quantitiesSummary"]["moq"], F.lit(1)).alias("moq"), price.alias("p")
    )
    totals = F.get("p.prices", F.lit(0))["itemTotals"]
    amounts = parsed.select(
        "product_key", "region", "moq", F.col("p.currency").alias("currency"),
        stats.minor_to_major(totals["total"]["listUntaxed"], F.col("p.fractionDigits")).alias("total_moq_price"),
        stats.minor_to_major(totals["unit"]["listUntaxed"], F.col("p.fractionDigits")).alias("unit_moq_price"),
    )
    answered = F.col("total_moq_price").isNotNull() & F.col("unit_moq_price").isNotNull()
    rows = amounts.select(
        "product_key", "region",
        *[F.when(answered, F.col(c)).alias(c) for c in ("moq", "currency", "total_moq_price", "unit_moq_price")],
    )
    return rows.join(countries.select("region", "country"), "region")


def missing_descriptions(active: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Active keys that have no description yet."""
    return active.select(*keys).distinct().join(known.select(*keys), keys, "left_anti")


def pick_locale(payload: DataFrame, body: str = "body", locales: list[str] | None = None) -> DataFrame:
    """Headline, description and highlights of the first preferred locale with content."""
    copy = "struct<headline:string,description:string,highlights:string>"
    parsed = F.from_json(F.col(body), f"data struct<locales:map<string,{copy}>>")
    by_locale = F.map_filter(
        parsed["data"]["locales"],
        lambda _, v: v.isNotNull() & F.coalesce(v["headline"], v["description"], v["highlights"]).isNotNull(),
    )
    chosen = F.coalesce(*[F.try_element_at(F.col("_by"), F.lit(x)) for x in locales or COPY_LOCALES])
    rest = [c for c in payload.columns if c != body]
    return payload.select(*rest, by_locale.alias("_by")).select(*rest, chosen.alias("_copy")).select(
        *rest, F.col("_copy.headline").alias("headline"), F.col("_copy.description").alias("description"),
        F.col("_copy.highlights").alias("highlights"),
    )


def site_categories(payload: DataFrame, body: str = "body") -> DataFrame:
    """Category and parent category of each product; the parent is looked up inside the same country."""
    nodes = payload.select(
        "country", F.explode(F.from_json(F.col(body), "array<struct<id:string,parentId:string,type:string>>")).alias("n")
    ).select("country", "n.*")
    parents = nodes.filter("type = 'category'").groupBy("country", F.col("id").alias("site_category")).agg(
        F.max("parentId").alias("parent_site_category")
    )
    products = nodes.filter("type = 'product'").select(
        "country", F.col("id").alias("item"), F.col("parentId").alias("site_category")
    ).distinct()
    return products.join(parents, ["country", "site_category"], "left")


def base_items(
    active: DataFrame, constrained: DataFrame, available: DataFrame, categories: DataFrame, accessories: DataFrame,
    logomaker: DataFrame, taxonomy: DataFrame, countries: DataFrame, prices: DataFrame, dates: DataFrame,
    excluded_categories: list[str],
) -> DataFrame:
    """Sellable items per country: active, not fully constrained, available, categorised."""
    levels = taxonomy.filter(~F.col("category").isin(excluded_categories)).select(
        "product_key", "category", "subcategory", "product_group"
    )
    price_cols = ["moq", "currency", "total_moq_price", "unit_moq_price"]
    regional = prices.select("product_key", "region", *price_cols).distinct()
    return (
        active.join(constrained, ["product_key", "product_version", "country"], "left_anti")
        .join(available, ["country", "product_key"], "left_semi")
        .join(categories, ["item", "country"])
        .join(accessories, "product_key")
        .join(logomaker, ["item", "country"], "left")
        .withColumn("is_logomaker_enabled", F.coalesce("is_logomaker_enabled", F.lit(0)))
        .join(levels, "product_key")
        .join(countries.select("country", "region", "primary_country"), "country")
        .join(regional, ["product_key", "region"], "left")
        .join(dates, ["item", "country"], "left")
    )


def all_features(
    items: DataFrame, countries: DataFrame, by_item: list[DataFrame], by_product: list[DataFrame],
    by_version: list[DataFrame], by_product_country: list[DataFrame], by_version_country: list[DataFrame],
    regional: list[DataFrame], defaults: dict[str, object],
) -> DataFrame:
    """Wide item table: left joins of every feature frame, defaults for missing flags.

    The join keys come in five groups, so Spark keeps the item side hashed on one key while it joins
    the frames of a group. Regional features fan out to the region's countries first.
    """
    wide = items
    region = countries.select("country", "region")
    fanned = [r.join(region, "region").drop("region") for r in regional]
    for on, frames in (
        (["product_key"], by_product),
        (["product_key", "product_version"], by_version),
        (["product_key", "product_version", "country"], by_version_country),
        (["product_key", "country"], by_product_country),
        (["item", "country"], by_item + fanned),
    ):
        for frame in frames:
            wide = wide.join(frame, on, "left")
    return wide.na.fill({k: v for k, v in defaults.items()})
