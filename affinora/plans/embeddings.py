"""Product configurations: assembly, identity, constraints, cleaning, sentences, vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora import config
from affinora.functions import color, text, vector
from affinora.operators import ranking

ALL_COLORS = "ALL"


def pivot_attributes(attributes: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Long attributes as one column per name (smallest value wins)."""
    return attributes.groupBy(*keys).pivot("property_name", names).agg(F.min("property_value"))


_ENUMERATION = (
    "userSelections map<string,string>, quantities array<int>, updatedAt string, "
    "listPrices array<struct<market:string,currency:string,merchantId:string,prices:map<string,struct<unitListPrice:struct<untaxed:double>>>>>"
)


def list_prices(enumerations: DataFrame, merchant: str, body: str = "body") -> DataFrame:
    """Newest price list of the merchant per (product, market, selections), with minimum quantity and its unit price."""
    parsed = enumerations.select("product_key", "product_version", F.from_json(body, _ENUMERATION).alias("e"))
    flat = parsed.select(
        "product_key", "product_version", F.col("e.userSelections").alias("selections"), F.array_min("e.quantities").alias("quantities_min"),
        F.to_timestamp("e.updatedAt").alias("updated_at"), F.explode_outer("e.listPrices").alias("p"),
    ).filter(F.col("p.merchantId") == merchant)
    rows = flat.select(
        "product_key", "product_version", "selections", text.canonical_map(F.col("selections")).alias("selections_text"),
        "quantities_min", "updated_at", F.col("p.market").alias("market"), F.col("p.currency").alias("currency"), F.col("p.prices").alias("prices"),
    )
    newest = ranking.latest(rows, ["product_key", "market", "selections_text"], [F.desc("updated_at"), F.desc("product_version")])
    priced = F.array_min(F.transform(F.map_keys("prices"), lambda k: k.try_cast("int")))
    return newest.withColumn("_priced", priced).select(
        "product_key", "product_version", "market", "currency", "selections", "selections_text",
        F.when(F.col("_priced") > F.col("quantities_min"), F.col("_priced")).otherwise(F.col("quantities_min")).alias("min_quantity"),
        F.try_element_at("prices", F.col("_priced").cast("string"))["unitListPrice"]["untaxed"].alias("local_price"),
    )


# fixed values: selection keys that give an attribute before the product's own value does
SELECTED = {
    "gender": ["Gender", "gender"],
    "decoration_location": ["Deco Area", "Decoration Area", "deco area"],
    "decoration_technology": ["Decoration", "Decoration Technology", "Deco Tech", "decoration technology", "deco tech"],
    "backside": ["Backside", "backside"],
}


def product_configs(
    prices: DataFrame, attributes: DataFrame, rates: DataFrame, products: DataFrame, active: DataFrame,
    alternatives: dict[str, list[str]], selected: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Priced, coloured configurations with product attributes.

    ``alternatives`` names, per output attribute, the source attributes in order of preference; ``selected`` the
    selection keys that come before them. FEATURES other than none follow the special features.
    """
    selected = SELECTED if selected is None else selected
    names = list(dict.fromkeys([n for values in alternatives.values() for n in values] + ["FEATURES"]))
    wide = pivot_attributes(attributes, ["product_key", "product_version"], names)
    wide = wide.select(
        "product_key", "product_version", "FEATURES", *[F.coalesce(*[F.col(f"`{n}`") for n in v]).alias(k) for k, v in alternatives.items()]
    )
    if "special_features" in alternatives:
        both = F.concat("special_features", F.lit(", "), "FEATURES")
        wide = wide.withColumn("special_features", F.when(F.lower("FEATURES") != "none", both).otherwise(F.col("special_features")))

    def chosen(*keys: str) -> Column:
        return F.coalesce(*[F.btrim(F.try_element_at("selections", F.lit(k)), F.lit('"')) for k in keys])

    exact = chosen("Substrate Color", "substrate color")
    joined = (
        prices.join(rates, "currency").join(products.select("product_key", "product_name", "category", "subcategory", "product_group"), "product_key")
        .join(wide, ["product_key", "product_version"], "left")
        .join(active.select("product_key", F.col("country").alias("market"), F.lit(0).alias("_active")).distinct(), ["product_key", "market"], "left")
    )
    def attribute(name: str) -> Column:
        sources = ([chosen(*selected[name])] if name in selected else []) + ([F.col(name)] if name in alternatives else [])
        return F.coalesce(*sources).alias(name)

    rows = joined.select(
        "product_key", "product_version", "market", "product_name", "category", "subcategory", "product_group",
        *[attribute(n) for n in dict.fromkeys([*alternatives, *selected])], F.upper(F.left(exact, F.lit(7))).alias("color"), F.upper(exact).alias("exact_color"),
        chosen("Size", "size").alias("size"), "currency", "min_quantity", (F.col("local_price") * F.col("rate_to_usd")).alias("unit_price"),
        "selections", "selections_text", F.when(F.col("_active").isNull(), 1).otherwise(0).alias("is_inactive"),
    )
    return rows.filter(F.col("color").rlike("^#[0-9A-F]{6}$"))


def config_identity(configs: DataFrame, selections: str = "selections") -> DataFrame:
    """Drop the size, upper-case colour choices, add the identity hash; one row per identity."""
    sized = F.map_filter(F.col(selections), lambda k, _: k != "Size")
    shown = F.transform_values(sized, lambda k, v: F.when(F.upper(k).contains("COLOR"), F.upper(v)).otherwise(v))
    keyed = configs.withColumn("options", shown).withColumn("options_text", text.canonical_map(F.col("options")))
    keyed = keyed.withColumn("config_id", F.sha2(F.concat("product_key", "market", "options_text"), 256))
    rest = [F.asc(c) for c in ("product_version", "item") if c in configs.columns]
    return ranking.latest(keyed, ["config_id"], [*rest, F.asc("options_text")])


def flag_constrained(configs: DataFrame, constraints: DataFrame) -> DataFrame:
    """1 where the product version is blocked in the market for all colours or for the config's colour list."""
    blocked = constraints.select(
        "product_key", "product_version", "market", F.upper(text.canonical_list(F.col("color"))).alias("_blocked")
    ).distinct()
    mine = F.upper(text.canonical_list(F.col("exact_color")))
    slots = configs.select("config_id", "product_key", "product_version", "market", F.explode(F.array_distinct(F.array(mine, F.lit(ALL_COLORS)))).alias("_blocked"))
    hits = slots.join(blocked, ["product_key", "product_version", "market", "_blocked"], "left_semi").select("config_id").distinct()
    return configs.join(hits.withColumn("is_constrained", F.lit(1)), "config_id", "left").na.fill(0, ["is_constrained"])


def item_config_lists(universe: DataFrame, constraints: DataFrame) -> DataFrame:
    """Unconstrained configs per (market, product, version), as a sorted list of option texts."""
    keys = ["product_key", "product_version", "market"]
    blocked = constraints.select(*keys, F.upper("color").alias("_color")).distinct()
    open_rows = (
        universe.join(blocked.filter(F.col("_color") == ALL_COLORS), keys, "left_anti")
        .withColumn("_color", F.upper("color")).join(blocked.filter(F.col("_color") != ALL_COLORS), [*keys, "_color"], "left_anti")
    )
    name = F.upper(F.concat_ws("|", "market", "product_key", F.col("product_version").cast("string")))
    return open_rows.groupBy(*keys).agg(F.array_sort(F.collect_list("options_text")).alias("configs")).select(
        name.alias("item_version"), "configs"
    )


# fixed values: value dictionaries of the attribute cleaning
TYPE_VALUES = {"BASEBALL CAPS": "CAP", "BASEBALL CAP": "CAP", "TRUCKER CAPS": "CAP"}
GENDER_VALUES = {
    "Ladies'": "WOMEN", "MEN/UNISEX": "MEN OR WOMEN", "MEN,MEN/UNISEX": "MEN OR WOMEN", "MEN/UNISEX,MEN": "MEN OR WOMEN",
    "Men's": "MEN", "MALE": "MEN", "Kids": "YOUTH", "WOMENS": "WOMEN", "UNISEX": "MEN OR WOMEN", "ADULT": "MEN OR WOMEN",
    "UNISEX, WOMEN, MEN": "MEN OR WOMEN", "UNISEX, WOMEN , MEN": "MEN OR WOMEN", "UNISEX, MEN, WOMEN": "MEN OR WOMEN",
    "MEN, WOMEN, UNISEX": "MEN OR WOMEN",
}
TECHNOLOGY_VALUES = {
    "FULLCOLORTRANSFER": "DIRECT GARMENT PRINT", "DIRECTGARMENTPRINT": "DIRECT GARMENT PRINT",
    "DIRECTTOGARMENT": "DIRECT GARMENT PRINT", "Direct-to-Garment": "DIRECT GARMENT PRINT",
    "Textured Direct-to-Garment": "DIRECT GARMENT PRINT", "COLORPRINT": "DIRECT GARMENT PRINT",
    "FULLCOLORPRINT": "DIRECT GARMENT PRINT", "HEATTRANSFER": "HEAT TRANSFER", "EMBROIDERYFLAT": "EMBROIDERY",
    "EMBROIDERYCYLINDER": "EMBROIDERY",
}
LOCATION_VALUES = {"LC": "LEFT CHEST"}
BACKSIDE_VALUES = {"blank": "Blank"}
QUALITY_VALUES = {"C": None}
# fixed values: name parts that reveal the gender, in order; the second list is also trusted over a given gender
GENDER_NAMES = [("MEN", [" MEN"], ["(MEN"]), ("WOMEN", ["WOMEN"], ["LADIE"]), ("MEN OR WOMEN", ["UNISEX"], []), ("YOUTH", ["KID"], ["YOUTH"])]
COLLAR_PATTERN = r"(?i)\s*COLLAR\s*|\s*NECK\s*|-NECK\s*"
COMMA_COLUMNS = ["pockets", "type", "decoration_location"]
NONE_COLUMNS = ["gender", "type", "decoration_technology", "decoration_location", "backside", "quality", "collar_type", "pockets", "sleeve_style", "material"]


def gender_from_name(gender: Column, name: Column, strict_reference: bool = False) -> Column:
    """Fill a missing gender from the product name. ``strict_reference`` also lets some parts override a given one."""
    upper = F.upper(name)
    expr = None
    for label, weak, strong in GENDER_NAMES:
        def any_of(parts):
            hit = F.lit(False)
            for p in parts:
                hit = hit | upper.contains(p)
            return hit
        found = gender.isNull() & any_of(weak + ([] if strict_reference else strong))
        if strict_reference:
            found = found | any_of(strong)
        expr = F.when(found, label) if expr is None else expr.when(found, label)
    return expr.otherwise(gender)


def clean_configs(configs: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Normalised attributes; missing panel counts take the median of the market and type."""
    named = configs.withColumns({
        "gender": text.translate_values(gender_from_name(F.col("gender"), F.col("full_name"), strict_reference), GENDER_VALUES),
        "type": text.translate_values(F.col("type"), TYPE_VALUES),
    })
    medians = named.groupBy("market", "type").agg(
        F.percentile_approx(F.col("panels").try_cast("int"), 0.5).alias("_median")
    )
    filled = named.join(medians, ["market", "type"], "left")
    panels = F.when(F.col("panels").isNull(), F.col("_median")).when(F.col("panels") == "NOT APPLICABLE", 0).otherwise(F.col("panels").try_cast("int"))
    cleaned = filled.withColumns({
        "panels": F.coalesce(panels, F.lit(0)),
        "back_pockets": F.coalesce(F.col("back_pockets").try_cast("int"), F.lit(0)),
        "decoration_technology": text.translate_values(F.col("decoration_technology"), TECHNOLOGY_VALUES),
        "decoration_location": text.translate_values(F.col("decoration_location"), LOCATION_VALUES),
        "backside": text.translate_values(F.col("backside"), BACKSIDE_VALUES),
        "quality": text.translate_values(F.col("quality"), QUALITY_VALUES),
        "collar_type": F.regexp_replace("collar_type", COLLAR_PATTERN, ""),
    }).drop("_median")
    cleaned = cleaned.withColumns({c: F.replace(F.col(c), F.lit(","), F.lit(", ")) for c in COMMA_COLUMNS})
    cleaned = cleaned.withColumn("pockets", F.translate("pockets", "()", ""))
    return cleaned.withColumns({c: text.none_to_null(F.col(c)) for c in NONE_COLUMNS})


def color_features(configs: DataFrame, hex_column: str = "color_hex") -> DataFrame:
    lab = configs.withColumn("_lab", color.hex_to_lab(F.col(hex_column)))
    return lab.select(
        *configs.columns, F.col("_lab.l").alias("l_color"), F.col("_lab.a").alias("a_color"), F.col("_lab.b").alias("b_color"),
        color.nearest_basic_color(F.col("_lab")).alias("color_name"),
    )


# fixed values: sentence templates of the text vectors
TYPE_SENTENCE = "The product type is a {type}."
GENDER_SENTENCE = "The {type} is specifically intended for {gender}. "
GENDER_MISSING = "Gender is not relevant."
SLEEVE_SENTENCE = "The sleeve style is {sleeve_style}. "
SLEEVE_MISSING = "Sleeves are not relevant."
OTHER_MISSING = "No additional information."
OTHER_SENTENCES = {
    "decoration_location": "The decoration area is {decoration_location}.",
    "decoration_technology": "The decoration style is {decoration_technology}.",
    "material": "The material is {material}.",
    "collar_fastener": "The collar has {collar_fastener} fastener. ",
    "collar_type": "The collar style is  {collar_type}.",
    "fit": "The fit of the {type} is {fit}.",
    "pockets": "The pockets available are {pockets}.",
    "special_features": "The {type} following special features: {special_features}.",
    "front_pocket_closures": "The {type} pocket type is {front_pocket_closures}.",
    "quality": "The quality is {quality}.",
    "waist_type": "The {type} waist is an {waist_type}.",
    "front_pocket_closure": "The {type} front pocket type is {front_pocket_closure}.",
    "chest_pocket_type": "The chest pocket type is {chest_pocket_type} on the {chest_pockets}.",
    "cuff_type": "The cuff type is {cuff_type}.",
    "brim": "The {type} brim type is {brim}.",
    "eyelets": "The {type} eyelets are {eyelets}.",
    "crown": "The {type} crown is {crown}.",
    "closure": "The {type} closure is {closure}.",
    "fit_type": "The {type} fit is {fit_type}.",
    "fastener_type": "The {fastener_type} fastner is {crown}.",
}
ZIPPER_SENTENCE = "The {type} has zippers."


def attribute_sentences(configs: DataFrame) -> DataFrame:
    """Four texts per config. Attributes a dataset does not carry count as missing."""
    absent = [c for c in [*OTHER_SENTENCES, "chest_pockets", "zipper_pulls", "sleeve_style", "gender", "type"] if c not in configs.columns]
    rows = configs.select("*", *[F.lit(None).cast("string").alias(c) for c in dict.fromkeys(absent)])
    empty = F.lit("")

    def when_set(column: str, template: str) -> Column:
        return F.when(F.col(column).isNotNull(), text.sentence(template)).otherwise(empty)

    nothing = F.lit(True)
    for c in OTHER_SENTENCES:
        nothing = nothing & F.col(c).isNull()
    other = F.concat_ws(" ", *[when_set(c, t) for c, t in OTHER_SENTENCES.items()], when_set("zipper_pulls", ZIPPER_SENTENCE))
    return rows.select(
        *configs.columns,
        F.concat_ws(" ", when_set("type", TYPE_SENTENCE)).alias("type_text"),
        F.when(F.col("gender").isNull(), GENDER_MISSING).otherwise(F.concat_ws(" ", text.sentence(GENDER_SENTENCE))).alias("gender_text"),
        F.when(F.col("sleeve_style").isNull(), SLEEVE_MISSING).otherwise(F.concat_ws(" ", text.sentence(SLEEVE_SENTENCE))).alias("sleeve_text"),
        F.when(nothing, OTHER_MISSING).otherwise(other).alias("other_text"),
    )


def standardised(df: DataFrame, columns: list[str]) -> DataFrame:
    """z-scores with the population deviation; a constant column gives zeros. One aggregate, read as a scalar subquery."""
    stats = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns
    ]).alias("stats")).scalar()
    with_stats = df.withColumn("_stats", stats)
    return with_stats.select(*df.columns, *[
        F.coalesce(F.try_divide(F.col(c) - F.col(f"_stats.{c}.m"), F.nullif(F.col(f"_stats.{c}.s"), F.lit(0.0))), F.lit(0.0)).alias(f"{c}_scaled")
        for c in columns
    ])


Encoder = Callable[[Column, int], Column]


def config_embeddings(configs: DataFrame, encoder: Encoder = vector.text_embedding, dims: dict[str, int] | None = None) -> DataFrame:
    """All vector parts of a config and their concatenation, in one pass over the row.

    ``encoder`` maps a text column and a dimension to an array column: the hashed bag of words, or a
    pandas UDF around a model.
    """
    d = dims or config.EMBEDDING_DIMS
    numeric = ["unit_price", "l_color", "a_color", "b_color", "back_pockets", "panels"]
    rows = standardised(attribute_sentences(color_features(configs)), numeric)
    scaled = [f"{c}_scaled" for c in numeric]
    parts = rows.select(
        *configs.columns, "color_name", "type_text", "gender_text", "sleeve_text", "other_text",
        encoder(F.col("type_text"), d["type"]).alias("type_vector"),
        vector.seeded_dense(scaled[:4], d["numeric_color"], "numeric_color").alias("numeric_color_vector"),
        vector.seeded_dense(scaled[4:], d["numeric_other"], "numeric_other").alias("numeric_other_vector"),
        vector.category_lookup(F.col("backside"), d["categorical"], "backside").alias("categorical_vector"),
        encoder(F.col("gender_text"), d["gender"]).alias("gender_vector"),
        encoder(F.col("sleeve_text"), d["sleeve"]).alias("sleeve_vector"),
        encoder(F.col("other_text"), d["other"]).alias("other_vector"),
    )
    order = ["type", "numeric_color", "numeric_other", "categorical", "gender", "sleeve", "other"]
    return parts.withColumn("full_embedding", F.concat(*[F.col(f"{p}_vector") for p in order]))


def tier_weighted_embedding(configs: DataFrame, tiers: dict[str, tuple[Column, int]], encoder: Encoder = vector.text_embedding) -> DataFrame:
    """Text tiers with their own dimension each, concatenated: a tier's size acts as its weight."""
    return configs.withColumn("embedding", F.concat(*[encoder(c, dim) for c, dim in tiers.values()]))


def mean_pool(df: DataFrame, keys: list[str], vector_column: str) -> DataFrame:
    """Element-wise mean vector per key: positions average map-side, then reassemble (at most one row per position)."""
    positions = df.select(*keys, F.posexplode(vector_column).alias("pos", "x")).groupBy(*keys, "pos").agg(F.avg("x").alias("x"))
    packed = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return positions.groupBy(*keys).agg(F.transform(packed, lambda p: p["x"]).alias("mean_vector"))
