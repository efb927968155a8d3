"""Queries: product configurations, vectors, similar products and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinora.catalog.common import tidy
from affinora.functions import color, text, vector, vocab
from affinora.operators import quality, ranking
from affinora.fixtures import ORDERS_AS_OF
from affinora.plans import embeddings as E
from affinora.plans import similarity as S
from affinora.plans.proxies import rates_of

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

GROUPS = {f"G{i}": [f"G{i}"] for i in range(2, 10)} | {"G0": ["G0", "G1"], "G1": ["G0", "G1"]}
RELEVANT = {
    f"G{i}": (["fit_type", "color", "type", "decoration_technology", "decoration_location"] if i % 3 == 0 else
              ["gender", "color", "decoration_technology", "sleeve_style", "decoration_location"] if i % 3 == 1 else
              ["gender", "color", "type", "decoration_technology", "decoration_location"])
    for i in range(10)
}
THRESHOLD = 0.2
MIN_COLOR = 0.5


def _add(name, fn, sql=None):
    QUERIES[name] = fn
    if sql:
        ORACLE[name] = sql


# --- colour formulas in SQL -----------------------------------------------------------------

def lab_sql(hex_expr: str, prefix: str) -> str:
    """Select items l, a, b (with prefix) of a hex colour."""
    lin = []
    for i in range(3):
        v = f"(cast(concat('0x', substring({hex_expr}, {2 + 2 * i}, 2)) as integer) / 255.0::double)"
        lin.append(f"(case when {v} <= 0.04045 then {v} / 12.92::double else pow(({v} + 0.055::double) / 1.055::double, 2.4) end)")
    f = []
    for row, white in zip(color.SRGB_TO_XYZ, color.WHITE_D65):
        t = "((" + " + ".join(f"{m}::double * {x}" for m, x in zip(row, lin)) + f") / {white}::double)"
        f.append(f"(case when {t} > {216 / 24389!r}::double then pow({t}, {1 / 3!r}::double) else ({t} * {24389 / 27!r}::double + 16) / 116 end)")
    return f"116 * {f[1]} - 16 as {prefix}l, 500 * ({f[0]} - {f[1]}) as {prefix}a, 200 * ({f[1]} - {f[2]}) as {prefix}b"


def cmc_sql(p: str, q: str) -> str:
    l1, a1, b1, l2, a2, b2 = f"{p}l", f"{p}a", f"{p}b", f"{q}l", f"{q}a", f"{q}b"
    c1, c2 = f"sqrt({a1}*{a1}+{b1}*{b1})", f"sqrt({a2}*{a2}+{b2}*{b2})"
    h = f"(case when degrees(atan2({b1},{a1})) < 0 then degrees(atan2({b1},{a1})) + 360 else degrees(atan2({b1},{a1})) end)"
    t = f"(case when {h} between 164 and 345 then 0.56 + abs(0.2 * cos(radians({h} + 168))) else 0.36 + abs(0.4 * cos(radians({h} + 35))) end)"
    f = f"sqrt(pow({c1}, 4) / (pow({c1}, 4) + 1900))"
    sl = f"(case when {l1} < 16 then 0.511 else 0.040975 * {l1} / (1 + 0.01765 * {l1}) end)"
    sc = f"(0.0638 * {c1} / (1 + 0.0131 * {c1}) + 0.638)"
    sh = f"({sc} * ({f} * {t} + 1 - {f}))"
    dh2 = f"greatest(pow({a1}-{a2}, 2) + pow({b1}-{b2}, 2) - pow({c1}-{c2}, 2), 0)"
    return f"sqrt(pow(({l1}-{l2}) / (2 * {sl}), 2) + pow(({c1}-{c2}) / {sc}, 2) + {dh2} / pow({sh}, 2))"


_ANCHORS = ", ".join(f"({i}, '{n}', '{c}')" for i, (n, c) in enumerate((n, c) for n, cs in color.BASIC_COLORS.items() for c in cs))
ANCHORS = f"anchor as (select pos, name, {lab_sql('code', 'q_')} from (values {_ANCHORS}) t(pos, name, code))"


def named_sql(source: str, hex_column: str, key: str, out: str = "named") -> str:
    """CTE with the Lab of distinct colours and their nearest anchor name."""
    return f"""{out}_lab as (select {key}, {lab_sql(hex_column, 'p_')} from (select distinct {hex_column} as {key} from {source}) c0(  {key}) ),
{out} as (select {key}, p_l, p_a, p_b, name from (select l.*, a.name, row_number() over (partition by l.{key} order by {cmc_sql('l.p_', 'a.q_')}, a.pos) as n from {out}_lab l cross join anchor a) x where n = 1)""".replace(
        f"select {key}, {lab_sql(hex_column, 'p_')}", f"select {key}, {lab_sql(key, 'p_')}")


_add("color_features", lambda fx: tidy(E.color_features(fx.product.select("item", "color_hex"))),
     f"""with {ANCHORS}, {named_sql('product', 'color_hex', 'code')} select p.item, p.color_hex, round(n.p_l, 6) + 0 as l_color, round(n.p_a, 6) + 0 as a_color, round(n.p_b, 6) + 0 as b_color, n.name as color_name
 from product p join named n on n.code = p.color_hex""")
_CSS = ", ".join(f"('{n}', '{c}')" for n, c in color.CSS_COLORS.items())


def _rgb(e, i):
    return f"cast(concat('0x', substring({e}, {2 + 2 * i}, 2)) as integer)"


_add("nearest_css_color", lambda fx: tidy(fx.product.select("item", color.nearest_css_color(F.col("color_hex")).alias("css_name"))),
     f"""select item, name as css_name from (select p.item, c.name, row_number() over (partition by p.item order by
 {' + '.join(f'pow({_rgb("p.color_hex", i)} - {_rgb("c.code", i)}, 2)' for i in range(3))}, c.name) as n from product p cross join (values {_CSS}) c(name, code)) x where n = 1""")

# --- configurations -------------------------------------------------------------------------

ALTERNATIVES = {"fit": ["FIT", "FIT_FEATURES"], "pockets": ["POCKETS", "POCKET"], "decoration_location": ["DECORATION_LOCATION", "DECO_AREA_NAME"],
                "sleeve_style": ["SLEEVES"], "panels": ["PANELS"], "gender": ["GENDER"], "material": ["MATERIAL"],
                "decoration_technology": ["MSW_DECORATION_TECHNOLOGY", "DECORATION_TECHNOLOGY", "DECO_1_PROCESS_TYPE"], "special_features": ["SPECIAL_FEATURES"],
                "quality": ["QUALITY_ATTRIBUTES"], "waist_type": ["WAIST_TYPE"], "back_pockets": ["BACK_POCKET_S"], "cuff_type": ["CUFF_TYPE"], "closure": ["CLOSURE"],
                "fit_type": ["FIT_TYPE"], "brim": ["BRIM"], "crown": ["CROWN"], "eyelets": ["EYELETS"], "zipper_pulls": ["ZIPPER_PULLS"]}


def _attributes(fx):
    return fx.sku_attribute.withColumnRenamed("sku_version", "product_version").drop("sku")


def _configs(fx):
    prices = E.list_prices(fx.price_enumeration, "acme")
    return E.product_configs(prices, _attributes(fx), rates_of(fx.fx_rate, ORDERS_AS_OF), fx.product,
                             fx.base_item, ALTERNATIVES)


_ATTRS = """attrs as (select sku as item, min(case when property_name = 'FIT' then property_value end) as fit1, min(case when property_name = 'FIT_FEATURES' then property_value end) as fit2,
 min(case when property_name = 'POCKETS' then property_value end) as p1, min(case when property_name = 'POCKET' then property_value end) as p2,
 min(case when property_name = 'DECORATION_LOCATION' then property_value end) as d1, min(case when property_name = 'DECO_AREA_NAME' then property_value end) as d2,
 min(case when property_name = 'SLEEVES' then property_value end) as s1, min(case when property_name = 'PANELS' then property_value end) as n1,
 """ + ", ".join(f"min(case when property_name = '{n}' then property_value end) as {n.lower()}" for n in (
    "GENDER", "MATERIAL", "MSW_DECORATION_TECHNOLOGY", "DECORATION_TECHNOLOGY", "DECO_1_PROCESS_TYPE", "SPECIAL_FEATURES", "FEATURES", "QUALITY_ATTRIBUTES", "WAIST_TYPE", "BACK_POCKET_S",
    "CUFF_TYPE", "CLOSURE", "FIT_TYPE", "BRIM", "CROWN", "EYELETS", "ZIPPER_PULLS")) + """ from sku_attribute group by 1)"""
CONFIGS = f"""{_ATTRS}, configs as (select p.product_key, p.product_version, p.item, concat('C', cast(p.item % 25 as string)) as market, p.product_name, p.category, p.subcategory, p.product_group,
  coalesce(a.fit1, a.fit2) as fit, coalesce(a.p1, a.p2) as pockets, case when p.item % 5 = 0 then 'Sleeve' else coalesce(a.d1, a.d2) end as decoration_location, a.s1 as sleeve_style, a.n1 as panels,
  case when p.item % 4 = 0 then 'Men' else a.gender end as gender, a.material, case when p.item % 7 = 0 then 'LASER' else coalesce(a.msw_decoration_technology, a.decoration_technology, a.deco_1_process_type) end as decoration_technology,
  case when lower(a.features) <> 'none' then a.special_features || ', ' || a.features else a.special_features end as special_features, a.quality_attributes as quality, a.waist_type, a.back_pocket_s as back_pockets,
  a.cuff_type, a.closure, a.fit_type, a.brim, a.crown, a.eyelets, a.zipper_pulls, case when p.item % 3 = 0 then 'printed' end as backside, upper(p.color_hex) as color, upper(p.color_hex) as exact_color, case when rev = 2 then 'L' else 'M' end as size,
  f.currency, greatest(1 + p.item % 9, p.moq) as min_quantity, (round(coalesce(p.unit_price, 10.0), 0) + rev) * f.rate_to_usd as unit_price,
  concat('{{', case when p.item % 3 = 0 then '"Backside": "printed", ' else '' end, case when p.item % 5 = 0 then '"Deco Area": "Sleeve", ' else '' end, case when p.item % 7 = 0 then '"Deco Tech": "LASER", ' else '' end, case when p.item % 4 = 0 then '"Gender": "Men", ' else '' end, '"Size": "', case when rev = 2 then 'L' else 'M' end, '", "Substrate Color": "', p.color_hex, '"}}') as selections_text,
  case when b.item is null then 1 else 0 end as is_inactive, rev
 from (select *, unnest([2, 3]) as rev from product where item % 12 <> 0) p left join attrs a on a.item = p.item
 join fx_rate f on f.country = concat('C', cast(p.item % 25 as string)) and f.to_currency = 'USD' and f.rate_date = date '2001-08-01' left join base_item b on b.item = p.item and b.country = f.country)""".replace("{{", "{").replace("}}", "}")
_CFG_COLS = """product_key, product_version::bigint as product_version, market, product_name, category, subcategory, product_group, fit, pockets, decoration_location, sleeve_style, panels, gender, material, decoration_technology, special_features,
 quality, waist_type, back_pockets, cuff_type, closure, fit_type, brim, crown, eyelets, zipper_pulls, backside, color, exact_color, size, currency, min_quantity::bigint as min_quantity, round(unit_price, 6) as unit_price, selections_text, is_inactive::bigint as is_inactive"""
_add("product_configs", lambda fx: tidy(_configs(fx).drop("selections")), f"with {CONFIGS} select {_CFG_COLS} from configs")
_add("attribute_pivot", lambda fx: tidy(E.pivot_attributes(_attributes(fx), ["product_key", "product_version"], ["FIT", "POCKETS", "PANELS"])),
     """select product_key, sku_version::bigint as product_version, min(case when property_name = 'FIT' then property_value end) as "FIT",
 min(case when property_name = 'POCKETS' then property_value end) as "POCKETS", min(case when property_name = 'PANELS' then property_value end) as "PANELS" from sku_attribute group by 1, 2""")


def _identified(fx):
    return E.config_identity(_configs(fx))


_OPT = """concat('{', case when item % 3 = 0 then '"Backside": "printed", ' else '' end, case when item % 5 = 0 then '"Deco Area": "Sleeve", ' else '' end,
 case when item % 7 = 0 then '"Deco Tech": "LASER", ' else '' end, case when item % 4 = 0 then '"Gender": "Men", ' else '' end, '"Substrate Color": "', upper(color), '"}')"""
IDENT = f"{CONFIGS}, ident as (select product_key, product_version, item, market, color, exact_color, {_OPT} as options_text, sha256(concat(product_key, market, {_OPT})) as config_id from configs where rev = 3)"
_add("config_identity", lambda fx: tidy(_identified(fx).select("config_id", "product_key", "product_version", "market", "options_text")),
     f"with {IDENT} select config_id, product_key, product_version::bigint as product_version, market, options_text from ident")


def _constraints(fx):
    from affinora.plans import item_master as M

    return M.parse_constraints(fx.constraint_payload, "ACME").withColumnRenamed("country", "market")


_BLOCKS = """blocks as (
 select product_key, product_version, concat('C', cast(item % 25 as string)) as market, case when item % 3 = 0 then 'ALL' else color_hex end as color from product
 union all select product_key, product_version, concat('C', cast(item % 25 as string)), '#00FF00' from product where item % 10 <> 0 and item % 3 <> 0
 union all select product_key, product_version, concat('C', cast((item + item % 2) % 25 as string)), 'ALL' from product where item % 5 = 0)"""


def _some_constraints(fx):
    return _constraints(fx).filter("constraint_type <> 'block' or product_key like '%7'")


_SOME = _BLOCKS.replace("color_hex end as color from product", "color_hex end as color from product where product_key like '%7'")
_add("flag_constrained_configs", lambda fx: tidy(E.flag_constrained(_identified(fx), _some_constraints(fx)).select("config_id", "product_key", "market", "is_constrained")),
     f"""with {IDENT}, {_SOME} select config_id, product_key, market, case when exists (select 1 from blocks b where b.product_key = i.product_key and b.product_version = i.product_version
 and b.market = i.market and (b.color = 'ALL' or upper(b.color) = upper(i.exact_color))) then 1 else 0 end::bigint as is_constrained from ident i""")
_add("item_config_lists", lambda fx: tidy(E.item_config_lists(_identified(fx), _some_constraints(fx)).select("item_version", F.array_join("configs", "|").alias("configs"))),
     f"""with {IDENT}, {_SOME} select upper(concat(market, '|', product_key, '|', cast(product_version as string))) as item_version, string_agg(options_text, '|' order by options_text) as configs
 from ident i where not exists (select 1 from blocks b where b.product_key = i.product_key and b.product_version = i.product_version and b.market = i.market and (b.color = 'ALL' or upper(b.color) = upper(i.color)))
 group by market, product_key, product_version""")

_CLEAN_COLS = ["product_key", "market", "gender", "type", "panels", "back_pockets", "decoration_technology", "decoration_location", "backside", "quality", "collar_type", "pockets", "sleeve_style", "material"]


def clean_sql(strict: bool) -> str:
    n = "upper(full_name)"
    if strict:
        g = f"""case when (gender is null and contains({n}, ' MEN')) or contains({n}, '(MEN') then 'MEN'
 when (gender is null and contains({n}, 'WOMEN')) or contains({n}, 'LADIE') then 'WOMEN' when gender is null and contains({n}, 'UNISEX') then 'MEN OR WOMEN'
 when (gender is null and contains({n}, 'KID')) or contains({n}, 'YOUTH') then 'YOUTH' else gender end"""
    else:
        g = f"""case when gender is not null then gender when contains({n}, ' MEN') or contains({n}, '(MEN') then 'MEN' when contains({n}, 'WOMEN') or contains({n}, 'LADIE') then 'WOMEN'
 when contains({n}, 'UNISEX') then 'MEN OR WOMEN' when contains({n}, 'KID') or contains({n}, 'YOUTH') then 'YOUTH' end"""
    return f"""c1 as (select * exclude (gender, type), {g} as g0, case when type in ('BASEBALL CAPS', 'BASEBALL CAP', 'TRUCKER CAPS') then 'CAP' else type end as t0 from raw_config),
med as (select market, t0, quantile_disc(try_cast(panels as int), 0.5) as m from c1 group by 1, 2),
clean as (select product_key, c1.market, case g0 when 'MALE' then 'MEN' when 'Kids' then 'YOUTH' when 'WOMENS' then 'WOMEN' when 'UNISEX' then 'MEN OR WOMEN' else g0 end as gender,
 case when lower(c1.t0) = 'none' then null else replace(c1.t0, ',', ', ') end as type,
 coalesce(case when panels is null then med.m when panels = 'NOT APPLICABLE' then 0 else try_cast(panels as int) end, 0)::bigint as panels, coalesce(try_cast(back_pockets as int), 0)::bigint as back_pockets,
 case decoration_technology when 'FULLCOLORTRANSFER' then 'DIRECT GARMENT PRINT' when 'Direct-to-Garment' then 'DIRECT GARMENT PRINT' when 'EMBROIDERYFLAT' then 'EMBROIDERY' else decoration_technology end as decoration_technology,
 case when decoration_location = 'LC' then 'LEFT CHEST' else replace(decoration_location, ',', ', ') end as decoration_location,
 case when backside = 'blank' then 'Blank' else backside end as backside, case when quality = 'C' or lower(quality) = 'none' then null else quality end as quality,
 regexp_replace(collar_type, '(?i)\\s*COLLAR\\s*|\\s*NECK\\s*|-NECK\\s*', '', 'g') as collar_type,
 case when lower(pockets) = 'none' then null else replace(replace(replace(pockets, ',', ', '), '(', ''), ')', '') end as pockets,
 case when lower(sleeve_style) = 'none' then null else sleeve_style end as sleeve_style, material, color_hex, unit_price
 from c1 left join med on med.market = c1.market and med.t0 = c1.t0)"""


_add("clean_configs", lambda fx: tidy(E.clean_configs(fx.raw_config).select(*_CLEAN_COLS)), f"with {clean_sql(False)} select {', '.join(_CLEAN_COLS)} from clean")
_add("clean_configs_strict", lambda fx: tidy(E.clean_configs(fx.raw_config, strict_reference=True).select(*_CLEAN_COLS)),
     f"with {clean_sql(True)} select {', '.join(_CLEAN_COLS)} from clean")

_SENT = clean_sql(False) + """, sent as (select product_key, market, unit_price, panels, back_pockets, backside, color_hex,
 case when type is not null then concat('The product type is a ', type, '.') else '' end as type_text,
 case when gender is null then 'Gender is not relevant.' when type is null then '' else concat('The ', type, ' is specifically intended for ', gender, '. ') end as gender_text,
 case when sleeve_style is null then 'Sleeves are not relevant.' else concat('The sleeve style is ', sleeve_style, '. ') end as sleeve_text,
 case when decoration_location is null and decoration_technology is null and material is null and collar_type is null and pockets is null and quality is null then 'No additional information.'
 else concat(coalesce(concat('The decoration area is ', nullif(decoration_location, ''), '.'), ''), ' ', 'The decoration style is ', decoration_technology, '. ',
   case when material is null then '' else concat('The material is ', material, '.') end, ' ', '', ' ', case when collar_type is null then '' else concat('The collar style is  ', collar_type, '.') end, ' ', '', ' ',
   case when pockets is null then '' else concat('The pockets available are ', pockets, '.') end, ' ', '', ' ', '', ' ', case when quality is null then '' else concat('The quality is ', quality, '.') end,
   repeat(' ', 11)) end as other_text from clean)""".replace("coalesce(concat('The decoration area is ', nullif(decoration_location, ''), '.'), '')", "case when decoration_location is null then '' else concat('The decoration area is ', decoration_location, '.') end")


def _clean(fx):
    return E.clean_configs(fx.raw_config)


_add("attribute_sentences", lambda fx: tidy(E.attribute_sentences(_clean(fx)).select("product_key", "market", "type_text", "gender_text", "sleeve_text", "other_text")),
     f"with {_SENT} select product_key, market, type_text, gender_text, sleeve_text, other_text from sent")


def text_vector_sql(rows: str, key: str, column: str, dim: int) -> str:
    """Long form (key, pos, x) of the hashed bag of words."""
    return f"""select b.{key}, b.pos, coalesce(t.x, 0) / case when n.len > 0 then sqrt(n.len) else 1 end as x
 from (select {key}, unnest(range(0, {dim})) as pos from {rows}) b
 left join (select {key}, pos, sum(sg)::double as x from (select {key}, cast(concat('0x', substring(md5(tok), 1, 8)) as bigint) % {dim} as pos, case when cast(concat('0x', substring(md5(tok), 9, 1)) as int) % 2 = 0 then 1 else -1 end as sg
    from (select {key}, unnest(regexp_split_to_array(lower({column}), '[^a-z0-9]+')) as tok from {rows}) k where tok <> '') s group by 1, 2) t on t.{key} = b.{key} and t.pos = b.pos
 left join (select {key}, sum(x * x) as len from (select {key}, pos, sum(sg)::double as x from (select {key}, cast(concat('0x', substring(md5(tok), 1, 8)) as bigint) % {dim} as pos, case when cast(concat('0x', substring(md5(tok), 9, 1)) as int) % 2 = 0 then 1 else -1 end as sg
    from (select {key}, unnest(regexp_split_to_array(lower({column}), '[^a-z0-9]+')) as tok from {rows}) k where tok <> '') s group by 1, 2) q group by 1) n on n.{key} = b.{key}"""


def _long(df, keys, column):
    # the outer form: a plain explode adds a filter on the array, which would compute the vector again
    return df.select(*keys, F.posexplode_outer(column).alias("pos", "x"))


_add("text_embedding", lambda fx: tidy(_long(fx.documents.select("doc_id", vector.text_embedding(F.col("text"), 18).alias("v")), ["doc_id"], "v")),
     f"select doc_id, pos, round(x, 6) + 0 as x from ({text_vector_sql('documents', 'doc_id', 'text', 18)}) v")


def _dense_sql(columns, dim, seed, offset):
    units = []
    for j in range(dim):
        units.append("greatest(" + " + ".join(f"{c} * ({vector.seeded_weight(seed, i, j)!r})::double" for i, c in enumerate(columns)) + ", 0)")
    return ", ".join(f"{u} as v{offset + j}" for j, u in enumerate(units))


_NUM = ["unit_price", "p_l", "p_a", "p_b", "back_pockets", "panels"]
_EMBED = f"""{ANCHORS}, {_SENT}, {named_sql('sent', 'color_hex', 'code')}, nums as (select s.*, concat(s.product_key, '@', s.market) as k, n.p_l, n.p_a, n.p_b from sent s join named n on n.code = s.color_hex),
stats as (select {', '.join(f'avg({c}) as m_{c}, stddev_pop({c}) as s_{c}' for c in _NUM)} from nums),
scaled as (select nums.*, {', '.join(f'coalesce((nums.{c} - m_{c}) / nullif(s_{c}, 0), 0) as z_{c}' for c in _NUM)} from nums cross join stats),
dense as (select k, {_dense_sql(['z_' + c for c in _NUM[:4]], 10, 'numeric_color', 0)}, {_dense_sql(['z_' + c for c in _NUM[4:]], 4, 'numeric_other', 10)},
  {', '.join(f"(cast(concat('0x', substring(md5(concat('backside:', coalesce(backside, '<null>'), ':{j}')), 1, 8)) as bigint)::double / 4294967295.0::double * 2 - 1) * 0.05::double as v{14 + j}" for j in range(4))} from scaled)"""
_add("numeric_embedding", lambda fx: tidy(_long(E.config_embeddings(_clean(fx)).select(
        F.concat("product_key", F.lit("@"), "market").alias("k"), F.concat("numeric_color_vector", "numeric_other_vector", "categorical_vector").alias("v")), ["k"], "v")),
     f"with {_EMBED} " + " union all ".join(f"select k, {j}::bigint as pos, round(v{j}, 6) + 0 as x from dense" for j in range(18)))
_EMB_LONG = _EMBED + ", full_vec as (" + " union all ".join(
    [f"select k, {18 + j} as pos, v{j} as x from dense" for j in range(18)]
    + [f"select k, pos + {start} as pos, x from ({text_vector_sql('nums', 'k', col, dim)}) t{start}"
       for col, dim, start in (("type_text", 18, 0), ("gender_text", 18, 36), ("sleeve_text", 12, 54), ("other_text", 12, 66))]) + ")"
_add("config_embeddings", lambda fx: tidy(_long(E.config_embeddings(_clean(fx)).select(F.concat("product_key", F.lit("@"), "market").alias("k"), "full_embedding"), ["k"], "full_embedding")),
     f"with {_EMB_LONG} select k, pos::bigint as pos, round(x, 6) + 0 as x from full_vec")
_add("mean_pool", lambda fx: tidy(_long(E.mean_pool(fx.config, ["market", "product_group"], "embedding"), ["market", "product_group"], "mean_vector"), 4),
     """select market, product_group, (i - 1)::bigint as pos, round(avg(x), 4) + 0 as x from (select market, product_group, unnest(embedding)::double as x, unnest(range(1, len(embedding) + 1)) as i from config) v group by 1, 2, 3""")


def _tiers(fx):
    rows = fx.product.select("item", "product_name", "category", "subcategory")
    return E.tier_weighted_embedding(rows, {"name": (F.col("product_name"), 16), "levels": (F.concat_ws(" ", "category", "subcategory"), 8)})


_add("tier_weighted_embedding", lambda fx: tidy(_long(_tiers(fx), ["item"], "embedding")),
     f"""with tier_rows as (select item, product_name as n, concat(category, ' ', subcategory) as l from product)
 select item, pos, round(x, 6) + 0 as x from ({text_vector_sql('tier_rows', 'item', 'n', 16)}) a union all select item, pos + 16, round(x, 6) + 0 from ({text_vector_sql('tier_rows', 'item', 'l', 8)}) b""")

# --- pairs ----------------------------------------------------------------------------------

_SIDE = ["product_key", "product_version", "product_group", "moq", "is_constrained", "is_inactive", "color_hex", "options_json", *vocab.VOCABULARIES]


def _pairs(fx):
    return S.similar_pairs(fx.config, GROUPS, THRESHOLD)


# What decides on a pair and its rank; the other columns of a side join the ranked pairs.
_DECIDING = ["product_key", "product_group", "moq", "is_constrained", "is_inactive"]


def _substitutes(fx):
    """Only usable targets are paired; Lab and colour name are worked out once per config."""
    usable = F.coalesce((F.col("is_inactive") == 0) & (F.col("is_constrained") == 0), F.lit(False))
    pairs = S.similar_pairs(fx.config, GROUPS, THRESHOLD, targets=usable)
    return S.substitutable_pairs(S.with_sides(pairs, S.with_color(fx.config), [*_DECIDING, "lab", "basic_color"]), MIN_COLOR, ["G3"], 0.3)


def _ranked(fx):
    return S.rank_substitutes(_substitutes(fx))


def _ranked_sides(fx):
    """Ranked pairs with all columns of both sides."""
    return S.with_sides(_ranked(fx), fx.config, [c for c in _SIDE if c not in _DECIDING])


_DOT = "list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::double * b.embedding[i]::double))"
PAIRS = f"""vec as (select *, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as len from config),
pairs as (select market, source, target, similarity from (select a.market, a.config_id as source, b.config_id as target, {_DOT} / (a.len * b.len) as similarity
  from vec a join vec b on a.market = b.market and a.product_key <> b.product_key and (a.product_group = b.product_group or (a.product_group in ('G0', 'G1') and b.product_group in ('G0', 'G1')))) p where similarity > {THRESHOLD})"""
_add("similar_pairs", lambda fx: tidy(_pairs(fx)), f"with {PAIRS} select market, source, target, round(similarity, 6) as similarity from pairs")
SUBS = f"""{PAIRS}, {ANCHORS}, {named_sql('config', 'color_hex', 'code')},
subs as (select * from (select p.*, a.product_key as source_product_key, b.product_key as target_product_key, a.product_group, a.options_json as source_options_json, b.product_version, b.options_json as target_options_json,
   1 - {cmc_sql('x.p_', 'y.p_')} / 100 as color_similarity, x.name as source_name, y.name as target_name
  from pairs p join config a on a.config_id = p.source join config b on b.config_id = p.target join named x on x.code = a.color_hex join named y on y.code = b.color_hex
  where b.is_inactive = 0 and b.is_constrained = 0 and a.moq >= b.moq) s
  where color_similarity >= case when product_group = 'G3' then 0.3 else {MIN_COLOR} end and (source_name <> 'pink' or target_name = 'pink')),
best as (select *, row_number() over (partition by source, target_product_key order by color_similarity desc, similarity desc, target) as n from subs),
ranked as (select * from (select *, row_number() over (partition by source order by similarity desc, color_similarity desc, target_product_key desc, target) as rank from best where n = 1) r where rank <= 30)"""
_add("substitutable_pairs", lambda fx: tidy(_substitutes(fx).select("market", "source", "target", "similarity", "color_similarity")),
     f"with {SUBS} select market, source, target, round(similarity, 6) as similarity, round(color_similarity, 6) as color_similarity from subs")
_add("rank_substitutes", lambda fx: tidy(_ranked(fx).select("market", "source", "target", "rank", "similarity", "color_similarity")),
     f"with {SUBS} select market, source, target, rank, round(similarity, 6) as similarity, round(color_similarity, 6) as color_similarity from ranked")


def _lists(fx):
    rows = S.substitute_lists(_ranked_sides(fx))
    return rows.select("locale_item", "options_hash", F.array_join(F.transform("products", lambda p: F.concat_ws(":", p["rank"].cast("string"), p["key"], p["version"].cast("string"))), ",").alias("products"))


_SORTED_OPT = """concat('{"Gender": "', json_extract_string(source_options_json, '$.Gender'), '", "Substrate Color": "', json_extract_string(source_options_json, '$."Substrate Color"'), '"}')"""
_add("substitute_lists", lambda fx: tidy(_lists(fx)),
     f"""with {SUBS} select upper(concat(market, '-', source_product_key)) as locale_item, md5({_SORTED_OPT}) as options_hash,
 string_agg(concat(cast(rank as string), ':', target_product_key, ':', cast(product_version as string)), ',' order by rank, source) as products from ranked group by 1, 2""")

# --- metrics --------------------------------------------------------------------------------

_EVALS = [*vocab.VOCABULARIES, "color"]


def _nearest(fx):
    """The ranks of similar pairs that the ranking metrics look at."""
    return ranking.top_k(_pairs(fx), ["source"], [F.desc("similarity"), F.asc("target")], 10)


def _evaluated(fx):
    return S.attribute_precision(_ranked_sides(fx), RELEVANT)


def _relevant_sql(attribute, group):
    groups = [g for g, attrs in RELEVANT.items() if attribute in attrs]
    return f"{group} in (" + ", ".join(f"'{g}'" for g in groups) + ")" if groups else "false"


# Verdicts stated by hand for the values the fixture holds (independent of the vocabulary code).
_AGREE = {
    "gender": """case when a.gender is null or b.gender is null then null when a.gender = b.gender then 1
  when (a.gender = 'MEN OR WOMEN' and b.gender in ('MEN', 'WOMEN')) or (b.gender = 'MEN OR WOMEN' and a.gender in ('MEN', 'WOMEN')) then 1 else 0 end""",
    "type": """case when a.type = 'mystery' or b.type = 'mystery' then null when a.type = b.type then 1 when a.type in ('JACKET', 'SOFTSHELL') and b.type in ('JACKET', 'SOFTSHELL') then 1
  when a.type in ('T-SHIRT', 'SHIRT') and b.type in ('T-SHIRT', 'SHIRT') then 1 else 0 end""",
    "decoration_technology": """case when a.decoration_technology is null or b.decoration_technology is null then null when a.decoration_technology = b.decoration_technology then 1
  when a.decoration_technology in ('SCREEN PRINTING', 'SINGLE COLOR') and b.decoration_technology in ('SCREEN PRINTING', 'SINGLE COLOR') then 1 else 0 end""",
    "decoration_location": """case when a.decoration_location is null or b.decoration_location is null or a.decoration_location = 'roof' or b.decoration_location = 'roof' then null
  when a.decoration_location = b.decoration_location then 1
  when a.decoration_location in ('LEFT CHEST', 'CENTERED ON POCKET') and b.decoration_location in ('LEFT CHEST', 'CENTERED ON POCKET') then 1
  when a.decoration_location in ('RIGHT CHEST', 'CENTERED ON POCKET') and b.decoration_location in ('RIGHT CHEST', 'CENTERED ON POCKET') then 1
  when a.decoration_location in ('FULL FRONT', 'FRONT AND BACK') and b.decoration_location in ('FULL FRONT', 'FRONT AND BACK') then 1
  when a.decoration_location in ('BACK', 'FRONT AND BACK') and b.decoration_location in ('BACK', 'FRONT AND BACK') then 1 else 0 end""",
    "sleeve_style": """case when a.sleeve_style is null or b.sleeve_style is null then null when a.sleeve_style = b.sleeve_style then 1
  when a.sleeve_style <> 'LONG SLEEVE' and b.sleeve_style <> 'LONG SLEEVE' then 1 else 0 end""",
    "fit_type": "case when a.fit_type = b.fit_type then 1 else 0 end",
}
EVALS = f"""{SUBS},
evals as (select p.market, p.source, p.target, a.product_group, p.rank,
 {', '.join(f"case when {_relevant_sql(n, 'a.product_group')} then {sql} end as {n}_eval" for n, sql in _AGREE.items())},
 1 - {cmc_sql('x.p_', 'y.p_')} / 100 as color_eval
 from ranked p join config a on a.config_id = p.source join config b on b.config_id = p.target join named x on x.code = a.color_hex join named y on y.code = b.color_hex)"""
_add("attribute_precision", lambda fx: tidy(_evaluated(fx).select("source", "target", "rank", *[f"{n}_eval" for n in _EVALS])),
     f"with {EVALS} select source, target, rank, {', '.join(f'{n}_eval::bigint as {n}_eval' for n in _AGREE)}, round(color_eval, 6) as color_eval from evals")
_add("precision_at_k", lambda fx: tidy(S.precision_at_k(_evaluated(fx))),
     f"with {EVALS} select * from (" + " union all ".join(
         f"select market, {g} as product_group, {k}::bigint as metric_at, '{n}' as metric_name, round(avg(case when rank <= {k} then {n}_eval end)::double, 6) as metric_score from evals group by 1, 2"
         for g in ("product_group", "'Overall'") for n in _EVALS for k in (5, 10, 15)) + ") m where metric_score is not null")
_add("vocabulary_cross_check", lambda fx: tidy(S.vocabulary_cross_check(fx.config, ["gender", "type", "sleeve_style", "fit_type"])),
     " union all ".join(
         f"select '{n}' as attribute, a.{n} as first, b.{n} as second, ({_AGREE[n]})::bigint as agrees from (select distinct {n} from config where {n} is not null and {n} <> 'mystery') a cross join (select distinct {n} from config where {n} is not null and {n} <> 'mystery') b"
         for n in ("gender", "type", "sleeve_style", "fit_type")))


def _vocabulary(fx):
    rows = [(n, v) for n, voc in vocab.VOCABULARIES.items() for v in voc.values()]
    return fx.spark.createDataFrame(rows, "attribute string, value string")


_add("undefined_values", lambda fx: tidy(quality.undefined_values(fx.config, _vocabulary(fx), list(vocab.VOCABULARIES))),
     """select 'type' as attribute, type as value from config where type = 'mystery' group by 2
 union all select 'decoration_location', decoration_location from config where decoration_location = 'roof' group by 2""")

_IDS = [f"cfg{i}" for i in range(0, 500, 25)]


def _topk(fx):
    mine = S.similar_pairs(fx.config, GROUPS, THRESHOLD, sources=F.col("config_id").isin(_IDS))
    rows = S.with_sides(mine, fx.config, _SIDE).withColumns({"_a": color.hex_to_lab(F.col("source_color_hex")), "_b": color.hex_to_lab(F.col("target_color_hex"))})
    rows = rows.withColumn("color_distance", 1 - color.color_similarity(F.col("_a"), F.col("_b")))
    return S.topk_similar(rows, _IDS, 5)


TOPK = f"""{PAIRS}, {ANCHORS}, {named_sql('config', 'color_hex', 'code')},
near as (select p.*, b.product_key as tk, 1 - (1 - {cmc_sql('x.p_', 'y.p_')} / 100) as d from pairs p join config a on a.config_id = p.source join config b on b.config_id = p.target
  join named x on x.code = a.color_hex join named y on y.code = b.color_hex where p.source in ({', '.join(f"'{i}'" for i in _IDS)})),
topk as (select * from (select *, row_number() over (partition by source order by similarity desc, target) as rank from (select *, row_number() over (partition by source, tk order by d, target) as n from near) z where n = 1) y where rank <= 5)"""
_add("topk_similar", lambda fx: tidy(_topk(fx).select("source", "target", "rank", "similarity")),
     f"with {TOPK} select source, target, rank, round(similarity, 6) as similarity from topk")
_add("side_by_side", lambda fx: tidy(S.side_by_side(_topk(fx), fx.config, ["gender", "type", "moq"])),
     f"with {TOPK} " + " union all ".join(
         f"select t.source, t.target, t.rank, '{n}' as attribute, cast(a.{n} as string) as source_value, cast(b.{n} as string) as target_value from topk t join config a on a.config_id = t.source join config b on b.config_id = t.target"
         for n in ("gender", "type", "moq")))


def _judged(fx):
    ids = F.sequence(F.lit(1), F.lit(8))
    total = F.broadcast(fx.config.agg(F.count("*").cast("int").alias("total")))  # one row
    rows = fx.config.select(F.col("config_id").alias("source"), F.expr("cast(substring(config_id, 4) as int)").alias("n"), F.explode(ids).alias("position")).crossJoin(total)
    return rows.select("source", F.concat(F.lit("cfg"), ((F.col("n") + F.col("position") * 20) % F.col("total")).cast("string")).alias("target"), "position")


_add("ranking_quality", lambda fx: tidy(S.ranking_quality(_nearest(fx).select("source", "target", "rank"), _judged(fx))),
     f"""with {PAIRS}, ret as (select source, target, row_number() over (partition by source order by similarity desc, target) as rank from pairs),
judged as (select config_id as source, concat('cfg', cast((cast(substring(config_id, 4) as int) + pos * 20) % total as string)) as target, pos from (select config_id, unnest(range(1, 9)) as pos, (select count(*) from config) as total from config) c),
rel as (select r.source, r.rank, coalesce(8 - j.pos + 1, 0) as relevance, k from ret r left join judged j on j.source = r.source and j.target = r.target, (values (5), (10)) ks(k) where r.rank <= k),
ideal as (select *, row_number() over (partition by source, k order by relevance desc, rank) as ir from rel)
select source, ideal.k::bigint as k, count(*) filter (relevance > 0) / ideal.k as precision, round(coalesce(sum(relevance / log2(rank + 1.0)) / nullif(sum(relevance / log2(ir + 1.0)), 0), 0), 6) as ndcg from ideal group by source, ideal.k""")

_QUERY = [((i * 37) % 19 - 9) / 10.0 for i in range(64)]
_QUERY_SQL = "[" + ", ".join(f"{x}::double" for x in _QUERY) + "]"
_SCORE = f"round(list_sum(list_transform(range(1, 65), lambda i: embedding[i]::double * {_QUERY_SQL}[i])) / (sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) * sqrt(list_sum(list_transform({_QUERY_SQL}, lambda x: x * x)))), 9)"


def _query_vector():
    return F.array(*[F.lit(x) for x in _QUERY])


def _searchable(fx):
    return fx.config.select(F.col("config_id").alias("item_id"), "product_group", "embedding")


_add("vector_search", lambda fx: tidy(S.vector_search(_searchable(fx), _query_vector(), 20)),
     f"select item_id, product_group, round(s, 6) as similarity from (select config_id as item_id, product_group, {_SCORE} as s from config) x order by s desc, item_id limit 20")
_add("vector_search_by_group", lambda fx: tidy(S.vector_search_by_group(_searchable(fx), _query_vector(), "product_group")),
     f"""select item_id, product_group, round(s, 6) as similarity from (select *, row_number() over (partition by product_group order by s desc, item_id) as n
 from (select config_id as item_id, product_group, {_SCORE} as s from config) x) y where n = 1""")
_add("options_hash", lambda fx: tidy(fx.config.select("config_id", text.options_hash(F.from_json("options_json", "map<string,string>")).alias("options_hash"))),
     f"select config_id, md5({_SORTED_OPT.replace('source_options_json', 'options_json')}) as options_hash from config")
