"""Similar products: blocked exact cosine pairs, substitutes, precision, search."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinora import config
from affinora.functions import color, text, vector, vocab
from affinora.operators import ranking


def group_pairs(df: DataFrame, table: dict[str, list[str]]) -> DataFrame:
    """Explode each row over the product groups it may be compared with (a fixed small table)."""
    mapping = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*[F.lit(g) for g in v]))])
    return df.withColumn("_target_group", F.explode(F.try_element_at(mapping, F.col("product_group"))))


def similar_pairs(
    configs: DataFrame, groups: dict[str, list[str]] | None = None, threshold: float = config.SIMILARITY_THRESHOLD,
    targets: Column | None = None, tile: int = config.VECTOR_TILE, id_column: str = "config_id", sources: Column | None = None,
) -> DataFrame:
    """(source, target, similarity) of one market, different products, comparable groups, cosine above the threshold.

    Exact, without materialising the pairs of a block:

    1. ``targets`` and ``sources`` filter their sides before anything is paired.
    2. Vectors are normalised; each falls into a band by its angle to a fixed direction. Two vectors
       whose cosine exceeds the threshold differ by at most ``acos(threshold)`` in that angle, so
       only neighbouring bands can match.
    3. A band of a (market, group) block is split into tiles of about ``tile`` vectors. Each pair of
       tiles is one cogroup key: a hot block becomes many bounded tasks, and a task multiplies two
       bounded matrices and emits only the pairs above the threshold.
    """
    if groups is None:
        groups = vocab.COMPARABLE_GROUPS
    unit = vector.normalised(F.col("embedding"))
    reach = math.acos(threshold)
    width = reach / 2.0
    # angle to the all-ones direction
    lean = F.aggregate("_unit", F.lit(0.0), lambda s, x: s + x) / F.sqrt(F.size("_unit").cast("double"))
    angle = F.acos(F.greatest(F.least(lean, F.lit(1.0)), F.lit(-1.0)))
    rows = (
        configs.filter(vector.norm(F.col("embedding")) > 0)
        .select(F.col(id_column).alias("id"), "market", "product_key", "product_group", unit.alias("_unit"),
                (targets if targets is not None else F.lit(True)).alias("_is_target"), (sources if sources is not None else F.lit(True)).alias("_is_source"))
        .withColumn("_band", F.floor(angle / width).cast("int"))
    )
    block = ["market", "product_group", "_band"]
    # the split count comes from the block's row count: one small aggregate row per band
    sizes = rows.groupBy(*block).agg(
        F.ceil(F.count_if(F.coalesce("_is_source", F.lit(False))) / tile).cast("int").alias("_n_source"),
        F.ceil(F.count_if(F.coalesce("_is_target", F.lit(False))) / tile).cast("int").alias("_n_target"),
    )
    bands = math.ceil(reach / width)
    near = F.explode(F.sequence(F.col("_band") - bands, F.col("_band") + bands))
    source_blocks = group_pairs(sizes.filter("_n_source > 0").select(*block, "_n_source"), groups).withColumn("_tband", near)
    target_blocks = sizes.filter("_n_target > 0").select(
        "market", F.col("product_group").alias("_target_group"), F.col("_band").alias("_tband"), "_n_target"
    )
    block_pairs = source_blocks.join(target_blocks, ["market", "_target_group", "_tband"])

    def slot(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    key = ["market", "product_group", "_band", "_target_group", "_tband", "_s", "_t"]
    left = (
        rows.filter("_is_source").join(block_pairs, block).withColumn("_s", slot("_n_source"))
        .withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_n_target") - 1)))
        .select(*key, "id", "product_key", "_unit")
    )
    right = (
        rows.filter("_is_target").withColumnsRenamed({"product_group": "_target_group", "_band": "_tband"})
        .join(block_pairs, ["market", "_target_group", "_tband"]).withColumn("_t", slot("_n_target"))
        .withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_n_source") - 1)))
        .select(*[F.col(c).alias(f"t{c}") for c in (*key, "id", "product_key", "_unit")])
    )

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"market": pd.Series(dtype=str), "source": pd.Series(dtype=str),
                              "target": pd.Series(dtype=str), "similarity": pd.Series(dtype=float)})
        if a.empty or b.empty:
            return empty
        left_m, right_m = np.stack(a["_unit"].to_numpy()), np.stack(b["t_unit"].to_numpy())
        right_keys = b["tproduct_key"].to_numpy()
        out = []
        step = 512
        for start in range(0, len(a), step):
            scores = left_m[start : start + step] @ right_m.T
            keep = (scores > threshold) & (a["product_key"].to_numpy()[start : start + step, None] != right_keys[None, :])
            i, j = np.nonzero(keep)
            out.append(pd.DataFrame({
                "market": a["market"].iloc[0], "source": a["id"].to_numpy()[start + i], "target": b["tid"].to_numpy()[j],
                "similarity": scores[i, j],
            }))
        return pd.concat(out, ignore_index=True)

    return left.groupBy(*key).cogroup(right.groupBy(*[f"t{c}" for c in key])).applyInPandas(
        multiply, "market string, source string, target string, similarity double"
    )


def with_sides(pairs: DataFrame, configs: DataFrame, columns: Sequence[str], id_column: str = "config_id") -> DataFrame:
    """Attach source_* and target_* columns to the surviving pairs.

    The source joins last, so the pairs lie by source and are ranked per source without another shuffle.
    """
    side = configs.select(id_column, *columns)
    source = side.toDF("source", *[f"source_{c}" for c in columns])
    target = side.toDF("target", *[f"target_{c}" for c in columns])
    own = [c for c in pairs.columns if c not in ("source", "target")]
    return pairs.join(target, "target").join(source, "source").select("target", "source", *own, *source.columns[1:], *target.columns[1:])


def with_color(configs: DataFrame) -> DataFrame:
    """Configs with their Lab colour and the name of the nearest basic colour."""
    labs = configs.withColumn("lab", color.hex_to_lab(F.col("color_hex")))
    return labs.withColumn("basic_color", color.nearest_basic_color(F.col("lab")))


def substitutable_pairs(
    sided: DataFrame, min_color: float = config.COLOR_THRESHOLD, relaxed_groups: Sequence[str] = ("Bottoms",),
    relaxed_color: float = config.COLOR_THRESHOLD_RELAXED, exact_names: Sequence[str] = ("pink",),
) -> DataFrame:
    """Active, unconstrained targets with a smaller or equal minimum quantity and a close colour.

    Both sides carry ``lab`` and ``basic_color`` of ``with_color``, worked out per config and not per pair.
    """
    usable = sided.filter(
        "target_is_inactive = 0 and target_is_constrained = 0 and source_moq >= target_moq"
    )
    near = usable.withColumn("color_similarity", color.color_similarity(F.col("source_lab"), F.col("target_lab")))
    relaxed = F.col("source_product_group").isin(list(relaxed_groups))
    near = near.filter(F.when(relaxed, F.col("color_similarity") >= relaxed_color).otherwise(F.col("color_similarity") >= min_color))
    if exact_names:
        own = F.col("source_basic_color")
        near = near.filter(~own.isin(list(exact_names)) | (own == F.col("target_basic_color")))
    return near.drop("source_lab", "target_lab", "source_basic_color", "target_basic_color")


def rank_substitutes(pairs: DataFrame, top: int = config.SIMILARITY_TOP) -> DataFrame:
    """Best config per target product by colour, then the best products by similarity."""
    best = ranking.latest(
        pairs, ["source", "target_product_key"], [F.desc("color_similarity"), F.desc("similarity"), F.asc("target")]
    )
    return ranking.top_k(
        best, ["source"], [F.desc("similarity"), F.desc("color_similarity"), F.desc("target_product_key"), F.asc("target")], top
    )


def substitute_lists(ranked: DataFrame) -> DataFrame:
    """One row per (market-product, options hash) with the ordered list of substitutes."""
    options = F.from_json("source_options_json", "map<string,string>")
    entry = F.struct(
        "rank", "source", F.col("target_product_key").alias("key"), F.col("target_product_version").alias("version"),
        F.round("similarity", 5).alias("similarity"), F.round("color_similarity", 5).alias("color_similarity"), F.col("target_options_json").alias("options"),
    )
    return ranked.select(
        F.upper(F.concat_ws("-", "market", "source_product_key")).alias("locale_item"), text.options_hash(options).alias("options_hash"), entry.alias("e")
    ).groupBy("locale_item", "options_hash").agg(F.array_sort(F.collect_list("e")).alias("products"))


def attribute_precision(pairs: DataFrame, relevant: dict[str, list[str]] | None = None) -> DataFrame:
    """1, 0 or null per attribute and pair; colour enters as a similarity. Irrelevant attributes are null."""
    relevant = vocab.RELEVANT if relevant is None else relevant
    group = F.col("source_product_group")
    cols = {}
    for name, vocabulary in vocab.VOCABULARIES.items():
        cols[f"{name}_eval"] = F.when(
            vocab.is_relevant(group, name, relevant), vocabulary.agrees(F.col(f"source_{name}"), F.col(f"target_{name}"))
        )
    shade = color.color_similarity(F.col("_a"), F.col("_b"))
    cols["color_eval"] = F.when(vocab.is_relevant(group, "color", relevant), shade)
    labs = pairs.withColumns({"_a": color.hex_to_lab(F.col("source_color_hex")), "_b": color.hex_to_lab(F.col("target_color_hex"))})
    return labs.withColumns(cols).drop("_a", "_b")


def precision_at_k(evaluated: DataFrame, ks: Sequence[int] = (5, 10, 15)) -> DataFrame:
    """Mean attribute score within the first k ranks, per market and group and overall, in long form."""
    names = [*vocab.VOCABULARIES, "color"]
    aggs = {f"{n}@{k}": F.avg(F.when(F.col("rank") <= k, F.col(f"{n}_eval"))) for n in names for k in ks}
    grouped = evaluated.groupingSets(
        [[F.col("market"), F.col("source_product_group")], [F.col("market")]], F.col("market"), F.col("source_product_group")
    ).agg(F.grouping("source_product_group").alias("_overall"), *[c.alias(a) for a, c in aggs.items()])
    rows = F.array(*[
        F.struct(F.lit(k).alias("metric_at"), F.lit(n).alias("metric_name"), F.col(f"`{n}@{k}`").cast("double").alias("metric_score"))
        for n in names for k in ks
    ])
    label = F.when(F.col("_overall") == 1, "Overall").otherwise(F.col("source_product_group"))
    return grouped.select("market", label.alias("product_group"), F.explode(rows).alias("m")).select(
        "market", "product_group", "m.*"
    ).filter("metric_score is not null")


def vocabulary_cross_check(configs: DataFrame, attributes: Sequence[str] | None = None) -> DataFrame:
    """Truth table of each rule over the observed defined values.

    Undefined values always evaluate to null, so they are left to the undefined-values report; what
    remains is bounded by the vocabulary size, whatever the data holds.
    """
    names = list(attributes or vocab.VOCABULARIES)
    seen = configs.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("attribute"), F.upper(F.col(n)).alias("value")) for n in names
    ])).alias("s")).select("s.*").filter(
        functools.reduce(lambda a, b: a | b, [(F.col("attribute") == n) & F.col("value").isin(vocab.VOCABULARIES[n].values()) for n in names])
    ).distinct()
    pairs = seen.withColumnRenamed("value", "first").join(seen.withColumnRenamed("value", "second"), "attribute")
    verdict = functools.reduce(
        lambda e, n: F.when(F.col("attribute") == n, vocab.VOCABULARIES[n].agrees(F.col("first"), F.col("second"))).otherwise(e),
        names, F.lit(None).cast("int"),
    )
    return pairs.withColumn("agrees", verdict)


def topk_similar(pairs: DataFrame, ids: Sequence[str], k: int = 5) -> DataFrame:
    """k most similar products of chosen configs; the filter comes before the joins and the ranking.

    Per target product the config with the smallest colour distance stands in.
    """
    mine = pairs.filter(F.col("source").isin(list(ids)))
    one = ranking.latest(mine, ["source", "target_product_key"], [F.asc("color_distance"), F.asc("target")])
    return ranking.top_k(one, ["source"], [F.desc("similarity"), F.asc("target")], k)


def side_by_side(top: DataFrame, configs: DataFrame, attributes: Sequence[str], id_column: str = "config_id") -> DataFrame:
    """Source and target attribute values next to each other, one row per attribute."""
    sided = with_sides(top.select("source", "target", "rank"), configs, attributes, id_column)
    rows = F.array(*[
        F.struct(F.lit(a).alias("attribute"), F.col(f"source_{a}").cast("string").alias("source_value"), F.col(f"target_{a}").cast("string").alias("target_value"))
        for a in attributes
    ])
    return sided.select("source", "target", "rank", F.explode(rows).alias("r")).select("source", "target", "rank", "r.*")


def ranking_quality(retrieved: DataFrame, judged: DataFrame, ks: Sequence[int] = (5, 10)) -> DataFrame:
    """precision@k and NDCG@k per source against an ordered judged list.

    A judged target's relevance is the list length at position 1 down to 1 at the end; the ideal order
    sorts the relevances that were retrieved within k.
    """
    length = judged.groupBy("source").agg(F.count(F.lit(1)).alias("_length"))
    relevance = judged.join(length, "source").select("source", "target", (F.col("_length") - F.col("position") + 1).alias("relevance"))
    rows = retrieved.join(length.select("source"), "source", "left_semi").join(relevance, ["source", "target"], "left").select(
        "source", "rank", F.coalesce("relevance", F.lit(0)).alias("relevance")
    )
    per_k = rows.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).filter("rank <= k")
    ideal = ranking.with_row_number(per_k, ["source", "k"], [F.desc("relevance"), F.asc("rank")], "ideal_rank")

    def gain(position: str) -> Column:
        return F.sum(F.col("relevance") / F.log2(F.col(position) + 1.0))

    scored = ideal.groupBy("source", "k").agg(
        F.count_if(F.col("relevance") > 0).alias("hits"), gain("rank").alias("dcg"), gain("ideal_rank").alias("idcg")
    )
    return scored.select(
        "source", "k", (F.col("hits") / F.col("k")).alias("precision"),
        F.coalesce(F.try_divide("dcg", "idcg"), F.lit(0.0)).alias("ndcg"),
    )


def vector_search(items: DataFrame, query: Column, k: int = 20, vector_column: str = "embedding", key: str = "item_id") -> DataFrame:
    """k items with the largest cosine to one query vector: a scan with a partial top-k, no shuffle of the items."""
    scored = items.withColumn("similarity", F.round(vector.cosine(F.col(vector_column), query), 9)).drop(vector_column)
    return scored.orderBy(F.desc("similarity"), F.asc(key)).limit(k)


def vector_search_by_group(items: DataFrame, query: Column, group: str, vector_column: str = "embedding", key: str = "item_id") -> DataFrame:
    """Best item of each group, best group first."""
    scored = items.withColumn("similarity", F.round(vector.cosine(F.col(vector_column), query), 9)).drop(vector_column)
    return ranking.latest(scored, [group], [F.desc("similarity"), F.asc(key)]).orderBy(F.desc("similarity"), F.asc(key))
