"""Products from nested listing JSON: cards, variants, catalogue items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.pricing import IN_STOCK, coerce_price, currency, was_of_offer
from shelfspark.functions.vocabulary import SIZE_NAMES
from shelfspark.operators.history import first_seen

_MONEY = "struct<currency:string,amount:double,denominator:int>"
_PRICES = f"struct<actual:{_MONEY},regular:{_MONEY},old:{_MONEY}>"
CARDS = (
    "data struct<cards:array<struct<cardType:string,product:struct<itemId:string,mainVariantItemId:string,brand:string,name:string,productType:string,url:string,inStock:boolean,"
    f"price:{_PRICES},attributes:struct<units:struct<count:int,currentUnitValue:string,name:string>,colors:struct<count:int>>>>>>"
)
VARIANTS = (
    "data struct<itemId:string,brand:string,productType:string,attributes:struct<units:struct<label:string,unit:string>>,variants:array<struct<itemId:string,mainVariantItemId:string,name:string,url:string,"
    f"inStock:boolean,attributesValue:struct<units:string,colors:string>,price:{_PRICES}>>>"
)
ITEMS = "id long, brandName string, groupName string, minPrice double, realMinPrice double, enableDiscount boolean, attributes array<struct<name:string,value:string>>"
ITEM_VARIANTS = (
    "id long, attributes array<struct<id:long,price:double,realPrice:double,enableDiscount:boolean>>, selectAttributes array<struct<name:string,values:array<struct<itemPriceId:long,value:string>>>>"
)


def compose_name(*parts: Column) -> Column:
    return F.trim(F.concat_ws(" ", *(F.nullif(p, F.lit("")) for p in parts)))


def compose_volume(value: Column, unit: Column) -> Column:
    return F.when((F.coalesce(value, F.lit("")) != "") & (F.coalesce(unit, F.lit("")) != ""), F.concat_ws(" ", value, unit))


def _offer(price: str) -> dict[str, Column]:
    amount = lambda kind: coerce_price(F.col(f"{price}.{kind}.amount"))
    current = F.coalesce(amount("actual"), amount("regular"))
    return {"current_price": current, "was_price": was_of_offer(current, amount("old"), amount("regular")), "currency": currency(F.nullif(F.col(f"{price}.actual.currency"), F.lit("")))}


def _stock(flag: str) -> Column:
    return F.when(F.coalesce(F.col(flag), F.lit(False)), "InStock").otherwise("OutOfStock")


def _raw(rows: DataFrame, fields: dict[str, Column], carried: list[str]) -> DataFrame:
    order = ("sku_id", "url", "name", "brand_raw", "current_price", "was_price", "currency", "availability", "raw_volume_text")
    return rows.select(*carried, *(fields[c].alias(c) for c in order)).filter(F.col("sku_id").isNotNull() & F.col("current_price").isNotNull())


def card_products(pages: DataFrame, host: str, carried: list[str] | None = None) -> DataFrame:
    """Raw products of listing pages (schema CARDS): product cards with id, brand, name and a sane price."""
    p = F.col("p")
    rows = pages.select(*(carried or []), F.explode("data.cards").alias("card")).filter("card.cardType = 'product'").select(*(carried or []), F.col("card.product").alias("p"))
    brand, name = F.trim(p["brand"]), F.trim(p["name"])
    rows = rows.filter((F.coalesce(brand, F.lit("")) != "") & (F.coalesce(name, F.lit("")) != ""))
    units = p["attributes"]["units"]
    return _raw(rows, _offer("p.price") | {
        "sku_id": F.coalesce(F.nullif(p["itemId"], F.lit("")), p["mainVariantItemId"]), "url": F.concat(F.lit(host), F.coalesce(p["url"], F.lit(""))), "name": compose_name(F.trim(p["productType"]), brand, name),
        "brand_raw": brand, "availability": _stock("p.inStock"), "raw_volume_text": compose_volume(units["currentUnitValue"], units["name"]),
    }, carried or [])


def variant_products(pages: DataFrame, host: str, carried: list[str] | None = None) -> DataFrame:
    """Raw products of product pages (schema VARIANTS), one for each variant: brand, type and unit of the parent, shade after the name."""
    rows = pages.select(*(carried or []), F.col("data").alias("d"), F.explode("data.variants").alias("v"))
    d, v = F.col("d"), F.col("v")
    sku = F.coalesce(F.nullif(v["itemId"], F.lit("")), v["mainVariantItemId"])
    return _raw(rows, _offer("v.price") | {
        "sku_id": sku, "url": F.concat(F.lit(host), F.coalesce(F.nullif(v["url"], F.lit("")), F.concat(F.lit("/"), sku, F.lit("-")))),
        "name": compose_name(d["productType"], d["brand"], v["name"], v["attributesValue"]["colors"]), "brand_raw": F.coalesce(d["brand"], F.lit("")), "availability": _stock("v.inStock"),
        "raw_volume_text": compose_volume(v["attributesValue"]["units"], d["attributes"]["units"]["unit"]),
    }, carried or [])


def with_variants(cards: DataFrame, card_pages: DataFrame, variant_pages: DataFrame, host: str) -> DataFrame:
    """Cards and, for cards that name several units or colours, their variants; a card wins over a variant with its sku."""
    many = card_pages.select(F.explode("data.cards").alias("c")).filter((F.coalesce("c.product.attributes.units.count", F.lit(0)) > 1) | (F.coalesce("c.product.attributes.colors.count", F.lit(0)) > 1))
    masters = many.select(F.col("c.product.itemId").alias("__master")).distinct()
    extra = variant_products(variant_pages.join(masters, F.col("data.itemId") == F.col("__master"), "left_semi"), host)
    both = cards.withColumn("__source", F.lit(0)).unionByName(extra.withColumn("__source", F.lit(1)))
    return first_seen(both, ["sku_id"], ["__source", "url", "name"]).drop("__source")


def sizes_of(attributes: Column) -> Column:
    """The non-empty size values of an attribute array, in order."""
    named = F.filter(attributes, lambda a: F.lower(F.trim(a["name"])).isin(SIZE_NAMES) & (F.trim(F.coalesce(a["value"], F.lit(""))) != ""))
    return F.coalesce(F.transform(named, lambda a: F.trim(a["value"])), F.array().cast("array<string>"))


def size_lookup(variant_pages: DataFrame) -> DataFrame:
    """(id, item_price_id, size) from the select attributes of product pages (schema ITEM_VARIANTS)."""
    rows = variant_pages.select("id", F.explode("selectAttributes").alias("s")).filter(F.lower(F.trim("s.name")).isin([*SIZE_NAMES, "size"]))
    return rows.select("id", F.explode("s.values").alias("v")).select("id", F.col("v.itemPriceId").alias("item_price_id"), F.col("v.value").alias("size"))


def catalogue_products(items: DataFrame, variant_pages: DataFrame, host: str) -> DataFrame:
    """Raw products of catalogue items (schema ITEMS): one row at the lowest price for up to one size, one for each variant for more, and a
    flagged row where the variants are missing."""
    rows = items.filter(F.col("id").isNotNull() & (F.trim(F.coalesce("brandName", F.lit(""))) != "") & (F.trim(F.coalesce("groupName", F.lit(""))) != "") & (F.coalesce("minPrice", F.lit(0.0)) != 0)).withColumn("sizes", sizes_of(F.col("attributes")))
    variants = variant_pages.select("id", F.explode("attributes").alias("a")).select("id", F.col("a.id").alias("item_price_id"), "a.price", "a.realPrice").dropna(subset=["item_price_id", "price"])
    sized = variants.join(size_lookup(variant_pages), ["id", "item_price_id"], "left").withColumnsRenamed({"price": "v_price", "realPrice": "v_real"})
    joined = rows.filter(F.size("sizes") > 1).join(sized, "id", "left")
    single = rows.filter(F.size("sizes") <= 1).select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("item_price_id", "long"), ("v_price", "double"), ("v_real", "double"), ("size", "string"))))
    every = joined.unionByName(single)
    has = F.col("item_price_id").isNotNull()
    price = F.coalesce("v_price", "minPrice").cast("long")
    discounted = F.coalesce("enableDiscount", F.lit(False)) & (F.coalesce("realMinPrice", F.lit(0.0)) != 0) & (F.col("realMinPrice") != F.col("minPrice"))
    was = F.when(has, F.when((F.coalesce("v_real", F.lit(0.0)) != 0) & (F.col("v_real") != F.col("v_price")), F.col("v_real"))).when((F.size("sizes") <= 1) & discounted, F.col("realMinPrice")).cast("long")
    key = F.col("id").cast("string")
    return every.select(
        F.when(has, F.concat_ws("-", key, F.col("item_price_id").cast("string"))).otherwise(key).alias("sku_id"), F.concat(F.lit(f"{host}/item/"), key).alias("url"), F.trim("groupName").alias("name"), F.trim("brandName").alias("brand_raw"),
        price.alias("current_price"), was.alias("was_price"), F.lit("KZT").alias("currency"), F.lit(IN_STOCK).alias("availability"),
        F.coalesce(F.nullif("size", F.lit("")), F.try_element_at("sizes", F.lit(1))).alias("raw_volume_text"), ((F.size("sizes") > 1) & ~has).alias("parse_error_flag"),
    )
