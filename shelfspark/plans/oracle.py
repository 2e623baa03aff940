"""The registered queries in DuckDB's SQL, written from the rules and not from the Spark expressions."""

from __future__ import annotations

from shelfspark.functions.vocabulary import BODY_BUCKETS, BODY_STEMS, FACE_BUCKETS, PALETTE_STEMS, PERFUME_STEMS, PRODUCT_STEMS, STOPWORDS, VARIANT_MARKERS
from shelfspark.sources.adapter import OTHER_PHRASE, PHRASES, SPLIT_YEAR


def strings(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def first_stem(words: str, stems) -> str:
    cases = " ".join(f"WHEN starts_with(w, '{s}') THEN '{b}'" for s, b in stems)
    return f"list_filter(list_transform({words}, lambda w: CASE {cases} END), lambda y: y IS NOT NULL)[1]"


def name_norm(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(strip_accents(lower(coalesce({x}, ''))), '[^\p{{L}}\p{{N}}_\s]+', ' ', 'g'), '\s+', ' ', 'g'))"


def slug(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(strip_accents(lower({x})), '[''’ʼʹ]', '', 'g'), '[^a-z0-9а-яёәғқңөұүһі]+', '-', 'g'), '-')"


_PHRASE = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PHRASES.items()) + f" ELSE '{OTHER_PHRASE}' END"

SNAPSHOTS = f"""
raw AS (
  SELECT r.run_id, 'base' AS retailer, CAST(p_partkey AS VARCHAR) AS sku_id, 'https://base.example/item/' || p_partkey AS url, {_PHRASE} || ' ' || p_name AS name, p_brand AS brand,
         CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN '3 x ' || p_size || ' мл' ELSE p_size || ' мл' END AS volume_raw,
         CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN '(' || p_size || ',ml,3)' ELSE '(' || p_size || ',ml,1)' END AS volume_norm,
         p_partkey % 10 <> 0 AND p_partkey % 17 = 0 AS multipack_flag, CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS current_price,
         CASE WHEN p_partkey % 4 = 0 THEN CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) + 2500 END AS was_price,
         CASE WHEN p_partkey % 29 = 0 THEN 'DELISTED' WHEN p_partkey % 13 = 0 THEN 'OUT_OF_STOCK' ELSE 'IN_STOCK' END AS stock_state
  FROM part, (VALUES (CAST(1 AS BIGINT)), (2)) r(run_id)
  UNION ALL
  SELECT o.run_id, 'competitor', 'c' || p_partkey, 'https://competitor.example/' || p_partkey || '-' || replace(p_name, ' ', '-'),
         CASE WHEN p_partkey % 11 = 0 THEN '{OTHER_PHRASE}' ELSE {_PHRASE} END || ' ' || p_name || CASE WHEN p_partkey % 6 = 0 THEN ' intense' ELSE '' END, p_brand,
         CASE WHEN p_partkey % 9 <> 0 THEN p_size || ' ml' END, CASE WHEN p_partkey % 9 <> 0 THEN '(' || p_size || ',ml,1)' END, false, o.price,
         CASE WHEN p_partkey % 7 = 0 THEN o.price + 1000 END, CASE WHEN p_partkey % 31 = 0 THEN 'DELISTED' ELSE 'IN_STOCK' END
  FROM part JOIN (SELECT CASE WHEN year(l_shipdate) < {SPLIT_YEAR} THEN 1 ELSE 2 END AS run_id, l_partkey, CAST(max(floor(l_extendedprice * 100 / l_quantity + 0.5)) AS BIGINT) AS price
                  FROM lineitem GROUP BY 1, 2) o ON o.l_partkey = p_partkey),
snapshots AS (
  SELECT *, {slug('brand')} AS brand_norm, {name_norm('name')} AS name_norm, false AS parse_error_flag, 'KZT' AS currency FROM raw)
"""

_WORDS = "list_filter(string_split(name_norm, ' '), lambda x: regexp_full_match(x, '[а-яё-]{3,}'))"

FEATURES = f"""
worded AS (SELECT *, {_WORDS} AS every, list_distinct(regexp_extract_all(name_norm, '[a-z0-9]{{3,}}')) AS own,
                  list_distinct(list_filter(string_split(regexp_extract(url, '://[^/]+/[0-9]+-([a-z0-9-]+)', 1), '-'), lambda x: length(x) >= 3)) AS slug_tokens,
                  list_filter(regexp_split_to_array(brand_norm, '[-_\\s]+'), lambda x: length(x) >= 3) AS brand_tokens
           FROM snapshots WHERE NOT multipack_flag AND stock_state <> 'DELISTED' AND current_price IS NOT NULL),
heads AS (SELECT *, every[1:3] AS three, CASE WHEN retailer = 'base' THEN own ELSE list_distinct(list_concat(slug_tokens, own)) END AS tokens FROM worded),
stripped AS (SELECT *, CASE WHEN NOT starts_with(coalesce(three[1], ''), 'рефил') THEN three WHEN NOT starts_with(coalesce(three[2], ''), 'рефил') THEN three[2:] WHEN NOT starts_with(coalesce(three[3], ''), 'рефил') THEN three[3:] ELSE [] END AS words FROM heads),
based AS (SELECT *, {first_stem("list_concat(flatten(list_transform(words, lambda x: list_transform(list_filter(words, lambda y: y <> x), lambda y: x || '-' || y))), words)", PRODUCT_STEMS)} AS base,
                 {first_stem('every', PALETTE_STEMS)} AS palette, {first_stem('every', PERFUME_STEMS)} AS perfume, {first_stem('every', BODY_STEMS)} AS part_of
          FROM stripped),
features AS (SELECT *, list_filter(tokens, lambda x: NOT list_contains({strings(STOPWORDS)}, x) AND NOT list_contains(brand_tokens, x) AND NOT regexp_full_match(x, '[0-9]+')) AS telling,
    CASE WHEN len(list_filter(three, lambda x: starts_with(x, 'набор') OR starts_with(x, 'сет'))) > 0 THEN 'set'
         WHEN base = 'palette' THEN concat_ws('_', base, palette) WHEN base = 'perfume' THEN concat_ws('_', base, perfume)
         WHEN list_contains({strings(BODY_BUCKETS)}, base) THEN concat_ws('_', base, coalesce(part_of, CASE WHEN list_contains({strings(FACE_BUCKETS)}, base) THEN 'face' END)) ELSE base END AS type
  FROM based)
"""


def _minus(a: str, b: str) -> str:
    return f"list_filter({a}, lambda x: NOT list_contains({b}, x))"


def _variant(a: str) -> str:
    return f"list_has_any({a}, {strings(VARIANT_MARKERS)})"


MATCHES = f"""
matches AS (
  SELECT b.run_id, b.sku_id AS base_sku, c.sku_id AS competitor_sku, b.brand_norm, b.name_norm, coalesce(b.volume_norm, c.volume_norm) AS volume_norm, b.current_price AS base_price, c.current_price AS competitor_price,
         b.was_price AS base_was_price, c.was_price AS competitor_was_price, c.current_price - b.current_price AS price_delta, round((c.current_price - b.current_price) * CAST(100.0 AS DOUBLE) / b.current_price, 2) AS price_delta_pct
  FROM features b JOIN features c ON b.run_id = c.run_id AND b.brand_norm = c.brand_norm AND (b.volume_norm = c.volume_norm OR b.volume_norm IS NULL OR c.volume_norm IS NULL)
  WHERE b.retailer = 'base' AND c.retailer = 'competitor' AND (b.volume_norm IS NOT NULL OR c.volume_norm IS NOT NULL) AND NOT coalesce(b.type <> c.type, false)
    AND CASE WHEN len(b.tokens) = 0 AND len(c.tokens) = 0 THEN b.name_norm = c.name_norm
             ELSE list_has_any(b.tokens, c.tokens) AND (len({_minus('c.tokens', 'b.tokens')}) = 0 OR (
               list_has_any(b.telling, c.telling) AND NOT {_variant(_minus('b.telling', 'c.telling'))} AND NOT {_variant(_minus('c.telling', 'b.telling'))}
               AND (len({_minus('b.telling', 'c.telling')}) = 0 OR len({_minus('c.telling', 'b.telling')}) = 0))) END)
"""

_S, _M = f"WITH {SNAPSHOTS}", f"WITH {SNAPSHOTS}, {FEATURES}, {MATCHES}"
_URLS = "JOIN snapshots b ON b.run_id = m.run_id AND b.retailer = 'base' AND b.sku_id = m.base_sku JOIN snapshots c ON c.run_id = m.run_id AND c.retailer = 'competitor' AND c.sku_id = m.competitor_sku"
_COMPARABLE = "NOT multipack_flag AND stock_state <> 'DELISTED'"
_GAP = "SELECT run_id, sku_id, brand_norm, name_norm, volume_norm, current_price, was_price, url FROM snapshots s WHERE retailer = 'competitor' AND NOT multipack_flag AND stock_state <> 'DELISTED' AND volume_norm IS NOT NULL AND NOT EXISTS (SELECT 1 FROM matches m WHERE m.run_id = s.run_id AND "
_SHARED = f"shared AS (SELECT * FROM snapshots v WHERE retailer = 'base' AND EXISTS (SELECT 1 FROM snapshots g WHERE g.retailer = 'competitor' AND g.run_id = v.run_id AND g.brand_norm = v.brand_norm))"

SQL = {
    "snapshots": f"{_S} SELECT run_id, retailer, sku_id, url, name, brand, brand_norm, name_norm, volume_raw, volume_norm, multipack_flag, parse_error_flag, current_price, was_price, currency, stock_state FROM snapshots",
    "product_types": f"WITH {SNAPSHOTS}, {FEATURES} SELECT run_id, retailer, sku_id, type, array_to_string(list_sort(tokens), ' ') AS tokens, array_to_string(list_sort(telling), ' ') AS telling FROM features",
    "matches": f"{_M} SELECT * FROM matches",
    "price_deltas": f"{_M} SELECT m.run_id, m.brand_norm, m.name_norm, m.volume_norm, base_price, base_was_price, b.url AS base_url, competitor_price, competitor_was_price, c.url AS competitor_url, price_delta, price_delta_pct FROM matches m {_URLS}",
    "price_deltas_top": f"{_M} SELECT * FROM matches ORDER BY abs(price_delta_pct) DESC, base_sku, competitor_sku LIMIT 20",
    "gaps_by_key": f"{_M} {_GAP} m.brand_norm = s.brand_norm AND m.name_norm = s.name_norm AND m.volume_norm = s.volume_norm)",
    "gaps_by_sku": f"{_M} {_GAP} m.competitor_sku = s.sku_id)",
    "promotions": f"{_S} SELECT run_id, sku_id, brand_norm, name_norm, volume_norm, current_price, was_price, was_price - current_price AS discount_amount, round((was_price - current_price) * CAST(100.0 AS DOUBLE) / was_price, 2) AS discount_pct, url FROM snapshots WHERE retailer = 'competitor' AND was_price > current_price AND {_COMPARABLE} AND volume_norm IS NOT NULL",
    "comparable_counts": f"{_S} SELECT run_id, retailer, count(*) AS n FROM snapshots WHERE {_COMPARABLE} GROUP BY 1, 2",
    "brand_overlap_rows": f"{_S}, {_SHARED} SELECT run_id, sku_id, brand_norm FROM shared",
    "match_rates": f"{_M}, {_SHARED}, d AS (SELECT run_id, count(*) FILTER ({_COMPARABLE}) AS denominator, count(DISTINCT brand_norm) AS brand_overlap FROM shared GROUP BY 1), f AS (SELECT run_id, count(*) AS match_count FROM matches GROUP BY 1) SELECT d.run_id, denominator, brand_overlap, coalesce(match_count, 0) AS match_count, CASE WHEN denominator > 0 THEN round(coalesce(match_count, 0) * CAST(100.0 AS DOUBLE) / denominator, 2) ELSE 0.0 END AS match_rate FROM d LEFT JOIN f USING (run_id)",
    "overlap_by_brand": f"{_S} SELECT run_id, brand_norm, count(DISTINCT sku_id) FILTER (retailer = 'base') AS base_skus, count(DISTINCT sku_id) FILTER (retailer = 'competitor') AS competitor_skus FROM snapshots GROUP BY 1, 2 HAVING base_skus > 0 AND competitor_skus > 0",
    "skus_per_brand_top": f"{_S} SELECT run_id, retailer, brand_norm, count(*) AS skus FROM snapshots GROUP BY 1, 2, 3 ORDER BY skus DESC, run_id, retailer, brand_norm LIMIT 30",
}
