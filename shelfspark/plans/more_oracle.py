"""DuckDB SQL for the queries over history, quality, scope, nested sources and scalar functions."""

from __future__ import annotations

from shelfspark.plans.oracle import FEATURES, MATCHES, SNAPSHOTS, SQL, slug
from shelfspark.functions.vocabulary import LATIN_OF

_H = "'https://shop.example"
_N = "CAST(regexp_replace(sku_id, '^c', '') AS BIGINT)"
_F = f"""WITH {SNAPSHOTS}, faulty AS (SELECT * REPLACE (CASE WHEN {_N} % 50 = 1 THEN 0 ELSE current_price END AS current_price, CASE WHEN {_N} % 40 = 3 THEN ' ' ELSE brand END AS brand,
  CASE WHEN {_N} % 40 = 3 THEN '' ELSE brand_norm END AS brand_norm, CASE WHEN {_N} % 60 <> 5 THEN url END AS url) FROM snapshots),
checked AS (SELECT *, concat_ws(',', CASE WHEN url IS NULL THEN 'url:missing' END, CASE WHEN trim(brand) = '' THEN 'brand:missing' END, CASE WHEN current_price <= 0 THEN 'current_price:not_positive' END,
  CASE WHEN retailer = 'competitor' AND volume_raw IS NULL THEN 'volume_raw:missing' END) AS reasons FROM faulty)"""
_MONTHS = "months AS (SELECT l_returnflag, m + m // 6 AS run_id, count(*) AS n FROM (SELECT l_returnflag, (year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS m FROM lineitem) GROUP BY 1, 2)"
_EVENTS = """ledger AS (SELECT o_custkey AS run_id, o_orderkey AS seq, CASE WHEN o_orderstatus = 'F' THEN 'finalize' WHEN o_orderstatus = 'O' AND o_orderpriority < '2' THEN 'fail' ELSE 'create' END AS kind,
  CASE WHEN o_orderpriority < '3' THEN 'success' ELSE 'partial' END AS status, o_orderpriority AS fail_reason FROM orders),
states AS (SELECT run_id, CASE WHEN bool_or(kind = 'fail') THEN 'failed' ELSE coalesce(arg_min(status, seq) FILTER (kind = 'finalize'), 'running') END AS status, arg_max(fail_reason, seq) FILTER (kind = 'fail') AS fail_reason FROM ledger GROUP BY 1)"""
_STATS = """patches AS (SELECT user_id AS run_id, event_type AS key, CASE WHEN NOT (event_type = 'error' AND value < 5) THEN CAST(props->>'$.k' AS VARCHAR) END AS value, event_id AS seq FROM events),
stats AS (SELECT run_id, key, arg_max(value, seq) AS value FROM patches WHERE value IS NOT NULL GROUP BY 1, 2)"""
_CAPTURES = r"""p AS (SELECT page_id, page_id % 3 AS run_id, url, html, CASE WHEN page_id % 9 = 0 THEN 404 WHEN page_id % 11 = 0 THEN 304 ELSE 200 END AS status,
  CASE WHEN page_id % 13 = 0 THEN 'Loading ' || url WHEN page_id % 19 = 0 THEN 'Checking device' ELSE regexp_extract(html, '<title>(.*?)</title>', 1) END AS title,
  page_id % 5 <> 0 AS cleared, page_id % 17 = 0 AS failed, page_id % 4 <> 0 AS price_extracted, length(html) AS size FROM pages),
q AS (SELECT *, CASE WHEN failed THEN 'exception' WHEN NOT cleared AND size < 3000 THEN 'gate_shell_not_cleared' WHEN status NOT IN (200, 304) THEN 'http_' || status END AS reason,
  CASE WHEN size >= 3000 THEN 'real-pdp' WHEN contains(lower(title), 'checking') THEN 'gate-shell' ELSE 'stale-sku' END AS state FROM p),
captures AS (SELECT page_id, run_id, url, status, title, state, reason IS NOT NULL AS block, reason, price_extracted,
  status = 200 AND NOT price_extracted AND reason IS NULL AND contains(lower(title), 'loading ') AND NOT contains(lower(title), 'checking') AS race, size AS timing_ms FROM q)"""
_NAMES = r"trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[^\p{L}\p{N}_\s]+', ' ', 'g'), '\s+', ' ', 'g'))"


def _latin(x: str) -> str:
    out = f"lower({x})"
    for letter, latin in LATIN_OF.items():
        out = f"replace({out}, '{letter}', '{latin}')"
    return out


_BRANDS = f"""brands AS (SELECT {slug('n_name')} AS brand, n_nationkey AS pos FROM nation),
aliases AS (SELECT brand AS canonical, 'Maison Ñ ' || pos AS alias, pos FROM brands WHERE pos % 3 = 0 UNION ALL SELECT brand, 'Shared Name', pos FROM brands WHERE pos IN (3, 6)),
part_slugs AS (SELECT p_partkey, CASE WHEN p_partkey % 40 % 3 = 0 THEN 'Maison-' ELSE 'nation-' END || p_partkey % 40 || '-' || replace(p_name, ' ', '-') AS s FROM part),
slugs AS (SELECT lower(s) AS slug, 'https://competitor.example/' || p_partkey || '-' || s AS url FROM part_slugs),
alias_slugs AS (SELECT brand, token FROM (SELECT b.brand, CASE WHEN a.alias IS NULL THEN b.brand WHEN a.alias = 'Shared Name' THEN 'shared-name' ELSE 'maison-n-' || b.pos END AS token FROM brands b LEFT JOIN aliases a ON a.canonical = b.brand)),
tokens AS (SELECT token FROM alias_slugs UNION SELECT brand || '-red' FROM brands WHERE pos % 2 = 0),
indexed AS (SELECT slug, url, arg_max(token, length(token)) AS token FROM slugs JOIN tokens ON slug = token OR starts_with(slug, token || '-') WHERE len(string_split(token, '-')) <= 3 GROUP BY 1, 2),
found AS (SELECT DISTINCT brand, url FROM alias_slugs JOIN indexed USING (token)),
missing AS (SELECT brand FROM brands WHERE brand NOT IN (SELECT brand FROM found)),
queue AS (SELECT CAST(2 AS BIGINT) AS run_id, brand AS item, 'unmatched_brand' AS source, 'pending' AS status FROM missing
          UNION ALL SELECT DISTINCT 2, lower(s), 'new_slug', 'pending' FROM part_slugs WHERE p_partkey % 10 = 0 AND lower(s) NOT IN (SELECT lower(s) FROM part_slugs WHERE p_partkey % 10 <> 0))"""
_LABELS = """labels_ AS (SELECT 'Nation_' || s_suppkey % 30 || CASE s_suppkey % 4 WHEN 0 THEN '_PARIS' WHEN 1 THEN ' House' ELSE '' END AS label, '/brands/' || s_suppkey AS path, s_suppkey AS pos, 'nation' || s_suppkey % 30 || CASE s_suppkey % 4 WHEN 1 THEN 'house' ELSE '' END AS key FROM supplier),
firsts AS (SELECT key, arg_min(label, pos) AS label, arg_min(path, pos) AS path, min(pos) AS pos FROM labels_ GROUP BY 1),
named AS (SELECT n_name || ' Beauty' AS brand, 'nation_' || n_nationkey AS raw, 'nation' || n_nationkey AS key FROM nation)"""
_COMP = "c AS (SELECT * EXCLUDE (run_id, current_price, was_price), min(current_price) AS current_price, min(was_price) AS was_price FROM raw WHERE retailer = 'competitor' GROUP BY ALL)"
_M = f"WITH {SNAPSHOTS}, {FEATURES}, {MATCHES}"
_SUMMARY = f"""{_M}, gaps AS (SELECT run_id, count(*) AS n FROM snapshots s WHERE retailer = 'competitor' AND NOT multipack_flag AND stock_state <> 'DELISTED' AND volume_norm IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM matches m WHERE m.run_id = s.run_id AND m.brand_norm = s.brand_norm AND m.name_norm = s.name_norm AND m.volume_norm = s.volume_norm) GROUP BY 1),
promos AS (SELECT run_id, count(*) AS n FROM snapshots WHERE retailer = 'competitor' AND was_price > current_price AND NOT multipack_flag AND stock_state <> 'DELISTED' AND volume_norm IS NOT NULL GROUP BY 1),
den AS (SELECT run_id, count(*) AS n FROM snapshots v WHERE retailer = 'base' AND NOT multipack_flag AND stock_state <> 'DELISTED' AND EXISTS (SELECT 1 FROM snapshots g WHERE g.retailer = 'competitor' AND g.run_id = v.run_id AND g.brand_norm = v.brand_norm) GROUP BY 1),
hits AS (SELECT run_id, count(*) AS n FROM matches GROUP BY 1),
summary AS (SELECT s.run_id, count(*) FILTER (retailer = 'base') AS base_count, count(*) FILTER (retailer = 'competitor') AS competitor_count, coalesce(any_value(hits.n), 0) AS match_count,
  coalesce(round(any_value(hits.n) * CAST(100.0 AS DOUBLE) / any_value(den.n), 2), 0.0) AS match_rate, coalesce(any_value(gaps.n), 0) AS gaps_count, coalesce(any_value(promos.n), 0) AS promo_count
  FROM snapshots s LEFT JOIN gaps USING (run_id) LEFT JOIN promos USING (run_id) LEFT JOIN den USING (run_id) LEFT JOIN hits USING (run_id) GROUP BY 1)"""
_FLOOR = "CAST(floor(p_retailprice) AS BIGINT)"
_SANE = "BETWEEN 100 AND 1000000"

MORE_SQL = {
    "row_validation": f"{_F} SELECT run_id, retailer, sku_id, reasons FROM checked WHERE reasons <> ''",
    "rejections": f"""{_F}, ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id, retailer ORDER BY sku_id) AS k FROM checked WHERE reasons <> '')
      SELECT run_id, retailer, count(*) AS attempted, count(*) FILTER (reasons <> '') AS rejected, count(*) FILTER (reasons <> '') / count(*) AS rejected_rate,
        (SELECT coalesce(string_agg(sku_id || ' ' || reasons, '; ' ORDER BY k), '') FROM ranked r WHERE r.run_id = c.run_id AND r.retailer = c.retailer AND k <= 50) AS listed FROM checked c GROUP BY run_id, retailer""",
    "null_rates": f"{_F} SELECT run_id, retailer, avg(CASE WHEN volume_norm IS NULL THEN 1.0 ELSE 0.0 END) AS volume_null_rate, avg(CASE WHEN brand_norm = '' THEN 1.0 ELSE 0.0 END) AS brand_null_rate, round(avg(CASE WHEN volume_norm IS NULL THEN 1.0 ELSE 0.0 END), 4) AS volume_null_rate_4, round(avg(CASE WHEN brand_norm = '' THEN 1.0 ELSE 0.0 END), 4) AS brand_null_rate_4, avg(CASE WHEN url IS NULL THEN 1.0 ELSE 0.0 END) AS required_null_rate FROM faulty GROUP BY 1, 2",
    "filled_counts": f"{_F} SELECT run_id, retailer, count(*) AS rows, count(volume_norm) AS with_volume, count(current_price) AS with_price FROM faulty GROUP BY 1, 2",
    "duplicate_keys": f"WITH {SNAPSHOTS} SELECT run_id, retailer, CAST({_N} % 1500 AS VARCHAR) AS sku_id, count(*) AS n FROM snapshots GROUP BY 1, 2, 3 HAVING n > 1",
    "brand_in_name": f"WITH {SNAPSHOTS} SELECT run_id, retailer, count(*) FILTER ({_N} % 9 = 0) AS brand_in_name, count(*) AS rows FROM snapshots GROUP BY 1, 2",
    "gate_cascade": f"""WITH {SNAPSHOTS.replace('snapshots AS (', 'plain AS (')}, snapshots AS (SELECT * REPLACE (CAST(CASE WHEN {_N} % 6 = 0 THEN 1 WHEN {_N} % 6 = 1 THEN 2 ELSE run_id + 2 END AS BIGINT) AS run_id, CASE WHEN {_N} % 50 = 1 THEN 0 ELSE current_price END AS current_price,
        CASE WHEN {_N} % 40 = 3 THEN '' ELSE brand_norm END AS brand_norm, CASE WHEN {_N} % 60 <> 5 THEN url END AS url) FROM plain), {FEATURES}, {MATCHES},
      m AS (SELECT run_id, count(*) AS n FROM matches GROUP BY 1),
      r AS (SELECT run_id, avg(CASE WHEN retailer = 'base' THEN CASE WHEN url IS NULL THEN 1.0 ELSE 0.0 END END) AS req, count(*) FILTER (retailer = 'base') AS b, count(*) FILTER (retailer = 'competitor') AS c,
        avg(CASE WHEN retailer = 'competitor' THEN CASE WHEN volume_norm IS NULL THEN 1.0 ELSE 0.0 END END) AS vol, avg(CASE WHEN retailer = 'competitor' THEN CASE WHEN brand_norm = '' THEN 1.0 ELSE 0.0 END END) AS brd FROM snapshots GROUP BY 1),
      v AS (SELECT r.run_id, CASE WHEN req > 0.05 THEN 'base_required_null_rate' WHEN b < 20 THEN 'base_count' WHEN c < 20 THEN 'competitor_count' WHEN vol > 0.5 THEN 'parser_drift_null_volume_rate' WHEN brd > 0.5 THEN 'parser_drift_null_brand_rate' WHEN coalesce(n, 0) < 5 THEN 'match_count' END AS failed_gate FROM r LEFT JOIN m USING (run_id))
      SELECT run_id, failed_gate, failed_gate IS NULL AS passed FROM v""",
    "publish_routes": """WITH r AS (SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 5 = 0 THEN 'failed' WHEN o_orderkey % 37 = 0 THEN 'running' WHEN o_orderkey % 31 <> 0 THEN 'success' END AS status, o_orderkey AS k FROM orders),
      c AS (SELECT *, CASE WHEN status IS DISTINCT FROM 'success' THEN 'run_status' WHEN k % 7 = 0 THEN 'path' WHEN k % 13 = 0 OR k % 11 = 0 THEN 'size_guard' WHEN k % 17 = 0 THEN 'summary_text' END AS failed_check FROM r)
      SELECT run_id, CASE WHEN failed_check IS NULL THEN 'business' ELSE 'ops_only' END AS route, failed_check, CASE failed_check WHEN 'run_status' THEN 'upstream_status_' || coalesce(status, 'None') WHEN 'path' THEN 'no_report' WHEN 'size_guard' THEN 'oversize' WHEN 'summary_text' THEN 'empty_summary_text' END AS reason,
        CASE WHEN status IS NULL THEN 'missing_run_row' WHEN status = 'failed' THEN 'failed_upstream' WHEN status = 'running' THEN 'in_progress_upstream' ELSE 'runs' END AS skip FROM c""",
    "probe_verdicts": f"WITH {_CAPTURES} SELECT page_id % 20 AS run_id, bool_and(price_extracted AND status IN (200, 304) AND NOT block) AS passed, count(*) AS probes FROM captures GROUP BY 1",
    "suggested_thresholds": f"""WITH {_MONTHS}, h AS (SELECT *, coalesce(list(n) OVER (PARTITION BY l_returnflag ORDER BY run_id RANGE BETWEEN 4 PRECEDING AND 1 PRECEDING), []) AS b FROM months),
      w AS (SELECT *, list_append(b, n) AS c FROM h)
      SELECT l_returnflag, run_id, n, CASE WHEN len(b) >= 4 THEN CAST(trunc(0.7::DOUBLE * list_median(b)) AS BIGINT) END AS before, CASE WHEN len(c) >= 4 THEN CAST(trunc(0.7::DOUBLE * list_median(c[-4:])) AS BIGINT) END AS with_current FROM w""",
    "run_states": f"WITH {_EVENTS} SELECT * FROM states",
    "current_rows": f"WITH {_EVENTS} SELECT o_custkey AS run_id, o_orderkey FROM orders WHERE o_custkey = (SELECT max(run_id) FROM states WHERE status = 'success')",
    "run_stats": f"WITH {_STATS} SELECT * FROM stats",
    "run_stats_map": f"""WITH {_STATS} SELECT run_id, '{{' || string_agg('"' || key || '":"' || value || '"', ',' ORDER BY key) || '}}' AS stats FROM stats GROUP BY 1""",
    "new_keys": "WITH d AS (SELECT DISTINCT day(ts) AS run_id, CAST(user_id AS VARCHAR) AS slug FROM events), p AS (SELECT run_id, lag(run_id) OVER (ORDER BY run_id) AS prev FROM (SELECT DISTINCT run_id FROM d)) SELECT CAST(d.run_id AS INTEGER) AS run_id, slug FROM d JOIN p USING (run_id) WHERE prev IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d o WHERE o.run_id = prev AND o.slug = d.slug)",
    "previous_runs": f"WITH {_MONTHS} SELECT run_id, lag(run_id) OVER (ORDER BY run_id) AS previous_run_id FROM (SELECT DISTINCT run_id FROM months)",
    "last_runs": f"WITH {_MONTHS} SELECT * FROM months WHERE run_id IN (SELECT DISTINCT run_id FROM months ORDER BY run_id DESC LIMIT 4)",
    "run_comparison": f"""{_M}, n AS (SELECT run_id, count(*) FILTER (retailer = 'base') AS base, count(*) FILTER (retailer = 'competitor') AS competitor FROM snapshots GROUP BY 1),
      t AS (SELECT n.*, coalesce(h.c, 0) AS matches FROM n LEFT JOIN (SELECT run_id, count(*) AS c FROM matches GROUP BY 1) h USING (run_id))
      SELECT *, base - lag(base) OVER w AS base_change, competitor - lag(competitor) OVER w AS competitor_change, matches - lag(matches) OVER w AS matches_change FROM t WINDOW w AS (ORDER BY run_id)""",
    "first_seen": "SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2",
    "top_per_key": "SELECT event_type, event_id, value, CAST(row_number() OVER w AS INTEGER) AS rank FROM events WINDOW w AS (PARTITION BY event_type ORDER BY value DESC, event_id) QUALIFY rank <= 5",
    "page_captures": f"WITH {_CAPTURES} SELECT * FROM captures",
    "fetch_counters": f"WITH {_CAPTURES} SELECT run_id, count(*) AS fetches, count(*) FILTER (block) AS failures, count(*) FILTER (state = 'gate-shell') AS gate_shells, count(*) FILTER (state = 'stale-sku') AS stale, count(*) FILTER (state = 'real-pdp' AND NOT price_extracted) AS parse_failures, round(avg(timing_ms) / 1000, 6) AS mean_seconds FROM captures GROUP BY 1",
    "scrubbed_pages": """SELECT page_id, page_id % 2 = 0 AS has_secret,
      md5(html || CASE WHEN page_id % 2 = 0 THEN '<meta name="csrf-token" content="' || page_id || '">cf_clearance=SCRUBBED; "buildId":"b' || page_id || '" <h1 class="_ga-pdp-title__name_x' || page_id || '"> Authorization: Bearer SCRUBBED' ELSE '' END) AS scrubbed_md5,
      md5(html || CASE WHEN page_id % 2 = 0 THEN '<meta name="csrf-token" content="NORM">cf_clearance=NORM; "buildId":"NORM" <h1 class="_ga-pdp-title__name_NORM"> Authorization: Bearer t.' || page_id ELSE '' END) AS stable_md5 FROM pages""",
    "url_parts": """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN CAST(page_id AS VARCHAR) ELSE string_split(rtrim(url, '/'), '/')[-1] END AS sku, CAST(page_id AS VARCHAR) AS number,
      CASE page_id % 3 WHEN 0 THEN 'men' WHEN 1 THEN 'women' END AS gender, CASE WHEN page_id % 3 < 2 THEN CAST(page_id AS VARCHAR) END AS catalogue_id FROM pages""",
    "document_names": f"SELECT doc_id, md5({_NAMES}) AS name_md5, md5({slug('text')}) AS slug_md5 FROM documents",
    "product_slugs": f"WITH {SNAPSHOTS} SELECT sku_id, {slug(_latin('name'))} || ' ' || {slug('name')} AS slugs FROM snapshots WHERE run_id = 1 AND retailer = 'base'",
    "volumes": "SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '(' || p_size || ',ml,1)' WHEN 1 THEN '(' || p_size || ',ml,3)' WHEN 2 THEN '(' || p_size || ',ml,2)' WHEN 4 THEN '(' || p_size || '.5,g,1)' WHEN 6 THEN '(' || p_size || ',oz,1)' END AS volume_norm, p_partkey % 8 IN (1, 2, 3, 5) AS multipack FROM part",
    "brand_keys": "SELECT s_suppkey, lower(s_name) || CASE s_suppkey % 5 WHEN 4 THEN 'parisx' ELSE '' END AS key, lower(s_name) || CASE s_suppkey % 5 WHEN 0 THEN '-beauty' WHEN 1 THEN '-paris' WHEN 2 THEN '-london-cosmetics' WHEN 3 THEN '' ELSE '-paris-x' END AS kebab FROM supplier",
    "guarded_formulas": "SELECT c_custkey, CASE WHEN c_custkey % 7 < 5 THEN '''' ELSE '' END || ['=', '+', '-', '@', chr(9), 'a', ''][c_custkey % 7 + 1] || c_name AS c_name, c_acctbal FROM customer",
    "iso_weeks": "SELECT o_orderkey, strftime((o_orderdate + to_hours(o_orderkey % 24)) AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Almaty', '%G-W%V') AS week FROM orders",
    "stock_and_prices": f"""WITH t AS (SELECT p_partkey AS k, CAST(floor(p_retailprice * (p_partkey % 200) * (p_partkey % 7)) AS BIGINT) AS price FROM part)
      SELECT k AS p_partkey, CASE WHEN k % 5 = 0 THEN 'UNKNOWN' WHEN k % 3 = 0 THEN 'OUT_OF_STOCK' WHEN k % 2 = 0 THEN 'UNAVAILABLE' ELSE 'IN_STOCK' END AS by_count, CASE WHEN k % 5 <> 0 AND k % 2 = 0 THEN 'IN_STOCK' ELSE 'OUT_OF_STOCK' END AS by_flag,
        ['InStock', 'OutOfStock', 'Discontinued', 'PreOrder', 'Unknown'][k % 5 + 1] AS by_url, CASE WHEN price {_SANE} THEN price END AS price, CASE WHEN k % 3 = 2 THEN price + 1 END AS was_real,
        CASE WHEN k % 4 = 0 THEN CASE WHEN k % 2 = 1 THEN price + 1 END WHEN k % 3 > 0 THEN price + k % 3 END AS was_offer, CASE WHEN k % 2 = 0 AND k % 3 > 0 THEN price + k % 3 END AS was_flag, CASE WHEN k % 3 = 0 THEN 'USD' ELSE 'KZT' END AS currency FROM t""",
    "alias_lookup": f"WITH {_BRANDS}, c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'maison-n-' || c_nationkey WHEN 1 THEN 'nation-' || c_nationkey ELSE 'shared-name' END AS slug FROM customer) SELECT c_custkey, slug, CASE WHEN slug = 'shared-name' THEN coalesce((SELECT arg_max(canonical, pos) FROM aliases WHERE alias = 'Shared Name'), slug) WHEN starts_with(slug, 'maison-n-') THEN coalesce((SELECT canonical FROM aliases WHERE alias = 'Maison Ñ ' || substr(slug, 10)), slug) ELSE slug END AS brand_norm FROM c",
    "sitemap_slugs": f"WITH {_BRANDS} SELECT * FROM slugs",
    "longest_prefix": f"WITH {_BRANDS} SELECT * FROM indexed",
    "urls_by_token": f"WITH {_BRANDS}, placed AS (SELECT *, (row_number() OVER (PARTITION BY token ORDER BY url) - 1) // 50 AS piece FROM indexed) SELECT token, piece, string_agg(url, ' ' ORDER BY url) AS urls FROM placed GROUP BY 1, 2",
    "brand_pool": f"WITH {_BRANDS} SELECT * FROM found UNION ALL SELECT brand, NULL FROM missing",
    "review_queue": f"WITH {_BRANDS} SELECT * FROM queue",
    "pending_brands": f"WITH {_BRANDS} SELECT run_id, item AS brand FROM queue WHERE source = 'unmatched_brand'",
    "resolved_labels": f"WITH {_LABELS} SELECT brand, named.key, label, path FROM named JOIN firsts USING (key)",
    "fuzzy_labels": f"WITH {_LABELS}, j AS (SELECT brand, named.key AS bk, firsts.key AS lk, label, row_number() OVER (PARTITION BY brand ORDER BY abs(length(firsts.key) - length(named.key)), pos, firsts.key) AS rank FROM named JOIN firsts ON (contains(firsts.key, named.key) OR contains(named.key, firsts.key)) AND length(firsts.key) >= 3) SELECT brand, label, CAST(rank AS INTEGER) AS rank, rank = 1 AND (starts_with(lk, bk) OR starts_with(bk, lk)) AS proposed FROM j WHERE rank <= 5",
    "brand_paths": "SELECT c_custkey, 'nation ' || c_nationkey AS brand, CASE WHEN c_nationkey % 5 = 0 THEN 'nation_' || c_nationkey ELSE 'nation-' || c_nationkey END AS path FROM customer",
    "uncovered_brands": "SELECT DISTINCT 'n' || c_nationkey AS brand FROM customer WHERE c_custkey % 9 >= 5 AND c_nationkey NOT IN (SELECT s_nationkey // 2 * 2 FROM supplier)",
    "enumeration_totals": f"WITH {SNAPSHOTS}, f AS (SELECT brand, count(DISTINCT sku_id) AS n FROM raw WHERE retailer = 'competitor' AND stock_state = 'IN_STOCK' GROUP BY 1), t AS (SELECT p_brand AS brand, count(*) * CASE WHEN ends_with(p_brand, '1') THEN 2 ELSE 1 END AS total, count(*) FILTER (p_size > 20) AS fallback FROM part GROUP BY 1) SELECT t.brand, total, coalesce(n, 0) AS found, fallback, coalesce(n, 0) >= 0.8 * total AS complete, CASE WHEN coalesce(n, 0) >= 0.8 * total THEN coalesce(n, 0) ELSE greatest(coalesce(n, 0), fallback) END AS taken FROM t LEFT JOIN f ON f.brand = t.brand",
    "card_products": f"""WITH {SNAPSHOTS}, {_COMP}, o AS (SELECT *, {_N} AS n, CASE WHEN {_N} % 3 <> 0 AND current_price {_SANE} THEN current_price WHEN current_price + {_N} % 2 * 500 {_SANE} THEN current_price + {_N} % 2 * 500 END AS cur FROM c)
      SELECT sku_id, {_H}/' || sku_id AS url, 'Товар ' || brand || ' ' || name AS name, brand AS brand_raw, cur AS current_price,
        nullif(coalesce(CASE WHEN was_price {_SANE} THEN was_price END, CASE WHEN current_price + n % 2 * 500 > cur AND current_price + n % 2 * 500 {_SANE} THEN current_price + n % 2 * 500 END), cur) AS was_price, 'KZT' AS currency,
        CASE WHEN n % 2 = 0 THEN 'InStock' ELSE 'OutOfStock' END AS availability, volume_raw AS raw_volume_text FROM o WHERE cur IS NOT NULL AND n % 23 <> 0""",
    "variant_products": f"WITH {SNAPSHOTS}, {_COMP} SELECT sku_id || CASE i WHEN 1 THEN '-1' ELSE '' END AS sku_id, {_H}/' || sku_id || CASE i WHEN 1 THEN '-1' ELSE '' END || '-' AS url, 'Товар ' || brand || ' ' || name || CASE i WHEN 1 THEN ' red' ELSE '' END AS name, brand AS brand_raw, current_price + i * 100 AS current_price, CAST(NULL AS BIGINT) AS was_price, 'KZT' AS currency, 'InStock' AS availability, 50 * (i + 1) || ' мл' AS raw_volume_text FROM c, (VALUES (0), (1)) v(i) WHERE current_price + i * 100 {_SANE}",
    "catalogue_products": f"""WITH t AS (SELECT p_partkey AS k, p_brand, p_name, p_size || ' мл' AS size, {_FLOOR} AS price, p_partkey % 3 = 2 AS many, p_partkey % 3 = 2 AND p_partkey % 7 <> 0 AS has FROM part), v AS (SELECT t.*, i FROM t LEFT JOIN (VALUES (1), (2)) x(i) ON has)
      SELECT k || CASE WHEN i IS NULL THEN '' ELSE '-' || k * 10 + i END AS sku_id, {_H}/item/' || k AS url, p_name AS name, p_brand AS brand_raw, price + coalesce(i, 0) * 1000 AS current_price,
        CASE WHEN i IS NOT NULL THEN CASE WHEN k % 2 = 1 THEN price + i * 1000 + 10 END WHEN NOT many AND k % 4 < 2 AND k % 2 = 1 THEN price + 50 END AS was_price, 'KZT' AS currency, 'IN_STOCK' AS availability, CASE WHEN k % 3 <> 0 THEN size END AS raw_volume_text, many AND NOT has AS parse_error_flag FROM v""",
    "embedded_products": f"SELECT CAST(p_partkey AS VARCHAR) AS sku_id, {_H}/item/' || p_partkey AS url, p_name AS name, p_brand AS brand_raw, {_FLOOR} AS current_price, CASE WHEN p_partkey % 2 = 1 THEN {_FLOOR} + 70 END AS was_price, 'KZT' AS currency, CASE WHEN p_partkey % 5 = 0 THEN 'UNKNOWN' WHEN p_partkey % 3 = 0 THEN 'OUT_OF_STOCK' WHEN p_partkey % 2 = 0 THEN 'UNAVAILABLE' ELSE 'IN_STOCK' END AS availability, CASE WHEN p_partkey % 2 = 0 THEN p_size || ' мл' ELSE p_name END AS raw_volume_text FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 8 <> 0 AND p_partkey % 6 <> 0 AND p_partkey % 11 <> 0",
    "microdata_products": f"SELECT CAST(p_partkey AS VARCHAR) AS sku_id, {_H}/' || p_partkey || '-' || replace(p_name, ' ', '-') AS url, p_name AS name, p_brand AS brand_raw, {_FLOOR} AS current_price, {_FLOOR} + 300 AS was_price, 'KZT' AS currency, CASE WHEN p_partkey % 2 = 0 THEN 'InStock' ELSE 'OutOfStock' END AS availability, p_size || ' мл' AS raw_volume_text FROM part",
    "catalogue_links": f"SELECT {_H}/item/' || p_partkey AS url, lpad(CAST(CASE WHEN p_partkey % 50 = 0 AND p_partkey > 0 THEN p_partkey // 50 - 1 ELSE p_partkey // 50 END AS VARCHAR), 9, '0') AS page, CAST(CASE WHEN p_partkey % 50 = 0 AND p_partkey > 0 THEN 50 ELSE p_partkey % 50 END AS INTEGER) AS pos FROM part",
    "run_summary": f"{_SUMMARY} SELECT * FROM summary",
    "sheet_counts": f"{_SUMMARY} SELECT run_id, s.sheet, s.rows FROM summary, LATERAL (VALUES ('deltas', match_count), ('gaps', gaps_count), ('promotions', promo_count), ('summary', 1)) s(sheet, rows)",
    "summary_text": f"""{_SUMMARY}, best AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY abs(price_delta_pct) DESC, base_sku, competitor_sku) AS k FROM matches),
      lines AS (SELECT run_id, string_agg(' ' || k || '. ' || brand_norm || ' ' || name_norm || ' ' || volume_norm || ': ' || price_delta_pct || '%', chr(10) ORDER BY k) AS l FROM best WHERE k <= 3 GROUP BY 1)
      SELECT run_id, '📊 Неделя 2026-W19 — base vs competitor' || chr(10) || chr(10) || '📦 base: ' || base_count || ' SKU  •  competitor: ' || competitor_count || ' SKU' || chr(10) || '🎯 Совпало: ' || match_count || ' (' || match_rate || '%)' || chr(10)
        || '🆕 Гэпы: ' || gaps_count || ' SKU у competitor без base-пары' || chr(10) || '💸 Промо у competitor: ' || promo_count || ' SKU' || chr(10) || coalesce(chr(10) || '🔝 Топ-3 дельты (base vs competitor):' || chr(10) || l || chr(10), '') AS summary FROM summary LEFT JOIN lines USING (run_id)""",
    "distinct_base_brands": f"WITH {SNAPSHOTS} SELECT DISTINCT run_id, brand_norm FROM snapshots WHERE retailer = 'base'",
    "raw_listing": f"WITH {SNAPSHOTS} SELECT run_id, retailer, brand, name, sku_id, current_price FROM raw",
}
MORE_SQL["cards_with_variants"] = f"""WITH cards AS ({MORE_SQL['card_products']}), variants AS ({MORE_SQL['variant_products']})
  SELECT * FROM cards UNION ALL SELECT * FROM variants v WHERE CAST(regexp_replace(regexp_replace(sku_id, '^c', ''), '-1$', '') AS BIGINT) % 2 = 1 AND sku_id NOT IN (SELECT sku_id FROM cards)"""

_VALID = "current_price > 0 AND (retailer = 'base' OR volume_raw IS NOT NULL)"
_SCOPE = _BRANDS.replace(" UNION SELECT brand || '-red' FROM brands WHERE pos % 2 = 0", "")
_FIRST_QUEUE = f"""WITH {_SCOPE.replace("AS s FROM part)", "AS s FROM part WHERE p_partkey % 10 <> 0)")} SELECT CAST(1 AS BIGINT) AS run_id, brand AS item, 'unmatched_brand' AS source, 'pending' AS status FROM missing"""
_QUEUES = f"SELECT * FROM ({_FIRST_QUEUE}) UNION ALL SELECT * FROM (WITH {_SCOPE} SELECT * FROM queue)"
MORE_SQL |= {
    "ledger_weeks": f"""WITH s AS ({MORE_SQL["run_summary"]}), t AS ({MORE_SQL["summary_text"]}), q AS ({_QUEUES}), w AS (
      SELECT CAST(run_id AS BIGINT) AS run_id, 'success' AS status, CAST(NULL AS VARCHAR) AS fail_reason, base_count AS base_rows, competitor_count AS competitor_rows, match_count, match_rate, summary FROM s JOIN t USING (run_id)
      UNION ALL SELECT 3, 'failed', 'match_count', base_count, competitor_count, match_count, match_rate, NULL FROM s WHERE run_id = 2)
      SELECT w.*, (SELECT count(*) FROM q WHERE q.run_id = least(w.run_id, 2) AND (w.run_id < 3 OR source = 'unmatched_brand')) AS pending FROM w""",
    "report_routes": """SELECT CAST(run_id AS BIGINT) AS run_id, CASE run_id WHEN 1 THEN 'business' ELSE 'ops_only' END AS route, CASE run_id WHEN 2 THEN 'size_guard' WHEN 3 THEN 'run_status' END AS failed_check,
      CASE run_id WHEN 2 THEN 'oversize' WHEN 3 THEN 'upstream_status_failed' END AS reason FROM range(1, 4) t(run_id) WHERE EXISTS (SELECT 1 FROM part) AND EXISTS (SELECT 1 FROM lineitem)""",
    "ledger_recovery": f"""WITH {SNAPSHOTS}, kept AS (SELECT *, retailer = 'competitor' AND brand_norm = 'brand-11' AND CAST(replace(sku_id, 'c', '') AS BIGINT) % 2 = 1 AS gone FROM snapshots WHERE {_VALID}),
      n AS (SELECT 'died' AS stage, run_id, retailer, count(*) AS n FROM kept GROUP BY ALL UNION ALL SELECT 'done', run_id, retailer, count(*) FROM kept WHERE NOT gone GROUP BY ALL)
      SELECT stage, run_id, retailer, n, n AS skus FROM n""",
    "ledger_edits": f"""WITH {SNAPSHOTS}, kept AS (SELECT *, retailer = 'competitor' AND brand_norm = 'brand-11' AND CAST(replace(sku_id, 'c', '') AS BIGINT) % 2 = 1 AS gone FROM snapshots WHERE {_VALID}),
      n AS (SELECT run_id, retailer, count(*) AS n FROM kept WHERE NOT gone GROUP BY ALL UNION ALL SELECT run_id + 2, retailer, count(*) FROM kept WHERE retailer = 'base' GROUP BY ALL)
      SELECT run_id, retailer, n, n AS skus, CASE WHEN retailer = 'competitor' THEN n END AS stat FROM n""",
    "report_contents": " UNION ALL ".join(
        f"SELECT '{name}' AS sheet, run_id, url, brand_norm, name_norm, volume_norm, current_price, was_price FROM ({SQL[key]})" for name, key in (("gaps", "gaps_by_key"), ("promotions", "promotions"))
    ) + f" UNION ALL SELECT 'deltas', run_id, base_url || ' ' || competitor_url, brand_norm, name_norm, volume_norm, competitor_price, price_delta FROM ({SQL['price_deltas']})",
    "report_sheets": f"SELECT sheet, CAST(sum(rows) AS BIGINT) AS rows FROM ({MORE_SQL['sheet_counts']}) GROUP BY 1",
    "scope_of_runs": f"WITH {_SCOPE} SELECT 'found' AS kind, brand, url FROM found UNION ALL SELECT CASE source WHEN 'new_slug' THEN 'new' ELSE 'unmatched' END, item, NULL FROM queue",
    "ledger_queue": _QUEUES,
    "aliased_matches": f"{_M} SELECT * FROM matches",
    "parsed_pages": f"SELECT *, 'base' AS retailer FROM ({MORE_SQL['embedded_products']}) UNION ALL BY NAME SELECT *, 'competitor' AS retailer FROM ({MORE_SQL['microdata_products']})",
}
