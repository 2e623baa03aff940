"""Schemas of the tables that runs keep. Tables are Parquet, partitioned by run_id (snapshots by retailer, too)."""

SNAPSHOTS = (
    "run_id long, retailer string, sku_id string, url string, name string, brand string, brand_norm string, name_norm string, volume_raw string, "
    "volume_norm string, multipack_flag boolean, parse_error_flag boolean, current_price long, was_price long, currency string, stock_state string, scraped_at timestamp"
)
RAW_PRODUCT = "sku_id string, url string, name string, brand_raw string, current_price long, was_price long, currency string, availability string, raw_volume_text string"
MATCHES = (
    "run_id long, base_sku string, competitor_sku string, brand_norm string, name_norm string, volume_norm string, base_price long, competitor_price long, "
    "base_was_price long, competitor_was_price long, price_delta long, price_delta_pct double, matched_at timestamp"
)
#: How matches are kept: `kind` is null for a row that is a match, `pair` for two classes of products, `base` or `competitor` for a product of a class.
STORED_MATCHES = f"{MATCHES}, kind string, b_id long, c_id long, n long"
RUN_EVENTS = "run_id long, seq long, kind string, status string, fail_reason string, at timestamp"
RUN_STATS = "run_id long, key string, value string, seq long"
SLUGS = "run_id long, slug string, url string"
REVIEW_QUEUE = "run_id long, item string, source string, status string"
PAGE_CAPTURES = "url string, status int, title string, html string, block boolean, block_reason string, timing_ms long, fetched_at timestamp"

BASE, COMPETITOR = "base", "competitor"
