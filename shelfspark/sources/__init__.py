"""Readers and extractors: captured pages, listing JSON, sitemaps, and the tables that stand in for catalogues."""
