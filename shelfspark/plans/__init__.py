"""Runs: the ledger of tables, composed pipelines, and the registered queries with their SQL."""
