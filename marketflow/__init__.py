"""Marketplace data jobs (shops, items, coupons, comments, clicks) on PySpark."""
