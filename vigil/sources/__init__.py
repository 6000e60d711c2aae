"""Typed readers for the daily feeds, the feed file listing and tables."""
