"""Composed jobs: the daily run, fixture bindings, the query catalog and its
SQL oracle."""
