"""Logical plans: the search language and metadata filters."""
