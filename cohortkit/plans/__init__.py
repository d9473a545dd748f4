"""Composed plans: the member profile, the weekly report, the query registry."""
