"""Composed plans: the standardised base table and the case view of the driver tables."""
