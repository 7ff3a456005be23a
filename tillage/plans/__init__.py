"""Composed plans: the query bank, a discovery run, the query catalog."""
