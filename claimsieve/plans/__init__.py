"""Whole plans: the layered pipeline and the query catalogue."""
