"""Whole plans: stage compositions and the catalogue of runnable queries."""
