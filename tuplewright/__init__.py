"""Relation-annotated text: prepare, split, render and score, on Spark."""
