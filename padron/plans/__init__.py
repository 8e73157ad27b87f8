"""Composed jobs: table updates, export sheets, report blocks, chart tables."""
