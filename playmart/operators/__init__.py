"""Reusable DataFrame operators: grouping, joining back, layout, quality."""
