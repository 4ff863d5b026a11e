"""Operators: first-row-wins, dimensions, checked joins, factorised fan-out aggregates, models."""
