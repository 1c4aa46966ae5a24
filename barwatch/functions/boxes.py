"""Squared distances between points and bounding boxes, as column expressions.

Points are structs with one field per coordinate; boxes are structs with fields ``<name>_low`` and
``<name>_high``.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum_of_squares(parts: list[Column]) -> Column:
    return reduce(Column.__add__, [p * p for p in parts])


def box_of(columns: list[str]) -> Column:
    """Aggregate: tight bounding box of a group."""
    sides = []
    for c in columns:
        sides += [F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high")]
    return F.struct(*sides)


def cell_steps(reach: int, dimensions: int) -> Column:
    """Array of all integer steps of at most ``reach`` per axis."""
    axis = range(-reach, reach + 1)
    steps = (", ".join(f"{x}L" for x in step) for step in product(axis, repeat=dimensions))
    return F.expr("array(" + ", ".join(f"array({step})" for step in steps) + ")")


def squared_distance(a: Column, b: Column, columns: list[str]) -> Column:
    return _sum_of_squares([a[c] - b[c] for c in columns])


def nearest_squared(at: Column, box: Column, columns: list[str]) -> Column:
    """From a point to the closest place of a box; 0 inside."""
    zero = F.lit(0.0)
    return _sum_of_squares(
        [F.greatest(zero, box[f"{c}_low"] - at[c], at[c] - box[f"{c}_high"]) for c in columns]
    )


def farthest_squared(at: Column, box: Column, columns: list[str]) -> Column:
    """From a point to the farthest corner of a box."""
    return _sum_of_squares(
        [F.greatest(at[c] - box[f"{c}_low"], box[f"{c}_high"] - at[c]) for c in columns]
    )


def gap_squared(a: Column, b: Column, columns: list[str]) -> Column:
    """Between the closest places of two boxes; 0 where they overlap."""
    zero = F.lit(0.0)
    return _sum_of_squares(
        [
            F.greatest(zero, b[f"{c}_low"] - a[f"{c}_high"], a[f"{c}_low"] - b[f"{c}_high"])
            for c in columns
        ]
    )


def reach_squared(a: Column, b: Column, columns: list[str]) -> Column:
    """Between the farthest corners of two boxes."""
    return _sum_of_squares(
        [
            F.greatest(b[f"{c}_high"] - a[f"{c}_low"], a[f"{c}_high"] - b[f"{c}_low"])
            for c in columns
        ]
    )
