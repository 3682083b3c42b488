"""Rows of a frame in a form that compares."""

from __future__ import annotations


def tuples(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
