"""Expressions for features, by their names in SQL text."""

from ..plans.frame import clip, corr, div, lag, lead, number, over, pct, rows, running, share, slope, total, when

__all__ = ["clip", "corr", "div", "lag", "lead", "number", "over", "pct", "rows", "running", "share", "slope", "total", "when"]
