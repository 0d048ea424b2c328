"""All features by name."""

from __future__ import annotations

from ..plans.feature import Feature
from . import bars, bars_more, quotes, trades  # noqa: F401
from .quotes import QuoteParams


def features(params: QuoteParams | None = None) -> dict[str, Feature]:
    """Quote features take their thresholds and code sets from params."""
    return {**bars.FOUND, **quotes.catalog(params or QuoteParams()), **trades.FOUND}
