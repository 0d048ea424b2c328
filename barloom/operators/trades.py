"""Trade features."""

from __future__ import annotations

from ..plans.feature import Feature
from ..plans.frame import Keep

FOUND = {"trade_rth_dollar_volume": Feature("trade_rth_dollar_volume", "trades", (Keep("sod >= 34200 AND sod < 57600"),), "sum(price * size)")}
