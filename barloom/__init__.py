"""Intraday market feature engine on Spark."""
