"""Retail order analytics as Spark DataFrame plans."""

from orderlens.config import Config

__all__ = ["Config"]
