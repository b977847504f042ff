"""Yardline: indicator-versus-target analytics on Spark DataFrames."""

from yardline.names import DOMAIN, Names
from yardline.sources.lake import Lake

__all__ = ["DOMAIN", "Lake", "Names"]
