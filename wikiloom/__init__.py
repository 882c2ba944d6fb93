"""Wiki dumps to relations on Spark: pages, links, categories, redirects, templates and statistics as DataFrames."""

from .config import SITES, SiteConfig

__all__ = ["SITES", "SiteConfig"]
