"""Named queries over the standard test tables, each with an equivalent SQL text where one exists."""

from .registry import CATALOG, Lake

from . import changes, events, geo, lake, orders, quality, streams  # noqa: E402,F401  (fill the catalog)

__all__ = ["CATALOG", "Lake"]
