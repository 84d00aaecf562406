"""Import every query module so the registry is complete."""

from . import metric_queries, order_queries, seller_queries, stat_queries  # noqa: F401
from .registry import REGISTRY  # noqa: F401
