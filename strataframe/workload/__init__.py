"""The registered queries over the driver's tables."""

from strataframe.workload import bronze_queries, flow_queries, privacy_queries, quality_queries, star_queries  # noqa: F401
from strataframe.workload.registry import CHECKS, QUERIES  # noqa: F401
