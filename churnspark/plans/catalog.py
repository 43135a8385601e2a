"""All registered queries."""

from churnspark.plans import (  # noqa: F401
    queries_build,
    queries_ml,
    queries_monitor,
    queries_score,
    queries_stream,
)
from churnspark.plans.registry import CATALOG  # noqa: F401
