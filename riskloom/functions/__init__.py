"""Column-returning functions (JVM expressions, no Python UDFs)."""
from .columns import (  # noqa: F401
    assign_stage,
    bucket_severity,
    clip,
    discount_factor,
    effective_pd,
    hhi,
    is_90plus,
    lifetime_pd,
    score_band,
    sigmoid,
    vintage_label,
)
