"""Physical-plan inspection: what Catalyst chose for a query (used by the
tests and the bench to keep the plans the intended shape)."""

from murmuration.plans.inspect import (
    operator_names,
    plan_string,
    plan_summary,
    python_nodes,
    scan_details,
)

__all__ = ["operator_names", "plan_string", "plan_summary", "python_nodes", "scan_details"]
