"""Plan inspection helpers (what the tests and the bench check)."""

from commitlake.plans.inspect import PlanSummary, executed_plan_text, plan_text, summarize

__all__ = ["PlanSummary", "executed_plan_text", "plan_text", "summarize"]
