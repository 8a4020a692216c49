"""Query plans over the test tables; importing this package registers all."""

from reelsight.plans import q_online, q_prep  # noqa: F401  (order: views first)
from reelsight.plans import q_ranking  # noqa: F401
from reelsight.plans import q_drift  # noqa: F401
from reelsight.plans import q_experiment  # noqa: F401
from reelsight.plans import q_monitoring  # noqa: F401
from reelsight.plans import q_io  # noqa: F401
from reelsight.plans import q_als  # noqa: F401
from reelsight.plans import q_stream  # noqa: F401
from reelsight.plans import q_sketch  # noqa: F401
from reelsight.plans.registry import PLANS, Plan, register, rounded

__all__ = ["PLANS", "Plan", "register", "rounded"]
