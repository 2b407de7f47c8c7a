"""aisle — customer analytics for online retail, written as Spark DataFrame jobs.

Every operator is a function ``f(DataFrame..., params) -> DataFrame``; nothing is
collected to the driver, and every plan is left to Catalyst/AQE to schedule.
"""

from aisle.params import Params

__all__ = ["Params"]
