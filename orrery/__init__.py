"""orrery — ratings and text analytics on Spark DataFrames.

Every operator takes and returns DataFrames; planning is left to Catalyst
and AQE. See ``orrery.plans.catalog`` for the registered queries.
"""

from orrery.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
