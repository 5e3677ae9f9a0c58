"""dealsieve: company sourcing and screening operators on Spark DataFrames.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame.  Nothing collects to the driver; the plans are declarative so
Catalyst and AQE choose join strategies, prune columns and push filters.
"""

from dealsieve.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
