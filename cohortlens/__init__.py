"""cohortlens: outcome analytics as Spark DataFrame operators.

Every public operator takes Spark DataFrames (plus column names as
parameters) and returns a DataFrame. Row data stays on the executors;
only statistics (means, category lists, fitted trees) reach the driver.
"""

from cohortlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
