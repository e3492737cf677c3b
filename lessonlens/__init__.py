"""lessonlens — learning-progress analytics as Spark DataFrame plans.

Every operator is a function from DataFrames to a DataFrame built from
built-in Spark column functions.  Nothing is collected to the driver except
scalar checks (sizes, a high-water mark).
"""

from lessonlens.session import get_session, tune

__all__ = ["get_session", "tune"]
