"""commitlake: analytics over version-control commit history on Spark.

Every operator is a ``DataFrame -> DataFrame`` function over the nested
commit schema (``commitlake.schema.COMMIT``), built only from Spark's own
expressions, aggregates, windows and joins.
"""

from commitlake.schema import COMMIT, COMMIT_JSON, normalise_dates
from commitlake.sources import commits_view, load_commits

__all__ = ["COMMIT", "COMMIT_JSON", "commits_view", "load_commits", "normalise_dates"]
