"""Sources: the commit loader (S0) and the test-table commit view."""

from commitlake.sources.commits import load_commits
from commitlake.sources.fixture import commits_view

__all__ = ["commits_view", "load_commits"]
