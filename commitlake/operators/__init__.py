"""The analytics operators; each is a ``DataFrame -> DataFrame`` function
over the commit schema of ``commitlake.schema``."""

from commitlake.operators.activity import (
    author_ranking,
    commit_age,
    commit_count,
    commit_delay,
    commit_gaps,
    commits_by_committer,
    weekday_commits,
    weekly_commits,
)
from commitlake.operators.ancestry import common_ancestors, generations, merge_bases
from commitlake.operators.asof import as_of_join, previous_versions
from commitlake.operators.files import file_commits, file_extensions, file_history, latest_files
from commitlake.operators.graph import commit_graph, graph_edges, graph_vertices
from commitlake.operators.lineage import branch_points, fork_points
from commitlake.operators.people import (
    committer_repo_stats,
    exclusive_people,
    repo_committers,
    revert_streaks,
    user_stats,
)
from commitlake.operators.ranking import graph_rank

__all__ = [
    "as_of_join",
    "author_ranking",
    "branch_points",
    "commit_age",
    "commit_count",
    "commit_delay",
    "commit_gaps",
    "commit_graph",
    "common_ancestors",
    "commits_by_committer",
    "committer_repo_stats",
    "exclusive_people",
    "file_commits",
    "file_extensions",
    "file_history",
    "fork_points",
    "generations",
    "graph_edges",
    "graph_rank",
    "graph_vertices",
    "latest_files",
    "merge_bases",
    "previous_versions",
    "repo_committers",
    "revert_streaks",
    "user_stats",
    "weekday_commits",
    "weekly_commits",
]
