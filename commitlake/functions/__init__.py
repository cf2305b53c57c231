"""Column-level helpers (repository names, file extensions, vertex ids)."""

from commitlake.functions.columns import (
    NO_REPO,
    UNKNOWN_EXTENSION,
    commit_day,
    epoch_seconds,
    file_extension,
    repo_full,
    repo_name,
    repo_owner_and_name,
    stat_or_zero,
    url_piece_owner,
    vertex_id,
)

__all__ = [
    "NO_REPO",
    "UNKNOWN_EXTENSION",
    "commit_day",
    "epoch_seconds",
    "file_extension",
    "repo_full",
    "repo_name",
    "repo_owner_and_name",
    "stat_or_zero",
    "url_piece_owner",
    "vertex_id",
]
