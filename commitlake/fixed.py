"""Fixed values that results must share with the reference.

These are stated once, here, in the reference's own terms; the rest of the
package imports them.
"""

# Url patterns (greedy leading ``.*``: the last ``/repos/``
# part that fits wins), the name used when an url has no repository, the
# name used for a file without extension, the revert marker word, and the two
# vertex types of the committer-repository graph.
REPO_NAME_PATTERN = r".*/repos/[^/]+/([^/]+)/.*"
REPO_FULL_PATTERN = r".*/repos/([^/]+/[^/]+)/.*"
OWNER_REPO_PATTERN = r".*/repos/([^/]+)/([^/]+)/.*"
NO_REPO = "norepo"
UNKNOWN_EXTENSION = "unknown"
REVERT_WORD = "Revert"
DEVELOPER = "developer"
REPOSITORY = "repository"
