"""Column helpers shared by the operators.

All of them are built from Spark's own expressions, so they stay inside
whole-stage code generation and are pushed through projections by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commitlake.fixed import (  # noqa: F401  (re-exported)
    NO_REPO,
    OWNER_REPO_PATTERN,
    REPO_FULL_PATTERN,
    REPO_NAME_PATTERN,
    UNKNOWN_EXTENSION,
)
from commitlake.functions._util import as_col

REPOS_MARK = "/repos/"
# Line terminators: ``.`` in the patterns does not match them.
_LINE_BREAKS = ("\n", "\r", "\u0085", "\u2028", "\u2029")


def _with_default(extracted: Column, default: str) -> Column:
    # '' means the pattern did not match. The DataFrame style of the
    # operators keeps '' (default ''); the row style uses 'norepo', also for
    # a NULL url, and is then never NULL (so joins on it infer no filters).
    if default == "":
        return extracted
    # (A CASE, not nullif: Spark rewrites nullif into a common-expression
    # projection, which stops nested-column pruning below a generator.)
    return F.coalesce(F.when(extracted != "", extracted), F.lit(default))


def _url_pieces(url: Column):
    """(fits, owner, repo) read from the text after the last ``/repos/``.

    The patterns start with a greedy ``.*``, so they match at the last
    ``/repos/`` whose next two pieces fit ``[^/]+/[^/]+/``. When that last
    occurrence fits (and the url has no line break, which ``.`` would not
    cross) its pieces are the pattern's groups; this is a few linear scans
    instead of a backtracking regex. Other urls fall back to the regex.
    """
    rest = F.substring_index(url, REPOS_MARK, -1)
    pieces = F.split(rest, "/", 3)
    owner, repo = F.get(pieces, 0), F.get(pieces, 1)
    fits = (F.instr(url, REPOS_MARK) > 0) & (F.size(pieces) == 3) & (owner != "") & (repo != "")
    for brk in _LINE_BREAKS:
        # plain substring tests: a regex character class here costs as much
        # as the pattern it replaces
        fits = fits & ~url.contains(brk)
    return fits, owner, repo


def repo_name(url="url", default: str = NO_REPO) -> Column:
    """Bare repository name of a commit url (the part after the owner)."""
    url = as_col(url)
    fits, _owner, repo = _url_pieces(url)
    extracted = F.when(fits, repo).otherwise(F.regexp_extract(url, REPO_NAME_PATTERN, 1))
    return _with_default(extracted, default)


def repo_full(url="url", default: str = NO_REPO) -> Column:
    """``owner/repo`` of a commit url."""
    url = as_col(url)
    fits, owner, repo = _url_pieces(url)
    extracted = F.when(fits, F.concat(owner, F.lit("/"), repo)).otherwise(
        F.regexp_extract(url, REPO_FULL_PATTERN, 1)
    )
    return _with_default(extracted, default)


def repo_owner_and_name(url="url", default: str = NO_REPO) -> tuple[Column, Column]:
    """(owner, bare name) from one match of the owner/repo pattern; both are
    ``default`` when the url does not match."""
    url = as_col(url)
    fits, owner, repo = _url_pieces(url)
    # Both groups are non-empty when the pattern matches and '' when not.
    owner = F.when(fits, owner).otherwise(F.regexp_extract(url, OWNER_REPO_PATTERN, 1))
    repo = F.when(fits, repo).otherwise(F.regexp_extract(url, OWNER_REPO_PATTERN, 2))
    return _with_default(owner, default), _with_default(repo, default)


def url_piece_owner(url="url") -> Column:
    """Owner as the fifth ``/``-separated piece of the url.

    Trailing slashes are removed first, which matches Java's ``split``
    dropping trailing empty pieces; a url with fewer pieces gives NULL.
    """
    trimmed = F.rtrim(as_col(url), F.lit("/"))
    return F.get(F.split(trimmed, "/"), 4)


def file_extension(filename="filename") -> Column:
    """Extension of a file name, or ``'unknown'``.

    The name is split on dots, the first piece dropped and the last of the
    rest taken; empty trailing pieces do not count. So ``a.tar.gz`` gives
    ``gz``, ``.gitignore`` gives ``gitignore``, ``foo.`` and ``Makefile``
    give ``unknown`` and the directory part is not stripped
    (``dir.d/Makefile`` gives ``d/Makefile``). Case is kept.
    """
    trimmed = F.rtrim(as_col(filename), F.lit("."))
    return (
        F.when(trimmed.isNull() | (F.instr(trimmed, ".") == 0), F.lit(UNKNOWN_EXTENSION))
        .otherwise(F.substring_index(trimmed, ".", -1))
    )


def vertex_id(name="name") -> Column:
    """64-bit vertex id of a name.

    The name's MD5 is written as hex without leading zeros; that text is
    hashed again as a version-3 name UUID and the upper 64 bits are the id
    (so hex digit 13 of the second MD5 becomes ``3``). Signed ``bigint``.
    """
    first = F.ltrim(F.md5(as_col(name)), F.lit("0"))
    first = F.when(first == "", F.lit("0")).otherwise(first)
    second = F.md5(first)
    upper = F.concat(F.substring(second, 1, 12), F.lit("3"), F.substring(second, 14, 3))
    return F.conv(upper, 16, -10).cast("bigint")


def stat_or_zero(field: str) -> Column:
    """One field of the optional ``stats`` struct, 0 when stats are missing."""
    return F.coalesce(F.col(f"stats.{field}"), F.lit(0).cast("bigint"))


def commit_day(ts) -> Column:
    """Calendar day of a commit date (``timestamp_ntz`` in UTC)."""
    return F.to_date(as_col(ts))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 UTC."""
    return F.unix_timestamp(as_col(ts))
