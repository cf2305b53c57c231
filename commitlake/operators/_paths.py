"""Nested field paths of the commit schema used by the operators."""

AUTHOR = "commit.author.name"
COMMITTER = "commit.committer.name"
AUTHORED = "commit.author.date"
COMMITTED = "commit.committer.date"
MESSAGE = "commit.message"
URL = "url"
SHA = "sha"
