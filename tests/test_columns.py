"""H1-H6: the column helpers, checked against independent Python rules."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import functions as F

from commitlake.functions import (
    file_extension,
    repo_full,
    repo_name,
    repo_owner_and_name,
    url_piece_owner,
    vertex_id,
)


def repo_owner(url, default="norepo"):
    return repo_owner_and_name(url, default)[0]


def java_extension(name):
    """Java ``name.split("\\\\.").drop(1).lastOption.getOrElse("unknown")``."""
    if name is None:
        return "unknown"
    pieces = name.split(".")
    while pieces and pieces[-1] == "" and len(pieces) > 1:
        pieces.pop()
    if pieces == [""] and name != "":
        pieces = []
    rest = pieces[1:]
    return rest[-1] if rest else "unknown"


def java_vertex_id(name: str) -> int:
    """md5 -> hex without leading zeros -> name UUID (version 3) -> upper 64 bits."""
    hex_text = format(int(hashlib.md5(name.encode("utf-8")).hexdigest(), 16), "x")
    digest = bytearray(hashlib.md5(hex_text.encode("utf-8")).digest())
    digest[6] = (digest[6] & 0x0F) | 0x30
    digest[8] = (digest[8] & 0x3F) | 0x80
    msb = uuid.UUID(bytes=bytes(digest)).int >> 64
    return msb - (1 << 64) if msb >= 1 << 63 else msb


FILENAMES = [
    "a.scala", "archive.tar.gz", "Makefile", ".gitignore", "foo.", "...", ".", "",
    "a..b", ".a.", "dir.d/Makefile", None, "A.PNG", "x..",
]


def test_file_extension_matches_java_split(spark):
    df = spark.createDataFrame([(n,) for n in FILENAMES], "filename string")
    got = dict(df.select("filename", file_extension("filename").alias("e")).collect())
    for name in FILENAMES:
        assert got[name] == java_extension(name), name
    assert got["archive.tar.gz"] == "gz"
    assert got[".gitignore"] == "gitignore"
    assert got["dir.d/Makefile"] == "d/Makefile"
    assert got["A.PNG"] == "PNG"
    assert got["foo."] == "unknown"


URLS = {
    "normal": "https://api.github.com/repos/own/rep/commits/abc",
    "no_repos": "https://example.com/x/y/z/w",
    "nothing_after": "https://api.github.com/repos/own/rep",
    "two_repos": "https://api.github.com/repos/a/b/repos/c/d/commits/e",
    "short": "a/b/c",
    "trailing": "https://api.github.com/",
}


def test_repo_names(spark):
    df = spark.createDataFrame([(k, v) for k, v in URLS.items()], "k string, url string")
    rows = {
        r["k"]: r
        for r in df.select(
            "k",
            repo_name("url").alias("bare"),
            repo_name("url", default="").alias("bare_df"),
            repo_full("url").alias("full"),
            repo_owner("url").alias("owner"),
            url_piece_owner("url").alias("piece"),
        ).collect()
    }
    assert (rows["normal"].bare, rows["normal"].full, rows["normal"].owner) == ("rep", "own/rep", "own")
    assert rows["normal"].piece == "own"
    assert rows["no_repos"].bare == "norepo" and rows["no_repos"].bare_df == ""
    assert rows["nothing_after"].full == "norepo"
    # greedy prefix: the last /repos/ part wins
    assert rows["two_repos"].full == "c/d"
    assert rows["short"].piece is None
    assert rows["trailing"].piece is None


NAMES = ["GitHub", "alice", "Oscar Näzell", "own/rep", "norepo", "", "用户", "a" * 300]


def test_vertex_id_matches_name_uuid_rule(spark):
    names = list(NAMES)
    # names whose first MD5 starts with one or more zeros
    zeros = [f"n{i}" for i in range(3000) if hashlib.md5(f"n{i}".encode()).hexdigest().startswith("0")]
    assert zeros
    names += zeros[:20]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = dict(df.select("name", vertex_id("name").alias("id")).collect())
    for name in names:
        assert got[name] == java_vertex_id(name), name
    assert any(v < 0 for v in got.values())


def test_vertex_id_null(spark):
    df = spark.createDataFrame([(None,)], "name string")
    assert df.select(vertex_id("name")).first()[0] is None


def test_helpers_are_jvm_expressions(spark):
    df = spark.createDataFrame([("a.b", URLS["normal"])], "f string, url string")
    out = df.select(file_extension("f"), repo_name("url"), vertex_id("f"), F.col("url"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


TRICKY_URLS = [
    "https://api.github.com/repos/own/rep/commits/abc",
    "https://api.github.com/repos/a/b/repos/c/d/commits/e",
    "https://api.github.com/repos/a/b/c/repos/x",          # last /repos/ does not fit
    "https://api.github.com/repos/a/b/c/repos//y/z",       # empty owner after the last one
    "https://api.github.com/repos/a/b/\nx/repos/c/d/e",    # line break: '.' stops there
    "https://api.github.com/repos/a\nb/c/d",                # line break inside the owner
    "x/repos/a/b",                                          # no slash after the repo
    "/repos/a/b/",
    "/repos/repos/x/y/",
    "no match at all",
    "",
    None,
]


def test_url_fast_path_equals_regex(spark):
    from commitlake.functions.columns import (
        OWNER_REPO_PATTERN, REPO_FULL_PATTERN, REPO_NAME_PATTERN, repo_owner_and_name,
    )

    df = spark.createDataFrame([(u,) for u in TRICKY_URLS], "url string")
    owner, repo = repo_owner_and_name("url")
    rows = df.select(
        "url",
        repo_name("url", default="").alias("bare"),
        F.regexp_extract("url", REPO_NAME_PATTERN, 1).alias("bare_re"),
        repo_full("url", default="").alias("full"),
        F.regexp_extract("url", REPO_FULL_PATTERN, 1).alias("full_re"),
        repo_owner("url", default="").alias("owner"),
        F.regexp_extract("url", OWNER_REPO_PATTERN, 1).alias("owner_re"),
        owner.alias("o2"),
        repo.alias("r2"),
        F.regexp_extract("url", OWNER_REPO_PATTERN, 2).alias("r2_re"),
        repo_name("url").alias("bare_norepo"),
    ).collect()
    for r in rows:
        assert (r.bare, r.full, r.owner) == (r.bare_re, r.full_re, r.owner_re), r.url
        if r.url is not None:
            assert (r.o2, r.r2) == ((r.owner_re, r.r2_re) if r.owner_re else ("norepo", "norepo")), r.url
            assert r.bare_norepo == (r.bare_re or "norepo")
        else:
            assert r.bare_norepo == "norepo" and r.o2 == "norepo"


def test_url_fast_path_equals_regex_random(spark):
    import random

    from commitlake.functions.columns import OWNER_REPO_PATTERN, REPO_FULL_PATTERN, REPO_NAME_PATTERN

    rng = random.Random(11)
    tokens = ["/repos/", "/", "/", "a", "bc", "repos", "\n", "\r", "x/y", "//"]
    urls = ["".join(rng.choice(tokens) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    bad = df.where(
        (repo_name("url", default="") != F.regexp_extract("url", REPO_NAME_PATTERN, 1))
        | (repo_full("url", default="") != F.regexp_extract("url", REPO_FULL_PATTERN, 1))
        | (repo_owner("url", default="") != F.regexp_extract("url", OWNER_REPO_PATTERN, 1))
    )
    assert bad.count() == 0
