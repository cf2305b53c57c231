"""O2, O8, O9."""

from __future__ import annotations

from commitlake import operators as ops

from conftest import commit, file, url


def test_file_extensions(commits):
    df = commits([
        commit("a", files=[file("a.scala"), file("b.scala"), file(None), file("Makefile")]),
        commit("b", files=[file("x.PNG"), file("y.png"), file(".gitignore")]),
        commit("c", files=[]),
    ])
    got = dict(tuple(r) for r in ops.file_extensions(df).collect())
    assert got == {"scala": 2, "unknown": 2, "PNG": 1, "png": 1, "gitignore": 1}


def test_latest_files_newest_and_ties(commits):
    u = url("javie-lau", "hackaton")
    u2 = url("other-owner", "hackaton")
    df = commits([
        commit("c1", url_=u, date="2019-01-01T00:00:00",
               files=[file("src/style.css", sha="old"), file("gone.txt", sha="g1", status="added")]),
        commit("c2", url_=u2, date="2019-02-01T00:00:00",
               files=[file("src/style.css", sha="eea08e"), file("gone.txt", sha="g2", status="removed")]),
        # same date as c2: the larger commit sha wins
        commit("c0", url_=u, date="2019-02-01T00:00:00", files=[file("src/style.css", sha="zzz")]),
        # a single commit with a repeated name keeps one
        commit("s1", url_=url("o", "single"), files=[file("a.txt", sha="f1"), file("a.txt", sha="f2")]),
        commit("n1", url_=url("o", "empty"), files=[file(None)]),
        commit("n2", url_=url("o", "nofiles"), files=[]),
    ])
    got = sorted(
        (r.repo, r.filename, r.sha, r.status)
        for r in ops.latest_files(df).collect()
    )
    assert got == [
        ("empty", None, None, None),
        ("hackaton", "gone.txt", "g2", "removed"),
        ("hackaton", "src/style.css", "eea08e", "modified"),
        ("nofiles", None, None, None),
        ("single", "a.txt", "f2", "modified"),
    ]
    narrow = ops.latest_files(df, fields=("filename", "sha"), keep_empty_repos=False)
    assert narrow.columns == ["repo", "filename", "sha"]
    assert narrow.count() == 3


def test_file_history_and_commits(commits):
    rs = url("o", "gitlab-rs")
    df = commits([
        commit("a", url_=rs, files=[file("rustfmt.toml", additions=10), file("x", additions=1, deletions=1)]),
        commit("b", url_=rs, files=[file("rustfmt.toml", additions=2), file("rustfmt.toml", additions=0),
                                    file(None, additions=100)]),
        commit("c", url_=url("o", "other"), files=[file("rustfmt.toml", additions=5)]),
        commit("d", url_=url("p", "gitlab-rs"), files=[file("x", additions=0, deletions=3)]),
    ])
    hist = {r.filename: tuple(r)[1:] for r in ops.file_history(df, "gitlab-rs").collect()}
    assert hist == {"rustfmt.toml": (3, 12, 12, 0), "x": (2, 5, 1, 4)}
    shas = sorted(tuple(r) for r in ops.file_commits(df, "gitlab-rs").collect())
    assert shas == [("rustfmt.toml", "a"), ("rustfmt.toml", "b"), ("rustfmt.toml", "b"), ("x", "a"), ("x", "d")]


def test_latest_files_random_against_brute_force(commits):
    import datetime as dt
    import random

    rng = random.Random(4)
    rows, best = [], {}
    for i in range(400):
        repo = rng.choice(["a", "b"])
        when = dt.datetime(2019, 1, 1) + dt.timedelta(days=rng.randint(0, 5))  # many equal dates
        files = []
        for _ in range(rng.randint(0, 4)):
            name = rng.choice(["x.py", "y.py", "z", None])
            fsha = f"f{rng.randint(0, 30)}"
            status = rng.choice(["added", "removed", "modified"])
            adds = rng.randint(0, 3)
            files.append(file(name, sha=fsha, status=status, additions=adds))
            if name is not None:
                key = (when, f"c{i:03d}", fsha, status, adds)
                if (repo, name) not in best or key > best[(repo, name)]:
                    best[(repo, name)] = key
        rows.append(commit(f"c{i:03d}", url_=url("o", repo, f"c{i}"), date=when, files=files))
    got = {
        (r.repo, r.filename): (r.sha, r.status, r.additions)
        for r in ops.latest_files(commits(rows), fields=("filename", "sha", "status", "additions"),
                                  keep_empty_repos=False).collect()
    }
    assert got == {k: v[2:] for k, v in best.items()}
