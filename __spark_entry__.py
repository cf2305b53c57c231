"""

Every query builds the commit table of ``FIXTURES.md`` from the driver's
``orders``, ``lineitem`` and ``part`` tables (``commits_view``) and runs one
operator of ``commitlake`` over all of it. The oracle SQL rebuilds the same
commit rows in DuckDB from the same tables, in flat form (``c`` commits,
``p`` parent references, ``f`` files of commits), and computes each result
the direct way, e.g. with a plain ``row_number()`` over everything or with
the reference's own join shapes. Column names and integer widths are the
same on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake import operators as ops
from commitlake.fixed import OWNER_REPO_PATTERN, REPO_FULL_PATTERN, REPO_NAME_PATTERN
from commitlake.session import scratch_path
from commitlake.sources import commits_view, load_commits

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed arguments of the parameterised operators.
USERS = ("user1", "user42", "nobody")
COMMITTERS = ("GitHub",)
GAP_COMMITTER = "GitHub"
REPOSITORY = "repo7"
SNAPSHOT_SECONDS = 1570707029
RANK_ROUNDS, RANK_TOLERANCE = 8, 0.01


def entry(spark: SparkSession) -> DataFrame:
    return ops.weekly_commits(commits_view(spark, SMOKE_DIR, with_files=False))


def _view(spark: SparkSession, sf_dir: str, files: bool = False) -> DataFrame:
    return commits_view(spark, sf_dir, with_files=files)


def _dates_as_text(view: DataFrame) -> DataFrame:
    """The commit table with GitHub-style date text (``...T07:09:13.000Z``)."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    return view.withColumn(
        "commit",
        F.col("commit")
        .withField("author.date", F.date_format("commit.author.date", iso))
        .withField("committer.date", F.date_format("commit.committer.date", iso)),
    )


def _loaded(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return load_commits(spark, path, fmt=fmt).select(
        "sha",
        F.col("commit.committer.name").alias("committer"),
        F.col("commit.committer.date").alias("timestamp"),
        F.col("commit.author.date").alias("authored"),
        F.size("parents").alias("n_parents"),
        F.size("files").alias("n_files"),
        F.col("stats.total").alias("total"),
    )


def _jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commit table written as JSON Lines and read with ``load_commits``.

    Each call writes a folder of its own below the session's checkpoint
    folder; whoever clears that folder between applications clears these too.
    """
    path = scratch_path(spark, f"commits-jsonl-{uuid.uuid4().hex}")
    _dates_as_text(_view(spark, sf_dir, files=True)).write.json(path, compression="gzip")
    return _loaded(spark, path, "jsonl")


# Commits in one file of multi-line JSON, at most.
JSON_FILE_COMMITS = 2000


def _json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S0, the reference's form: files that each hold one JSON array over many lines."""
    path = scratch_path(spark, f"commits-json-{uuid.uuid4().hex}")
    rows = _dates_as_text(_view(spark, sf_dir, files=True)).select(F.to_json(F.struct("*")).alias("value"))

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []

        def texts(most: int) -> Iterator[pa.RecordBatch]:
            while len(held) >= most:
                yield pa.RecordBatch.from_arrays([pa.array(["[\n" + ",\n".join(held[:JSON_FILE_COMMITS]) + "\n]"], pa.string())], ["value"])
                del held[:JSON_FILE_COMMITS]

        for batch in batches:
            held += batch.column(0).to_pylist()
            yield from texts(JSON_FILE_COMMITS)
        yield from texts(1)

    # each task writes its own commits: they need not meet in a shuffle
    rows.mapInArrow(arrays, "value string").write.option("maxRecordsPerFile", 1).text(path, compression="gzip")
    return _loaded(spark, path, "json")


# Commits in one large file of multi-line JSON, about, at least.
JSON_LARGE_FILE_COMMITS = 50_000


def _json_ranges_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S0, large files of one JSON array each, read by byte ranges."""
    path = scratch_path(spark, f"commits-json-large-{uuid.uuid4().hex}")
    files = max(1, _view(spark, sf_dir).count() // JSON_LARGE_FILE_COMMITS)
    rows = _dates_as_text(_view(spark, sf_dir, files=True))
    lines = rows.select(F.to_json(F.struct("*")).alias("value")).coalesce(files)

    def array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            values = []
            for line in batch.column(0).to_pylist():
                values.append(before + line)
                before = ","
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"])], ["value"])

    lines.mapInArrow(array, "value string").write.text(path)
    return _loaded(spark, path, "json_ranges")


def _gaps(commits: DataFrame, committer: str | None = None) -> DataFrame:
    columns = (F.col("commit.committer.name").alias("committer"), "sha")
    return ops.commit_gaps(commits, committer, columns=columns)


def _of_row() -> list[Column]:
    """Values from all over a commit's row."""
    return [
        F.col("url"),
        F.col("commit.author.name").alias("author"),
        F.col("commit.message").alias("message"),
        F.col("stats.total").alias("total"),
        F.size("parents").alias("n_parents"),
        F.size("files").alias("n_files"),
        F.array_max("files.sha").alias("last_file_sha"),
    ]


def _with_row(df: DataFrame, result: str) -> DataFrame:
    """``result`` beside values from all over the row that it was added to."""
    return df.select("sha", result, *_of_row())


def _gaps_with_row(commits: DataFrame) -> DataFrame:
    """The same for the gaps, whose shuffles carry the values instead of the files."""
    found = ops.commit_gaps(commits, columns=("sha", *_of_row()))
    return found.select("sha", "time_diff", *(c for c in found.columns if c not in ("sha", "time_diff")))


# name -> (needs the files array, query over a commit DataFrame). The bench
# runs the same definitions over a materialised commit table.
OPERATOR_QUERIES: dict[str, tuple[bool, Callable[[DataFrame], DataFrame]]] = {
    "commit_count": (False, ops.commit_count),
    "file_extensions": (True, ops.file_extensions),
    "author_ranking": (False, ops.author_ranking),
    "user_stats": (False, lambda c: ops.user_stats(c, USERS)),
    "exclusive_people": (False, ops.exclusive_people),
    "revert_streaks": (False, ops.revert_streaks),
    "repo_committers": (False, ops.repo_committers),
    "latest_files": (
        True,
        lambda c: ops.latest_files(c, fields=("filename", "sha", "status")).withColumnRenamed(
            "sha", "file_sha"
        ),
    ),
    "file_history": (True, lambda c: ops.file_history(c, REPOSITORY)),
    "file_commits": (True, lambda c: ops.file_commits(c, REPOSITORY)),
    "committer_repo_stats": (False, ops.committer_repo_stats),
    "graph_vertices": (False, ops.graph_vertices),
    "graph_edges": (False, ops.graph_edges),
    "commits_by_committer": (False, lambda c: ops.commits_by_committer(c, COMMITTERS)),
    "weekly_commits": (False, ops.weekly_commits),
    "commit_age": (False, lambda c: ops.commit_age(c, SNAPSHOT_SECONDS).select("sha", "age")),
    "commit_gaps": (False, _gaps),
    "commit_gaps_one": (False, lambda c: _gaps(c, GAP_COMMITTER)),
    "commit_age_rows": (True, lambda c: _with_row(ops.commit_age(c, SNAPSHOT_SECONDS), "age")),
    "commit_gaps_rows": (True, _gaps_with_row),
    "commit_delay_rows": (True, lambda c: _with_row(ops.commit_delay(c), "commit_time_diff")),
    "weekday_commits": (False, ops.weekday_commits),
    "commit_delay": (False, lambda c: ops.commit_delay(c).select("sha", "commit_time_diff")),
    "branch_points": (False, ops.branch_points),
    "fork_points": (False, ops.fork_points),
    "graph_rank": (False, lambda c: ops.graph_rank(*ops.commit_graph(c), rounds=RANK_ROUNDS, tolerance=RANK_TOLERANCE)),
    "commit_generations": (False, ops.generations),
    "merge_bases": (False, ops.merge_bases),
    "previous_versions": (True, ops.previous_versions),
}


def _on_view(files: bool, fn: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: fn(_view(spark, sf_dir, files))


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators and their pipeline; none
    where that subpackage or the pipeline's file is not there."""
    try:
        import corpus_pipeline
        from commitlake.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name not in ("commitlake.llm", "corpus_pipeline"):
            raise
        return {}, {}
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def commit_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = {name: _on_view(files, fn) for name, (files, fn) in OPERATOR_QUERIES.items()}
    registered["load_commits_jsonl"] = _jsonl_roundtrip
    registered["load_commits_json"] = _json_roundtrip
    registered["load_commits_json_ranges"] = _json_ranges_roundtrip
    return registered


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The commit operators and, where it is there, the training-data subpackage."""
    return {**commit_queries(), **_training_data()[0]}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

_BARE, _FULL, _BOTH = f"'{REPO_NAME_PATTERN}'", f"'{REPO_FULL_PATTERN}'", f"'{OWNER_REPO_PATTERN}'"

_COMMITS = """
c AS (
  SELECT
    o_orderkey AS k,
    sha1('c' || o_orderkey) AS sha,
    'user' || (o_custkey % 200) AS author,
    CASE WHEN o_orderkey % 5 = 0 THEN 'GitHub' ELSE 'user' || (o_custkey % 200) END AS committer,
    'https://api.github.com/repos/user'
      || (o_custkey % 20 + CASE WHEN o_orderkey % 3 = 0 THEN 190 ELSE 0 END)
      || '/repo' || (o_custkey % 20) || '/commits/' || sha1('c' || o_orderkey) AS url,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS cdate,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) - to_seconds(o_orderkey % 5000) AS adate,
    CASE WHEN o_orderkey % 7 = 0 THEN repeat('Revert ', CAST(1 + o_custkey % 3 AS INTEGER)) || 'x'
         WHEN o_orderkey % 7 = 1 THEN 'Oops, Revert Revert'
         ELSE 'Fix' END AS message,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         ELSE CAST(floor(o_totalprice) AS BIGINT) % 500 + o_custkey % 100 END AS total,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) % 500 END AS additions,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey % 100 END AS deletions
  FROM orders
)"""

_PARENTS = """
p AS (
  SELECT k, sha AS child_sha,
         CASE WHEN k % 17 = 0 THEN sha1('missing' || k) ELSE sha1('c' || (k // 2)) END AS parent_sha
  FROM c WHERE k > 0
  UNION ALL
  SELECT k, sha, sha1('c' || (k - 1)) FROM c WHERE k > 0 AND k % 10 = 0
)"""

_FILES = """
f AS (
  SELECT l.l_orderkey AS k,
         sha1('f' || l.l_orderkey || '-' || l.l_linenumber || '-' || l.l_partkey) AS file_sha,
         CASE l.l_linenumber WHEN 1 THEN pn || '.scala' WHEN 2 THEN pn || '.tar.gz'
              WHEN 3 THEN pn WHEN 4 THEN '.' || pn WHEN 6 THEN pn || '.'
              WHEN 7 THEN 'src.d/' || pn END AS filename,
         CASE l.l_returnflag WHEN 'A' THEN 'added' WHEN 'R' THEN 'removed'
              WHEN 'N' THEN 'modified' END AS status,
         CAST(trunc(l.l_quantity) AS BIGINT) AS f_additions,
         l.l_partkey % 20 AS f_deletions
  FROM lineitem l
  LEFT JOIN (SELECT p_partkey, replace(p_name, ' ', '_') AS pn FROM part) pp
    ON l.l_partkey = pp.p_partkey
),
cf AS (SELECT c.*, f.file_sha, f.filename, f.status, f.f_additions, f.f_deletions
       FROM c JOIN f ON c.k = f.k)"""


# Edges between commits of the table, and every length of a path from a commit without parents.
_ANCESTRY = """
e AS (SELECT DISTINCT child_sha AS child, parent_sha AS parent
      FROM p WHERE parent_sha IN (SELECT sha FROM c) AND parent_sha <> child_sha),
g AS (SELECT sha, CAST(1 AS BIGINT) AS generation FROM c WHERE sha NOT IN (SELECT child FROM e)
      UNION
      SELECT e.child, g.generation + 1 FROM g JOIN e ON e.parent = g.sha)"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)


def _graph_rank_sql(full_or_norepo: str) -> str:
    """The rounds one after another; once they have stopped, ranks stay."""
    steps = [
        f"""
v AS MATERIALIZED (SELECT DISTINCT {_vertex_id_sql("name")} AS id FROM (
  SELECT committer AS name FROM c UNION SELECT {full_or_norepo} FROM c) WHERE name IS NOT NULL),
e AS MATERIALIZED (SELECT DISTINCT {_vertex_id_sql("committer")} AS src, {_vertex_id_sql("r")} AS dst
  FROM (SELECT committer, {full_or_norepo} AS r FROM c WHERE committer IS NOT NULL)),
r0 AS MATERIALIZED (
  SELECT id, "out", CAST(1000000000 AS BIGINT) AS rank, CAST(NULL AS BIGINT) AS change, 0 AS done
  FROM v LEFT JOIN (SELECT src, count(*) AS "out" FROM e GROUP BY src) ON src = id)"""
    ]
    for i in range(RANK_ROUNDS):
        steps.append(
            f"""
t{i} AS MATERIALIZED (
  SELECT 150000000 + 85 * coalesce(sum(rank) FILTER ("out" IS NULL), 0) // (100 * count(*)) AS every,
         coalesce(sum(change) < {RANK_TOLERANCE} * 1000000000 * count(*), false) AS stopped FROM r{i}),
n{i} AS MATERIALIZED (
  SELECT r.*, CAST(coalesce(got, 0) + every AS BIGINT) AS new, stopped
  FROM r{i} r CROSS JOIN t{i}
  LEFT JOIN (SELECT dst, sum(rank * 85 // (100 * "out")) AS got FROM e JOIN r{i} ON src = id GROUP BY dst) ON dst = id),
r{i + 1} AS MATERIALIZED (
  SELECT id, "out", CASE WHEN stopped THEN rank ELSE new END AS rank,
         CASE WHEN stopped THEN change ELSE abs(new - rank) END AS change,
         done + CASE WHEN stopped THEN 0 ELSE 1 END AS done FROM n{i})"""
        )
    return _with(_COMMITS, *steps) + f" SELECT id, rank / 1000000000 AS rank, done AS rounds FROM r{RANK_ROUNDS}"


def _vertex_id_sql(name: str) -> str:
    first = f"CASE WHEN ltrim(md5({name}), '0') = '' THEN '0' ELSE ltrim(md5({name}), '0') END"
    upper = f"substr(md5({first}), 1, 12) || '3' || substr(md5({first}), 14, 3)"
    unsigned = f"CAST('0x' || {upper} AS UBIGINT)"
    return (
        f"CAST(CASE WHEN {unsigned} >= 9223372036854775808 "
        f"THEN CAST({unsigned} AS HUGEINT) - 18446744073709551616 "
        f"ELSE CAST({unsigned} AS HUGEINT) END AS BIGINT)"
    )


def _stat_sums(prefix: str = "") -> str:
    return ", ".join(
        f"CAST(sum(coalesce({prefix}{x}, 0)) AS BIGINT) AS {x}" for x in ("total", "additions", "deletions")
    )


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def oracle_sql() -> dict[str, str]:
    return {**commit_oracle_sql(), **_training_data()[1]}


def commit_oracle_sql() -> dict[str, str]:
    bare = f"regexp_extract(url, {_BARE}, 1)"
    full = f"regexp_extract(url, {_FULL}, 1)"
    norepo_bare = f"CASE WHEN {bare} = '' THEN 'norepo' ELSE {bare} END"
    norepo_full = f"CASE WHEN {full} = '' THEN 'norepo' ELSE {full} END"
    gaps = (
        "SELECT committer, sha, CAST(coalesce(date_diff('day', CAST(lag(cdate) OVER "
        "(PARTITION BY committer ORDER BY cdate, sha) AS DATE), CAST(cdate AS DATE)), 0) AS INTEGER) "
        "AS time_diff FROM c"
    )
    whole = (
        "url, author, message, total, CAST((SELECT count(*) FROM p WHERE p.k = {0}.k) AS INTEGER) AS n_parents, "
        "CAST((SELECT count(*) FROM f WHERE f.k = {0}.k) AS INTEGER) AS n_files, "
        "(SELECT max(file_sha) FROM f WHERE f.k = {0}.k) AS last_file_sha"
    )
    loaded = _with(_COMMITS, _PARENTS, _FILES) + """ SELECT c.sha, c.committer, c.cdate AS timestamp, c.adate AS authored,
                 CAST((SELECT count(*) FROM p WHERE p.k = c.k) AS INTEGER) AS n_parents,
                 CAST((SELECT count(*) FROM f WHERE f.k = c.k) AS INTEGER) AS n_files,
                 c.total
           FROM c"""
    return {
        "commit_count": _with(_COMMITS) + " SELECT count(*) AS n_commits FROM c",
        "file_extensions": _with(_COMMITS, _FILES)
        + """ SELECT CASE WHEN filename IS NULL OR instr(rtrim(filename, '.'), '.') = 0 THEN 'unknown'
                     ELSE regexp_extract(rtrim(filename, '.'), '[^.]*$') END AS extension,
                count(*) AS n
           FROM cf GROUP BY 1""",
        "author_ranking": _with(_COMMITS)
        + """ SELECT CAST(row_number() OVER (ORDER BY n_commits DESC, lower(author) ASC NULLS FIRST,
                                             author ASC NULLS FIRST) - 1 AS BIGINT) AS rank,
                author, n_commits
           FROM (SELECT author, count(*) AS n_commits FROM c GROUP BY author)""",
        "user_stats": _with(_COMMITS)
        + f" SELECT author, {_stat_sums()} FROM c WHERE author IN ({_in_list(USERS)}) GROUP BY author",
        "exclusive_people": _with(_COMMITS)
        + """ SELECT name FROM (
             (SELECT author AS name FROM c EXCEPT SELECT split_part(url, '/', 5) FROM c)
             UNION ALL
             (SELECT split_part(url, '/', 5) AS name FROM c EXCEPT SELECT author FROM c))""",
        "revert_streaks": _with(_COMMITS)
        + """, s AS (SELECT author,
                         CAST((length(message) - length(replace(message, 'Revert', ''))) // 6 AS INTEGER) AS streak
                  FROM c WHERE starts_with(message, 'Revert')),
             g AS (SELECT author, streak, count(*) AS n FROM s GROUP BY author, streak)
           SELECT g.author, g.streak, g.n FROM g
           JOIN (SELECT author, max(streak) AS top FROM g GROUP BY author) m
             ON g.author = m.author AND g.streak = m.top""",
        "repo_committers": _with(_COMMITS)
        + f""", r AS (SELECT regexp_extract(url, {_BOTH}, 1) AS o, regexp_extract(url, {_BOTH}, 2) AS n, committer FROM c),
             t AS (SELECT CASE WHEN o = '' THEN 'norepo' ELSE o END AS owner,
                          CASE WHEN o = '' THEN 'norepo' ELSE n END AS repo,
                          committer, count(*) AS cnt
                   FROM r GROUP BY ALL)
           SELECT owner, repo, CAST(sum(cnt) OVER (PARTITION BY owner, repo) AS BIGINT) AS n_commits, committer,
                  cnt AS committer_commits
           FROM t""",
        "latest_files": _with(_COMMITS, _FILES)
        + f""", named AS (SELECT {norepo_bare} AS repo, cdate, sha, file_sha, filename, status, f_additions
                       FROM cf WHERE filename IS NOT NULL),
             ranked AS (SELECT repo, filename, file_sha, status,
                               row_number() OVER (PARTITION BY repo, filename
                                 ORDER BY cdate DESC, sha DESC, file_sha DESC, status DESC, f_additions DESC) AS rn
                        FROM named)
           SELECT repo, filename, file_sha, status FROM ranked WHERE rn = 1
           UNION ALL
           SELECT DISTINCT {norepo_bare} AS repo, NULL, NULL, NULL FROM c
           WHERE {norepo_bare} NOT IN (SELECT repo FROM named)""",
        "file_history": _with(_COMMITS, _FILES)
        + f""" SELECT filename, count(*) AS n_commits,
                 CAST(sum(f_additions + f_deletions) AS BIGINT) AS total,
                 CAST(sum(f_additions) AS BIGINT) AS additions,
                 CAST(sum(f_deletions) AS BIGINT) AS deletions
           FROM cf WHERE {norepo_bare} = '{REPOSITORY}' AND filename IS NOT NULL
           GROUP BY filename""",
        "file_commits": _with(_COMMITS, _FILES)
        + f" SELECT filename, sha FROM cf WHERE {norepo_bare} = '{REPOSITORY}' AND filename IS NOT NULL",
        "committer_repo_stats": _with(_COMMITS)
        + f" SELECT committer, {norepo_bare} AS repo, {_stat_sums()} FROM c GROUP BY 1, 2",
        "graph_vertices": _with(_COMMITS)
        + f""", names AS (SELECT committer AS name, 'developer' AS type FROM c
                       UNION
                       SELECT {norepo_full}, 'repository' FROM c)
           SELECT {_vertex_id_sql('name')} AS id, name, type FROM names WHERE name IS NOT NULL""",
        "graph_edges": _with(_COMMITS)
        + f""" SELECT DISTINCT {_vertex_id_sql('committer')} AS src, {_vertex_id_sql('r')} AS dst
           FROM (SELECT committer, {norepo_full} AS r FROM c WHERE committer IS NOT NULL)""",
        "commits_by_committer": _with(_COMMITS)
        + f" SELECT committer, sha, cdate AS timestamp FROM c WHERE committer IN ({_in_list(COMMITTERS)})",
        "weekly_commits": _with(_COMMITS)
        + f""" SELECT {bare} AS repository, CAST(weekofyear(cdate) AS INTEGER) AS week,
                 CAST(year(cdate) AS INTEGER) AS year, count(*) AS count
           FROM c GROUP BY 1, 2, 3""",
        "commit_age": _with(_COMMITS)
        + f" SELECT sha, {SNAPSHOT_SECONDS} - CAST(floor(epoch(cdate)) AS BIGINT) AS age FROM c",
        "commit_gaps": _with(_COMMITS) + " " + gaps,
        "commit_gaps_one": _with(_COMMITS) + f" SELECT * FROM ({gaps}) WHERE committer = '{GAP_COMMITTER}'",
        "weekday_commits": _with(_COMMITS)
        + " SELECT CAST(dayofweek(cdate) + 1 AS INTEGER) AS day, count(*) AS commits_per_day FROM c GROUP BY 1",
        "commit_delay": _with(_COMMITS)
        + " SELECT sha, CAST(date_diff('second', adate, cdate) AS BIGINT) AS commit_time_diff FROM c",
        "branch_points": _with(_COMMITS, _PARENTS)
        + """ SELECT p.parent_sha AS sha, count(*) AS times_parent
           FROM p JOIN c ON p.parent_sha = c.sha
           GROUP BY p.parent_sha HAVING count(*) >= 2""",
        "fork_points": _with(_COMMITS, _PARENTS)
        + f""" SELECT pc.repo_name AS parent_repo_name, cc.repo_name AS child_repo_name,
                 pc.sha AS parent_sha, p.child_sha, pc.n
           FROM p
           JOIN (SELECT k, {full} AS repo_name FROM c) cc ON p.k = cc.k
           JOIN (SELECT sha, {full} AS repo_name, count(*) AS n FROM c GROUP BY 1, 2) pc
             ON p.parent_sha = pc.sha
           WHERE pc.repo_name <> cc.repo_name""",
        "commit_age_rows": _with(_COMMITS, _PARENTS, _FILES)
        + f" SELECT sha, {SNAPSHOT_SECONDS} - CAST(floor(epoch(cdate)) AS BIGINT) AS age, {whole.format('c')} FROM c",
        "commit_delay_rows": _with(_COMMITS, _PARENTS, _FILES)
        + f" SELECT sha, CAST(date_diff('second', adate, cdate) AS BIGINT) AS commit_time_diff, {whole.format('c')} FROM c",
        "commit_gaps_rows": _with(_COMMITS, _PARENTS, _FILES)
        + f", g AS ({gaps.replace('FROM c', ', k AS gk FROM c')})"
        + f" SELECT c.sha, g.time_diff, {whole.format('c')} FROM c JOIN g ON g.gk = c.k",
        "load_commits_jsonl": loaded,
        "load_commits_json": loaded,
        "load_commits_json_ranges": loaded,
        "graph_rank": _graph_rank_sql(full_or_norepo=norepo_full),
        "commit_generations": _with(_COMMITS, _PARENTS, _ANCESTRY) + " SELECT sha, max(generation) AS generation FROM g GROUP BY sha",
        "previous_versions": _with(_COMMITS, _FILES)
        + f""", named AS (SELECT sha, {norepo_bare} AS repo, filename, file_sha, cdate FROM cf WHERE filename IS NOT NULL),
             versions AS (SELECT repo, filename, cdate, max(row(file_sha, sha)) AS v FROM named GROUP BY ALL)
           SELECT n.sha, n.repo, n.filename, n.file_sha, v[2] AS previous_sha, v[1] AS previous_file_sha,
                  w.cdate AS previous_date
           FROM named n ASOF LEFT JOIN versions w
             ON n.repo = w.repo AND n.filename = w.filename AND n.cdate > w.cdate""",
        "merge_bases": _with(_COMMITS, _PARENTS, _ANCESTRY)
        + """, gen AS (SELECT sha, max(generation) AS generation FROM g GROUP BY sha),
             two AS (SELECT x.child AS sha, x.parent AS parent_a, y.parent AS parent_b
                     FROM e x JOIN e y ON x.child = y.child AND x.parent < y.parent),
             anc AS (SELECT DISTINCT s AS start, s AS sha
                     FROM (SELECT parent_a AS s FROM two UNION SELECT parent_b FROM two)
                     UNION
                     SELECT anc.start, e.parent FROM anc JOIN e ON e.child = anc.sha),
             both_of AS (SELECT two.sha, parent_a, parent_b, gen.sha AS base, gen.generation,
                                row_number() OVER (PARTITION BY two.sha, parent_a, parent_b
                                                   ORDER BY gen.generation DESC, gen.sha) AS nr
                         FROM two JOIN anc a ON a.start = parent_a
                         JOIN anc b ON b.start = parent_b AND a.sha = b.sha JOIN gen ON gen.sha = a.sha)
           SELECT two.sha, two.parent_a, two.parent_b, base, generation
           FROM two LEFT JOIN both_of o
             ON o.sha = two.sha AND o.parent_a = two.parent_a AND o.parent_b = two.parent_b AND nr = 1""",
    }
