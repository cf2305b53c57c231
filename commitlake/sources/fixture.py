"""A commit table derived from the driver's TPC-H-style test tables.

The test tables hold no commits, so tests, the SQL oracle and the bench use a
deterministic commit-shaped view: one commit per ``orders`` row, one file per
``lineitem`` row of that order (``part`` gives the file name). The same
definitions are written in SQL in ``__spark_entry__.py``; ``FIXTURES.md``
lists them.

Scale: the files array is collected by a window over ``lineitem`` by order
key (a bounded group: the lines of one order, at most 17 in the test data)
and one equi-join with
``orders`` on the same key, so both sides are hash-partitioned on
``o_orderkey`` once. The shuffles and sorts carry the tables' columns; the files and
the commits, whose hashes are many times as large, are made behind them. ``part`` is joined on ``p_partkey`` without a broadcast
hint; adaptive execution turns it into a broadcast only when the runtime
size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.schema import COMMIT, FILE, PARENT

# Fixed values of the view (see FIXTURES.md section 2).
URL_PREFIX = "https://api.github.com/repos/"
HOT_COMMITTER = "GitHub"
AUTHOR_MODULUS = 200
REPO_MODULUS = 20
OWNER_SHIFT = 190
DATE_STEP = 7919
SECONDS_PER_DAY = 86400
AUTHOR_LAG_MODULUS = 5000
STATUS_BY_FLAG = {"A": "added", "R": "removed", "N": "modified"}


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _file_name(p: Column, line: Column) -> Column:
    return (
        F.when(line == 1, _text(p, ".scala"))
        .when(line == 2, _text(p, ".tar.gz"))
        .when(line == 3, p)
        .when(line == 4, _text(".", p))
        .when(line == 6, _text(p, "."))
        .when(line == 7, _text("src.d/", p))
    )


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: ``l_orderkey``, ``l_linenumber`` and the file struct, dealt by the
    one and sorted by both."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    flag, of_status = F.col("l_returnflag"), list(STATUS_BY_FLAG.items())
    code = F.lit(0)
    for i, (letter, _) in enumerate(of_status, 1):
        code = F.when(flag == letter, i).otherwise(code)
    lines = lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("l_additions"), code.alias("l_status")
    )
    # two shuffles take fewer bytes with the small values in one number, where they fit
    small = ["l_linenumber", "l_additions", "l_status"]
    fits = F.col("l_linenumber").between(0, 15) & F.col("l_additions").between(0, 2**40)
    packed = F.when(fits, (F.col("l_additions") * 16 + F.col("l_linenumber")) * 4 + F.col("l_status"))
    lines = lines.select(
        "l_orderkey", "l_partkey", packed.alias("l_packed"), *(F.when(fits, None).otherwise(F.col(c)).alias(c) for c in small)
    )
    rows = lines.join(part, lines.l_partkey == part.p_partkey, "left").drop("p_partkey")
    # dealt and sorted before the files are made: hashes and nulls are most of their bytes
    one = F.col("l_packed")
    unpacked = {"l_linenumber": F.shiftright(one, 2).bitwiseAND(15).cast("int"), "l_additions": F.shiftright(one, 6), "l_status": one.bitwiseAND(3).cast("int")}
    rows = rows.repartition("l_orderkey").withColumns({c: F.coalesce(unpacked[c], F.col(c)) for c in small}).drop("l_packed")
    rows = rows.sortWithinPartitions("l_orderkey", "l_linenumber")
    p = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    status = F.lit(None)
    for i, (_, word) in enumerate(of_status, 1):
        status = F.when(F.col("l_status") == i, F.lit(word)).otherwise(status)
    additions = F.col("l_additions")
    deletions = F.col("l_partkey") % 20
    values = {
        "sha": F.sha1(_text("f", F.col("l_orderkey"), "-", F.col("l_linenumber"), "-", F.col("l_partkey"))),
        "filename": _file_name(p, F.col("l_linenumber")),
        "status": status,
        "additions": additions,
        "deletions": deletions,
        "changes": additions + deletions,
    }
    fields = [
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FILE.fields
    ]
    return rows.select("l_orderkey", "l_linenumber", F.struct(*fields).alias("file"))


def commits_view(spark: SparkSession, sf_dir: str, with_files: bool = True) -> DataFrame:
    """The commit table of ``FIXTURES.md`` over ``orders``, ``lineitem``, ``part``.

    ``with_files=False`` leaves ``files`` as an empty array and skips reading
    ``lineitem`` and ``part``, for operators that do not look at files.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", (F.floor("o_totalprice") % 500).alias("o_additions"), "o_orderdate"
    )
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    sha = F.sha1(_text("c", k))
    author = _text("user", u % AUTHOR_MODULUS)
    committer = F.when(k % 5 == 0, F.lit(HOT_COMMITTER)).otherwise(author)
    owner = _text("user", u % REPO_MODULUS + F.when(k % 3 == 0, OWNER_SHIFT).otherwise(0))
    repo = _text("repo", u % REPO_MODULUS)
    committed = F.timestamp_add("SECOND", (k * DATE_STEP) % SECONDS_PER_DAY, F.col("o_orderdate"))
    authored = F.timestamp_add("SECOND", -(k % AUTHOR_LAG_MODULUS), committed)
    message = (
        F.when(k % 7 == 0, _text(F.repeat(F.lit("Revert "), (1 + u % 3).cast("int")), "x"))
        .when(k % 7 == 1, F.lit("Oops, Revert Revert"))
        .otherwise(F.lit("Fix"))
    )
    no_parents = F.array().cast(T.ArrayType(PARENT))
    first_parent = F.when(k % 17 == 0, F.sha1(_text("missing", k))).otherwise(
        F.sha1(_text("c", F.expr("o_orderkey div 2")))
    )
    merge_parent = F.when(
        k % 10 == 0, F.array(F.struct(F.sha1(_text("c", k - 1)).alias("sha")))
    ).otherwise(no_parents)
    parents = F.when(k == 0, no_parents).otherwise(
        F.concat(F.array(F.struct(first_parent.alias("sha"))), merge_parent)
    )
    additions = F.col("o_additions")
    deletions = u % 100
    stats = F.when(k % 11 == 0, F.lit(None)).otherwise(
        F.struct(
            (additions + deletions).alias("total"),
            additions.alias("additions"),
            deletions.alias("deletions"),
        )
    )

    def person(name: Column, date: Column) -> Column:
        return F.struct(name.alias("name"), F.lit(None).cast("string").alias("email"), date.alias("date"))

    commit = F.struct(
        person(author, authored).alias("author"),
        person(committer, committed).alias("committer"),
        message.alias("message"),
        F.struct(F.lit(None).cast("string").alias("sha")).alias("tree"),
        F.lit(0).cast("bigint").alias("comment_count"),
        F.struct(F.lit(False).alias("verified"), F.lit("unsigned").alias("reason")).alias("verification"),
    )
    own = [
        k.cast("string").alias("_id"),
        F.lit(None).cast("string").alias("node_id"),
        sha.alias("sha"),
        _text(URL_PREFIX, owner, "/", repo, "/commits/", sha).alias("url"),
        commit.alias("commit"),
        F.lit(None).alias("author"),
        F.lit(None).alias("committer"),
        parents.alias("parents"),
        stats.alias("stats"),
    ]
    empty_files = F.array().cast(T.ArrayType(FILE))
    if with_files:
        # in the order that the rows are sorted in: neither the files nor their arrays are sorted
        of_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
        every = of_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        files = file_rows(spark, sf_dir).select(
            "l_orderkey", F.collect_list("file").over(every).alias("files"), F.row_number().over(of_order).alias("nr")
        )
        files = files.where("nr = 1").drop("nr")
        joined = orders.join(files, orders.o_orderkey == files.l_orderkey, "left")
        joined = joined.select(*own, F.coalesce(F.col("files"), empty_files).alias("files"))
    else:
        joined = orders.select(*own, empty_files.alias("files"))
    # Only the NULL-literal columns and the files array get a cast: a cast
    # around the ``commit`` struct would keep Catalyst from reducing
    # ``commit.committer.name`` to the one expression it needs.
    typed = {"author", "committer", "files"}
    return joined.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name) if f.name in typed else F.col(f.name)
            for f in COMMIT.fields
        ]
    )
