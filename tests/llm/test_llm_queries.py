"""Registered queries: SQL twins, schemas, and the pipeline against brute force."""

from __future__ import annotations

import uuid
import zlib

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA
from helpers import awkward, empty
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_hits
from test_jaccard_join import brute as brute_components
from test_mixing import brute_targets
from test_quality_rules import brute as brute_counts
from test_token_files import plain

import __spark_entry__ as registry
import corpus_pipeline
from commitlake.llm import mixing, queries
from commitlake.session import scratch_path
from tools.check_oracle import TABLES, _rows

SF = f"{TESTDATA}/sf0.001"

SCHEMAS = {
    "op1_decontaminate": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op2_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op3_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op4_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op5_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op6_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op7_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op12_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op13_main_text": "page_id bigint, url string, text string, n_chars bigint, n_template bigint",
}
#: Queries with a row for each word of the corpus instead of each row of a table.
BY_WORD = {"op12_spelling_variants"}


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_registered():
    assert set(SCHEMAS) == set(queries.QUERIES) and set(SCHEMAS) | {"pipeline"} <= set(registry.queries())
    assert set(queries.ORACLE_SQL) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_schema_and_a_row_for_every_row(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert ", ".join(" ".join(x) for x in df.dtypes) == SCHEMAS[name]
    if name in BY_WORD:
        return
    source = "pages" if name.startswith(("op6", "op13")) else "documents"
    assert df.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    result = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(columns, result.fetchall())


def test_op7_counts(spark):
    texts = {r.doc_id: r.text for r in docs(spark).collect()}
    for r in queries.op7_quality_rules(spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id])[:5]


def digest(text):
    ids = plain(text)
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op3_reads_back_what_a_plain_encode_gives(spark):
    got, start = {r.doc_id: r for r in queries.op3_token_files(spark, SF).collect()}, 0
    for r in docs(spark).orderBy("doc_id").collect():
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, *digest(r.text))
        start += got[r.doc_id].n_tokens


def test_every_pipeline_stage_against_brute_force(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    folder, now, stages = scratch_path(spark, f"test-pipeline-{uuid.uuid4().hex}"), docs(spark), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SF).write.parquet(f"{folder}/{i}")
        now = spark.read.parquet(f"{folder}/{i}")
        stages.append(now)
    columns = docs(spark).columns
    assert all(s.columns == columns for s in stages[:-1])
    rows = [[r.asDict() for r in s.collect()] for s in stages]
    start = [r.asDict() for r in docs(spark).collect()]
    # language: nearly all go on, and those that do are unchanged
    by_id = {r["doc_id"]: r for r in start}
    assert len(rows[0]) > 0.97 * len(start) and all(by_id[r["doc_id"]] == r for r in rows[0])
    want = brute_components({r["doc_id"]: r["text"] for r in rows[0]}, percent=80, n=5)
    assert {r["doc_id"] for r in rows[1]} == {i for i, (n, c) in want.items() if c == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in rows[2]} == {r["doc_id"] for r in rows[1] if not brute_hits(r["text"], items)[1]}
    sizes, taken = {}, {}
    for r in rows[2]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    for r in rows[3]:
        assert by_id[r["doc_id"]] == r
        taken[r["source"]] = taken.get(r["source"], 0) + len((r["text"] or "").split())
    longest = max(len((r["text"] or "").split()) for r in rows[2])
    for source, target in brute_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= longest
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows[4]) == sorted(
        (r["doc_id"], *digest(r["text"])) for r in rows[3]
    )
    ends = sorted((r["start"], r["n_tokens"]) for r in rows[4])
    assert ends[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0


def through_the_stages(spark, now):
    folder, out = scratch_path(spark, f"test-pipeline-{uuid.uuid4().hex}"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SF).write.parquet(f"{folder}/{i}")
        now = spark.read.parquet(f"{folder}/{i}")
        out.append(now)
    return out


def test_every_pipeline_stage_takes_awkward_rows(spark):
    rows = awkward(spark)  # nulls, empty and very long texts, repeated rows, clashing columns
    stages = through_the_stages(spark, rows)
    assert all(s.columns == rows.columns for s in stages[:-1])
    kept = [sorted((r.doc_id for r in s.collect()), key=str) for s in stages]
    # no letters, no language; of the two long texts, and of rows that repeat, one stays
    assert not {0, 1, 2, 5} & set(kept[0]) and {6, 7} <= set(kept[0]) and kept[0].count(50) == 5
    assert 6 in kept[1] and 7 not in kept[1] and kept[1].count(50) == 2 and kept[1].count(None) == 1
    assert kept[2] == kept[1] and set(kept[3]) <= set(kept[2]) and len(kept[4]) == len(kept[3])
    # the text stays as it was
    long = {r.text for r in rows.where("doc_id = 6").collect()}
    assert {r.text for r in stages[1].where("doc_id = 6").collect()} == long


def test_every_pipeline_stage_takes_an_empty_table(spark):
    stages = through_the_stages(spark, empty(spark))
    assert all(s.count() == 0 for s in stages) and stages[3].columns == empty(spark).columns


def test_op5_reruns_agree(spark):
    first, again = ({tuple(r) for r in queries.op5_mixing(spark, SF).collect()} for _ in range(2))
    assert first == again
    assert mixing.mix(docs(spark)).agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] > 0
