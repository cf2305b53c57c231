"""What the queries on whole rows and the JSON round trips shuffle and write."""

from __future__ import annotations

import os
import re
from urllib.parse import urlparse

import pytest
from conftest import TESTDATA, commit

import __spark_entry__ as registry
from commitlake.plans.inspect import plan_text
from commitlake.sources import json_ranges


def test_gaps_with_row_do_not_shuffle_files(spark, commits, tmp_path):
    commits([commit(sha=f"s{i}") for i in range(5)]).write.parquet(str(tmp_path / "c"))
    text = plan_text(registry.OPERATOR_QUERIES["commit_gaps_rows"][1](spark.read.parquet(str(tmp_path / "c"))))
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    assert inputs and not any(re.search(r"\bfiles#", columns) for columns in inputs)


@pytest.mark.parametrize("name", ["load_commits_json", "load_commits_jsonl"])
def test_written_json_is_compressed(spark, name):
    files = registry.queries()[name](spark, f"{TESTDATA}/sf0.001").inputFiles()
    assert files and all(f.endswith(".gz") and os.path.exists(urlparse(f).path) for f in files)


def test_first_pass_over_ranges_runs_once(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"sha": "a"}]')
    assert "FlatMapGroupsInPandas" not in plan_text(json_ranges.record_texts(spark, [str(tmp_path)]))


def test_odd_runs_of_escapes_keep_a_quote_in_its_string(spark, tmp_path):
    row = r'{"sha": "a\\\\", "url": "\\\"}{", "message": "\"}"}'
    (tmp_path / "x.json").write_text(f"[{row}, {row}]")
    assert [x.value for x in json_ranges.record_texts(spark, [str(tmp_path)]).collect()] == [row, row]


def test_tables_are_shuffled_and_sorted_before_commits_and_files_are_made(spark):
    """Hashes and arrays of files go through no shuffle and no sort."""
    text = plan_text(registry._view(spark, f"{TESTDATA}/sf0.001", files=True))
    moved = re.findall(r"\) (?:Exchange|Sort|ObjectHashAggregate)\nInput \[\d+\]: \[(.*)\]", text)
    assert len(moved) >= 4 and all(re.fullmatch(r"((o|l|p)_\w+#\w+(, )?)+", columns) for columns in moved)
