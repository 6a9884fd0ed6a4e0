from __future__ import annotations

import pathlib
import subprocess
import sys

import pytest

from tallyward.sources import scratch as S
from tallyward.sources.contracts import ContractError

SESSION = """
import sys
from pyspark.sql import SparkSession
from tallyward.sources.scratch import Scratch
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
for _ in range(2):
    assert Scratch.create(spark).keep(spark.range(3), "rows").count() == 3
spark.stop()
"""


def test_no_folder_is_left_when_the_session_ends(tmp_path):
    root = pathlib.Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", SESSION, str(tmp_path)], cwd=root, check=True, timeout=120)
    assert [p for p in tmp_path.rglob("*") if "tallyward" in p.name] == []


def test_finish_leaves_the_result_only(spark):
    scratch = S.Scratch.create(spark)
    kept = scratch.keep(spark.range(5), "one")
    result = scratch.finish(kept.filter("id > 2"))
    assert result.count() == 2
    path, files = scratch._path("")
    assert [e.getPath().getName() for e in files.listStatus(path)] == ["result"]
    scratch.remove()
    assert not files.exists(path)


def test_empty_frames_come_back_with_their_schema(spark):
    scratch = S.Scratch.create(spark)
    empty = spark.createDataFrame([], "a int, b array<string>, c struct<d: double>")
    assert scratch.keep(empty, "none").schema == empty.schema


def test_a_session_without_checkpoint_folder_is_an_error(spark, monkeypatch):
    class Nothing:
        class conf:
            @staticmethod
            def get(*_):
                return None

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ContractError, match="checkpoint"):
        S.checkpoint_folder(Nothing)
