"""Helpers: slices by bytes, clashing names, and who may import the package."""

import pathlib
import re

import pyarrow as pa
from pyspark.sql import functions as F

import candlemill
from candlemill.llm import common


def test_slices_are_balanced_by_bytes_and_lose_nothing():
    texts = ["a" * 5, None, "", "b" * 50, "é" * 3, "c", "d" * 9, ""]
    for most in (1, 6, 10, 1000):
        slices = [x.to_pylist() for x in common.loads(iter([pa.array(texts), pa.array([], pa.string())]), most)]
        assert [x for part in slices for x in part] == texts
        assert all(sum(len((x or "").encode()) for x in part) <= most or len([x for x in part if x]) == 1 for part in slices)


def test_added_columns_replace_clashing_ones_in_any_case(spark):
    df = common.with_columns(spark.range(1).withColumn("N", F.lit("old")).withColumn("a.b", F.lit(1)), {"n": F.lit(2)})
    assert df.columns == ["id", "a.b", "n"] and df.first()["n"] == 2


def test_nothing_else_imports_the_package():
    root = pathlib.Path(candlemill.__file__).parent
    others = [path for path in root.rglob("*.py") if "llm" not in path.relative_to(root).parts]
    assert others and not [path for path in others if re.search(r"candlemill\.llm|from \.+llm", path.read_text())]
