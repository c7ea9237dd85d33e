"""The registry without its optional parts, and the package on workers."""

from __future__ import annotations

import builtins
import importlib
import sys
import zipfile

import pytest

from rategauge.plans.shipping import shipped


@pytest.mark.parametrize("missing", ["corpus_pipeline", "rategauge.llm", "numpy", "pyarrow"])
def test_core_queries_without_the_text_operators(monkeypatch, missing):
    known, load = set(sys.modules), builtins.__import__

    def without(name, *args, **kwargs):
        if name == missing or name.startswith(missing + "."):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return load(name, *args, **kwargs)

    for name in list(known):
        if name.startswith(("rategauge.llm", "corpus_pipeline", "__spark_entry__")):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", without)
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries().keys()
    assert "report_avg_all" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
    assert entry.oracle_sql().keys() == names
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_package_is_shipped_once(spark, monkeypatch):
    added = []
    monkeypatch.setattr(spark.sparkContext, "addPyFile", added.append)
    monkeypatch.setattr("rategauge.plans.shipping._shipped", set())
    shipped(shipped(spark))
    assert len(added) == 1
    names = zipfile.ZipFile(added[0].removeprefix("file:")).namelist()
    assert "rategauge/plans/shipping.py" in names and "rategauge/__init__.py" in names
