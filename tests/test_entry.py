"""The entry points, with and without the optional subpackage."""

import sys

import __spark_entry__
from leafmill.plans import catalog


def test_queries_and_oracles_agree():
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(catalog.QUERIES) <= set(queries) and set(oracles) <= set(queries)


def test_entry_without_the_subpackage(monkeypatch):
    import importlib

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    alone = importlib.reload(__spark_entry__)
    assert set(alone.queries()) == set(catalog.QUERIES) and set(alone.oracle_sql()) == set(catalog.ORACLES)
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
