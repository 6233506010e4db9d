"""The registry: every SQL belongs to a query, every query to a callable, and the package can be sent to workers."""

import zipfile

import __spark_entry__ as entry
from talkweave import runtime


def test_every_check_has_its_query():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and all(callable(q) for q in queries.values()) and len(queries) >= 45


def test_no_query_reads_less_than_its_tables():
    for text in entry.oracle_sql().values():
        assert " limit " not in text.lower() and "using sample" not in text.lower()


def test_ship_sends_all_modules_once(monkeypatch, tmp_path):
    sent = []

    class Context:
        applicationId = "app-1"

        def addPyFile(self, path):
            sent.append(path)

    class Session:
        sparkContext = Context()

    monkeypatch.chdir(tmp_path)
    monkeypatch.setenv("PYTHONPATH", "")
    runtime.ship(Session())
    runtime.ship(Session())
    assert len(sent) == 1 and "talkweave/operators/blocks.py" in zipfile.ZipFile(sent[0]).namelist()
