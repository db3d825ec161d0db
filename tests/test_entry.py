"""The driver's contract holds with and without the optional operators."""

import builtins

import __spark_entry__
import pytest


def test_every_statement_belongs_to_a_query():
    queries, statements = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(statements) <= set(queries) and "fct_customer_360" in statements


@pytest.mark.parametrize("missing", ["ledgerloom.llm.queries", "tiktoken", "corpus_pipeline"])
def test_missing_modules_leave_the_bank(monkeypatch, missing):
    import sys

    for name in [n for n in sys.modules if n.startswith("ledgerloom.llm") or n in (missing, "corpus_pipeline")]:
        monkeypatch.delitem(sys.modules, name)
    real = builtins.__import__

    def refuse(name, *args, **kwargs):
        if name == missing:
            raise ImportError(name)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", refuse)
    queries = __spark_entry__.queries()
    assert "fct_customer_360" in queries and "pipeline" not in queries
