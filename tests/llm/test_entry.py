import sys

import pytest

import __spark_entry__


def test_import_error_of_llm_queries_surfaces(monkeypatch):
    import furrow.llm

    monkeypatch.delattr(furrow.llm, "queries", raising=False)
    monkeypatch.setitem(sys.modules, "furrow.llm.queries", None)
    with pytest.raises(ImportError):
        __spark_entry__.queries()


def test_every_problem_has_its_queries_and_sql():
    q, s = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert all(f"p{n}_found" in q and f"p{n}_found" in s for n in range(1, 9)) and set(s) <= set(q)
