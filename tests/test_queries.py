"""Every query over the small tables against its SQL in DuckDB."""

import pytest
from comparing import SMALL, rows_of

from hostgrain.queries.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SMALL).toPandas()
    if name in ORACLES:
        names, rows = rows_of(found)
        wanted_names, wanted = rows_of(duck.sql(ORACLES[name]).df())
        assert names == wanted_names
        assert rows == wanted
    else:
        assert len(found)


def test_the_contract_needs_no_subpackage(monkeypatch):
    """The driver's functions work where the training-data subpackage is absent."""
    import importlib
    import sys

    import __spark_entry__ as entry

    with monkeypatch.context() as m:
        for gone in ("hostgrain.llm", "hostgrain.llm.registry", "corpus_pipeline"):
            m.setitem(sys.modules, gone, None)
        m.setattr(sys.modules["hostgrain"], "llm", None, raising=False)
        alone = importlib.reload(entry)
        assert set(alone.queries()) == set(QUERIES) and set(alone.oracle_sql()) == set(ORACLES)
    importlib.reload(entry)


def test_entry_has_the_contract_columns(spark):
    import __spark_entry__
    from hostgrain.operators.contract import COLUMNS

    assert tuple(__spark_entry__.entry(spark).columns) == COLUMNS


def test_reprocess_selects_its_days_of_a_full_landing(monkeypatch):
    from hostgrain.queries import registry

    landed = []
    monkeypatch.setattr(registry, "_lake", lambda spark, d, first, last: landed.append((first, last)) or (None, None))
    monkeypatch.setattr(registry.jobs, "reprocess_window", lambda *_: None)
    registry._reprocess(None, None)
    assert landed == [(0, 29)]
