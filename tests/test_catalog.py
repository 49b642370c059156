"""Driver contract: registry consistency (no Spark jobs)."""

import __spark_entry__ as E
from toksmith.plans import catalog


def test_every_oracle_has_a_query_and_names_are_clean():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70
    for name in q:
        assert name.isidentifier()
    assert not any(name.startswith("op") for name in catalog.QUERIES)  # that prefix is the optional subpackage's
    for sql in o.values():
        assert "LIMIT" not in sql or "ORDER BY" in sql  # limits only as top-k reports
