"""The driver contract."""

import __spark_entry__ as E


def test_contract(spark):
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["req_id", "pick", "pro_ids", "label", "value"]
    per_req = {}
    for r in rows:
        per_req.setdefault(r.req_id, []).append(r.pick)
    assert all(sorted(p) == list(range(1, len(p) + 1)) and len(p) <= 10 for p in per_req.values())
