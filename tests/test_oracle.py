"""Every registered query against its DuckDB oracle at sf0.001 (rows, columns,
order-free values), the same comparison the driver makes at sf0.01."""
import collections
import datetime
import decimal

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

ORACLE = E.oracle_sql()
OWN = [n for n in E.queries() if n in E.MODELS or n in E.GENERIC_QUERIES]
NAMES = [n for n in OWN if n in ORACLE and n != "dq_model_checks"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    missing = set(OWN) - set(ORACLE)
    assert not missing


def test_engine_types_are_the_contracts(spark):
    """The engine's own output types, before anything is cast for the comparison."""
    from kestrel.plans.contract import schema_of
    b = E.build(spark, SF_SMALL)
    own = {n: b.ref(n) for n in E.MODELS} | {n: g.spark(b) for n, g in E.GENERIC_QUERIES.items()}
    wrong = {n: sorted(set(schema_of(df)) ^ set(E.CONTRACTS[n])) for n, df in own.items()
             if schema_of(df) != E.CONTRACTS[n]}
    assert not wrong


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _bag(df.columns, rows) == _bag(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "business_count" in df.columns
