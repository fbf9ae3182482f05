"""Driver contract smoke test and a few oracle keys at sf0.001."""

import collections

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

KEYS = sorted(E.oracle_sql())  # every key with an oracle, at sf0.001
ROWS_ONLY = sorted(set(E.queries()) - set(E.oracle_sql()))


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns and "_silver_version" in df.columns


def test_every_oracle_key_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_keys_run(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    assert df.count() >= 0 and df.columns


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_oracle_matches(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    s = collections.Counter(tuple(r[c] for c in order) for r in df.collect())
    idx = [dcols.index(c) for c in order]
    d = collections.Counter(tuple(r[i] for i in idx) for r in cur.fetchall())
    assert s == d, key


@pytest.mark.parametrize("key", ["append_twice", "overwrite_twice", "schema_evolve"])
def test_writing_keys_are_stable_across_calls(spark, key):
    first = sorted(E.queries()[key](spark, SF_SMALL).collect())
    second = sorted(E.queries()[key](spark, SF_SMALL).collect())
    assert first == second


def test_only_a_removed_part_is_passed_over(monkeypatch):
    """A missing dependency is an error; queries may be missing only with the package that holds them."""
    def without(name):
        def load(_):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return load

    with monkeypatch.context() as m:
        m.setattr(E.importlib, "import_module", without("zstandard"))
        with pytest.raises(ModuleNotFoundError, match="zstandard"):
            E.queries()
    for part in ("strata.llm", "corpus_pipeline"):
        with monkeypatch.context() as m:
            m.setattr(E.importlib, "import_module", without(part))
            assert set(E.queries()) == set(E.QUERIES) and set(E.oracle_sql()) <= set(E.QUERIES)
