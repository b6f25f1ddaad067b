import pytest

from ledgerflow.plans import catalog

from .compare import canonical, duck


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_oracle(spark, data, con, name):
    got = catalog.QUERIES[name](spark, data).toPandas()
    if name not in catalog.ORACLE:
        assert len(got)
        return
    want = con.execute(catalog.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_rows_of_delivered_files_are_counted(spark, data):
    """Each file's rows are numbered 1, 2, 3... in the order of their events, a repeat in the next day's file, too."""
    rows = catalog.QUERIES["stg_transactions_typed"](spark, data).select("_source_file", "_source_row", "txn_id").collect()
    files = {}
    for r in rows:
        files.setdefault(r["_source_file"], []).append((r["_source_row"], int(r["txn_id"][1:]), r["txn_id"]))
    assert len(files) > 20
    for held in files.values():
        assert [n for n, *_ in sorted(held)] == list(range(1, len(held) + 1))
        assert [x[1:] for x in sorted(held)] == sorted(x[1:] for x in held)


@pytest.mark.parametrize("name", ["txn_validated", "txn_quarantine", "fct_transactions", "dq_not_null"])
def test_row_numbers_are_those_of_the_files(spark, data, name):
    key = ("txn_id", "_source_file", "_source_row")
    got = {tuple(r) for r in catalog.QUERIES[name](spark, data).select(*key).collect()}
    assert got and got <= {tuple(r) for r in catalog.QUERIES["stg_transactions_typed"](spark, data).select(*key).collect()}


def test_every_query_but_the_approximate_one_has_an_oracle():
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == {"active_accounts_approx"}


def test_approximate_actives_are_close(spark, data):
    exact = {r["month_start"]: r["active"] for r in catalog.QUERIES["active_accounts_exact"](spark, data).collect()}
    for r in catalog.QUERIES["active_accounts_approx"](spark, data).collect():
        assert abs(r["active"] - exact[r["month_start"]]) <= max(1, 0.1 * exact[r["month_start"]])


def test_entry_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "alert_id"
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
