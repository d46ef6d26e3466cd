import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import check_oracle

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")

OWN_SQL = {name: text for family in entry.OWN_FAMILIES for name, text in family.ORACLE.items()}


@pytest.fixture(scope="module")
def connection():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {name for family in entry.OWN_FAMILIES for name in family.QUERIES}
    assert own == set(OWN_SQL)


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", sorted(OWN_SQL))
def test_against_sql(spark, connection, name):
    good, note = check_oracle.compare(spark, connection, str(DATA), name, OWN_SQL)
    assert good, note


def test_no_shortcuts_in_the_code():
    root = Path(entry.__file__).parent
    for path in [*root.glob("jobgrain/*.py"), *root.glob("jobgrain/[!l]*/*.py"), *root.glob("bindings/*.py")]:
        text = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|\.toPandas\(|F\.udf|sample\(", text), path
