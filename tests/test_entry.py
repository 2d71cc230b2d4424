import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from statloom import queries

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
ROOT = Path(__file__).resolve().parent.parent


def rows(frame):
    plain = frame[sorted(frame.columns)].astype(object)
    plain = plain.where(plain.notna(), None)
    return [tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in plain.itertuples(index=False)]


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in [*TABLES, "documents"]:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = queries.QUERIES[name](spark, str(DATA)).toPandas()
    wanted = db.execute(queries.ORACLES[name]).fetchdf()
    assert sorted(found.columns) == sorted(wanted.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(rows(found), key=key) == sorted(rows(wanted), key=key)


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_flagship(spark):
    assert entry.entry(spark).count() == 6000


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_corpus_operators(tmp_path):
    """The library and its queries stand alone."""
    copy = tmp_path / "repo"
    copy.mkdir()
    (copy / "__spark_entry__.py").write_bytes((ROOT / "__spark_entry__.py").read_bytes())
    for p in (ROOT / "statloom").rglob("*.py"):
        at = copy / p.relative_to(ROOT)
        if "llm" not in at.parts:
            at.parent.mkdir(parents=True, exist_ok=True)
            at.write_bytes(p.read_bytes())
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and 'narrow_with_missing' in q; e.oracle_sql()"], cwd=copy, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
