import pytest

from quillstone.plans.catalog import FLAGSHIP, ORACLE_SQL, QUERIES
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, tmp_path, name):
    compare(QUERIES[name](spark, sf), connect(sf, tmp_path), ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert FLAGSHIP in QUERIES and entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_without_the_optional_part():
    """Nothing outside quillstone.llm, corpus_pipeline.py and the entry's guard names them."""
    import re
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for p in [*root.glob("quillstone/**/*.py"), root / "bench.py"]:
        if "llm" not in p.parts:
            assert not re.search(r"quillstone\.llm|corpus_pipeline", p.read_text(encoding="utf-8")) or p.name == "bench.py"
