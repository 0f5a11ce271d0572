from __future__ import annotations

import pytest

from tests.check_oracle import compare, oracle
from tests.conftest import SF
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, oracle(SF), SF, name) is None


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in ORACLE and q not in ("op3_string_tiling",)])
def test_query_gives_a_row_for_each_row(spark, name):
    given = spark.read.parquet(f"{SF}/{'pages' if name == 'op4_warc' else 'documents'}.parquet").count()
    found = QUERIES[name](spark, SF)
    # A long document is several pieces, of which each has one first piece.
    assert (found.filter("piece = 0") if name == "op12_best_fit" else found).count() == given
