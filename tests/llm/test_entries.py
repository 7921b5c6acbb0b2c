"""The registered queries beside their SQL at the smallest scale factor."""

from pathlib import Path

import pytest
from oracle import compare

from wayframe.llm import entries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="the test tables aren't here")
@pytest.mark.parametrize("name", sorted(entries.ORACLE_SQL))
def test_query(spark, name):
    assert compare(spark, name, entries.QUERIES[name], entries.ORACLE_SQL[name], SF) == ""
