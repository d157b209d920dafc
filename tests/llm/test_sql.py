"""The queries against their SQL."""

import pytest
from comparison import FORBIDDEN, connect, differences

from moonstride.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(llm, name):
    # what is asked for as DataFrame functions alone holds no Python either
    forbidden = FORBIDDEN if name in ("op4_quality_ledger", "op5_line_runs") else FORBIDDEN[:2]
    assert differences(llm, connect(FOLDER), name, QUERIES[name], SQL[name], FOLDER, forbidden) is None
