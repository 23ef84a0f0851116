import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_rows():
    """The documents of the smallest driver tables as (doc_id, text, lang)."""
    import pyarrow.parquet as pq

    path = f"{SF}/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("driver test data not present")
    return [(r["doc_id"], r["text"], r["lang"]) for r in pq.read_table(path).to_pylist()]
