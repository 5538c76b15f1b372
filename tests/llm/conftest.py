import pytest

from airlattice.llm.common import ship_package

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.fixture
def shipped(spark):
    return ship_package(spark)


@pytest.fixture
def frame(shipped):
    """Documents from (id, text) pairs; sources alternate, further columns have clashing names."""
    def make(pairs, extra=()):
        rows = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t), *[1] * len(extra)) for i, t in pairs]
        return shipped.createDataFrame(rows, DOCS + "".join(f", {c} INT" for c in extra)).repartition(3)
    return make
