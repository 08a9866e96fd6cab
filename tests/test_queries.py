"""Every registered query against its SQL, at the smallest scale.

The cross-validation fits 81 models; CHECK_ALL=1 runs it here as well.
"""

import os

import pytest

from checks import load_all
from checks.registry import ORACLES, QUERIES
from checks.run import connect, differences

SF_DIR = "/root/testdata/sf0.001"
SLOW = {"als_cv"}
#: At the smallest scale no two parts are bought together often enough.
LARGER = {"item_cosine_sparse": "/root/testdata/sf0.01", "item_cosine_sparse_blocks": "/root/testdata/sf0.01"}

load_all()
NAMES = [n for n in QUERIES if os.environ.get("CHECK_ALL") or n not in SLOW]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def connections():
    return {sf: connect(sf) for sf in {SF_DIR, *LARGER.values()}}


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, connections, name):
    sf_dir = LARGER.get(name, SF_DIR)
    assert differences(spark, connections[sf_dir], name, sf_dir) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.items() <= entry.oracle_sql().items()


def _rows(df):
    return sorted(tuple(round(v, 7) if isinstance(v, float) else v for v in row) for row in df.collect())


def test_results_do_not_depend_on_the_holder_limit(spark):
    """Small limits send nearly everything through blocks and groups."""
    from checks import inputs as I
    from checks.table_queries import preferred, quality
    from clipsense.ml.similarity import item_cosine
    from clipsense.operators import recommend

    ix, q = I.interactions(spark, SF_DIR), quality(spark, SF_DIR)
    for build in (
        lambda **limit: recommend.by_likes(ix, q, **limit),
        lambda **limit: recommend.by_watch(ix, q, **limit),
        lambda **limit: item_cosine(ix, **limit),
        lambda **limit: recommend.by_content(preferred(spark, SF_DIR), I.visits(spark, SF_DIR), I.catalog(spark, SF_DIR), **limit),
    ):
        usual = _rows(build())
        assert usual and _rows(build(limit=4)) == usual
