import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tonality.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMOKE


@pytest.fixture()
def vocab(spark):
    """Stage a (word, vector) table from rows; returns the measured VectorTable."""
    from tonality.session import fresh_path
    from tonality.sources.vectors import stage_vectors

    def make(rows):
        df = spark.createDataFrame([(w, i, [float(x) for x in v]) for i, (w, v) in enumerate(rows)],
                                   "word string, vec_id bigint, vector array<float>")
        return stage_vectors(spark, df, fresh_path(spark, "test-vocab"))
    return make
