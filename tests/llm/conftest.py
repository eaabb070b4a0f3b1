import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(autouse=True)
def ready(spark, tmp_path_factory):
    from tidewell.llm.queries import prepare

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.getbasetemp() / "checkpoints"))
    return prepare(spark)
