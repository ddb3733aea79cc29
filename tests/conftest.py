import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import samples  # noqa: E402
from samples import (AD_CLICK_LOG, DATA_TXT, LOGIN_LOG, ORDER_LOG, OUTPUT2, RECEIPT_LOG,  # noqa: E402, F401
                     SENSOR_TXT)

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import DEFAULT_CONF

    b = SparkSession.builder.master("local[4]").appName("tidemark-tests").config(
        "spark.sql.shuffle.partitions", "4")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s


_FOLDER: list[str] = []


def ref_file(name: str) -> str:
    """Path of one of the sample files, written on first use."""
    if not _FOLDER:
        _FOLDER.append(tempfile.mkdtemp(prefix="tidemark-samples-"))
        samples.write(_FOLDER[0])
    return os.path.join(_FOLDER[0], name)


def read_sample(spark, rel, schema):
    """A sample CSV as typed rows plus ``seq`` = line number (arrival order)."""
    import pandas as pd

    from tidemark.sources.files import parse_delimited

    with open(ref_file(rel), encoding="utf-8") as f:
        lines = [ln.rstrip("\n") for ln in f if ln.strip()]
    raw = spark.createDataFrame(pd.DataFrame({"value": lines, "seq": list(range(len(lines)))}))
    return parse_delimited(raw, schema, keep=("seq",))
