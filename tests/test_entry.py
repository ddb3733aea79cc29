"""Driver contract: entry(), queries(), oracle_sql()."""

import re

import __spark_entry__ as E


def test_entry_runs_on_sf0001(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "item_id", "count", "rank"]
    assert df.count() > 0


def test_every_query_has_an_id_prefix_and_an_oracle():
    qs, os_ = E.queries(), E.oracle_sql()
    assert set(os_) <= set(qs)
    own = [n for n in qs if not re.match(r"op\d+_|pipeline$", n)]
    for name in own:
        assert re.match(r"^[SKPRAJWDTCFU]\d+[a-z]?_", name), name
    assert set(own) <= set(os_)
