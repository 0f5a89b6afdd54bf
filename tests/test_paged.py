import json

import pytest

from tidemark.operators.silver import typed_energy
from tidemark.sources import feeds
from tidemark.sources.paged import register_paged


def stub(total, spoil=None, bad_status=None):
    """A transport of total records; the page at offset spoil breaks the contract, the one at bad_status fails."""

    def get(url, params, headers, timeout):
        at, n = params.get("offset", 0), params.get("limit", total)
        if at == bad_status and n > 1:
            return 503, {}
        records = [{"_id": i, "Timestamp": f"2024-01-0{1 + i % 9}T00:{i % 60:02d}:00", "Demand": i * 0.5, "Wind": None, "Odd": [i]} for i in range(at, min(at + n, total))]
        if at == spoil and n > 1:
            records[0].pop("_id")
        assert url == "http://e/search" and headers == {"Authorization": "two"} and params["resource_id"] == "res"
        return 200, {"help": "h", "success": True, "result": {"resource_id": "res", "records": records, "limit": n, "total": total}}

    return get


def load(spark, get, size=1000):
    register_paged(spark, get, {"E": "two"})
    options = {"url": "http://e/search", "params": json.dumps({"resource_id": "res"}), "page_size": str(size), "key_header": "Authorization", "key_env": "E"}
    return spark.read.format("paged_feed").options(**options).load()


def test_pages_equal_the_whole_fetch(spark):
    get = stub(2500)
    df = load(spark, get)
    assert df.rdd.getNumPartitions() == 3
    whole = feeds.fetch(feeds.Feed("energy", "http://e/search", {"resource_id": "res"}, key_header="Authorization", key_env="E"), get, {"E": "two"})
    want = [(r["_id"], r["Timestamp"], r["Demand"], r["Wind"]) for r in whole["result"]["records"]]
    rows = df.collect()
    assert sorted((r.record._id, r.record.Timestamp, r.record.Demand, r.record.Wind) for r in rows) == want and len(want) == 2500
    assert {r.page_offset for r in rows} == {0, 1000, 2000} and {r.resource_id for r in rows} == {"res"}


def test_records_become_typed_rows(spark):
    df = load(spark, stub(25), 10)
    raw = df.groupBy("page_offset", "resource_id").agg({"record": "collect_list"}).selectExpr("concat('energy_20240201_00000', page_offset % 7, '.json') AS source_file", "struct(resource_id, `collect_list(record)` AS records) AS result", "CAST(NULL AS STRING) AS _corrupt")
    assert typed_energy(raw).count() == 25


@pytest.mark.parametrize("get,word", [(stub(30, spoil=10), "_id"), (stub(30, bad_status=20), "503")])
def test_a_page_that_fails_fails_the_read(spark, get, word):
    with pytest.raises(Exception, match=word):
        load(spark, get, 10).collect()


def test_an_empty_feed_and_odd_sizes(spark):
    assert load(spark, stub(0)).count() == 0
    assert load(spark, stub(7), 7).count() == 7 and load(spark, stub(8), 7).rdd.getNumPartitions() == 2
    with pytest.raises(Exception, match="page_size"):
        load(spark, stub(1), 0).count()
