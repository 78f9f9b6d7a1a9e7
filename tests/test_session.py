from tidemerge.session import sized_for


def test_sized_for():
    assert sized_for(1)["spark.sql.shuffle.partitions"] == "200"
    assert int(sized_for(100_000)["spark.sql.shuffle.partitions"]) == 512_000
