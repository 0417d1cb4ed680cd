from datetime import datetime

import pytest

from nightloom.operators.cache import ResultCache, minute


def persisted(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_hits_expiry_and_eviction(spark):
    now, made, before = [0.0], [], persisted(spark)

    def make(key):
        def run():
            made.append(key)
            return spark.range(len(made) * 10)

        return run

    with ResultCache(seconds=300, entries=2, clock=lambda: now[0]) as cache:
        assert cache.get("a", make("a")).count() == cache.get("a", make("a")).count() == 10
        assert (made, cache.hits, cache.misses) == (["a"], 1, 1) and persisted(spark) == before + 1
        now[0] = 299
        cache.get("a", make("a"))
        now[0] = 300  # expiry counts from the making
        assert cache.get("a", make("a")).count() == 20 and persisted(spark) == before + 1
        cache.get("b", make("b")).count()
        cache.get("a", make("a"))
        cache.get("c", make("c")).count()  # b was used longest ago
        assert list(cache.held) == ["a", "c"] and persisted(spark) == before + 2
        cache.get("b", make("b")).count()
        assert made == ["a", "a", "b", "c", "b"]
        with pytest.raises(ZeroDivisionError):
            cache.get("bad", lambda: 1 / 0)
        assert "bad" not in cache.held
    assert not cache.held and persisted(spark) == before


def test_times_within_a_minute_share_a_result(spark):
    with ResultCache() as cache:
        for second in (0, 59):
            cache.at(datetime(2024, 1, 1, 5, 0, second), "bias", make=lambda: spark.range(1))
        cache.at(datetime(2024, 1, 1, 5, 1, 0), "bias", make=lambda: spark.range(1))
        cache.at(datetime(2024, 1, 1, 5, 0, 0), "dark", make=lambda: spark.range(1))
        assert (cache.hits, cache.misses) == (1, 3)
    assert minute(datetime(2024, 12, 31, 23, 59, 30), 5) == datetime(2024, 12, 31, 23, 55)
