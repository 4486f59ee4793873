import random

from pyspark.sql import functions as F

from grantflow.operators import caps, skew
from grantflow.operators.freshness import latest_per_key


def _skewed(spark, n=3000):
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.4 else (None if rng.random() < 0.1 else f"k{rng.randrange(50)}"))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "i int, k string").repartition(6)


def test_lookup_join_with_hot_keys_equals_plain_join(spark):
    rows, left = _skewed(spark)
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(40)], "k string, v int")
    hot = skew.hot_keys(left, "k", min_rows=100)
    assert [r.k for r in hot.collect()] == ["hot"]
    for how in ("left", "inner"):
        plain = left.join(right, "k", how).select("i", "k", "v")
        salted = skew.lookup_join(left, right, "k", how, hot, salts=4).select("i", "k", "v")
        assert sorted(plain.collect(), key=str) == sorted(salted.collect(), key=str)


def test_hot_rows_are_spread(spark):
    left = spark.range(0, 8000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("i"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = skew.hot_keys(left, "k", 1000)
        out = skew.lookup_join(left, right, "k", "left", hot, salts=8)
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 8000 and max(per_task) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_running_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(skew, "BLOCK_ROWS", 7)
    rng = random.Random(5)
    rows = [(i, None if rng.random() < 0.2 else ("hot" if rng.random() < 0.6 else "x"),
             rng.choice([None, None, f"v{i}"])) for i in range(900)]
    df = spark.createDataFrame(rows, "pos int, g string, v string").repartition(5)
    got = skew.running(df, ["g"], "pos", {
        "last": ("last", F.col("v")), "first": ("first", F.col("v")), "n": ("sum", F.lit(1)),
    })
    state, expected = {}, []
    for pos, g, v in rows:
        last, first, n = state.get(g, (None, None, 0))
        state[g] = (v or last, first or v, n + 1)
        expected.append((pos, g, v, *state[g]))
    assert sorted(map(tuple, got.collect())) == expected


def test_running_never_windows_a_whole_group(spark, monkeypatch):
    monkeypatch.setattr(skew, "BLOCK_ROWS", 10)
    df = spark.range(5000).select(F.col("id").alias("pos"), F.lit("g").alias("g"))
    out = skew.running(df, ["g"], "pos", {"n": ("sum", F.lit(1))})
    assert out.where("n <> pos + 1").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 3


def test_caps_equal_counting(spark):
    rng = random.Random(4)
    rows = [(rng.choice("fg"), rng.choice(["synopsis", "forecast", None]), i) for i in range(120)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, kind string, pos int")
    for _ in range(6):
        total, synopsis, forecast = (rng.choice([-1, 0, 3, 10, 200]) for _ in range(3))
        seen, kept = {}, set()
        for file, kind, pos in sorted(rows, key=lambda r: r[2]):
            cap = {"synopsis": synopsis, "forecast": forecast}.get(kind, -1)
            nth = seen[file, kind] = seen.get((file, kind), 0) + 1
            if 0 <= cap < nth:
                continue
            seen[file] = seen.get(file, 0) + 1
            if total < 0 or seen[file] <= total:
                kept.add(pos)
        out = caps.cap_records(df, total, {"synopsis": synopsis, "forecast": forecast}, "file", "kind", "pos")
        assert {r.pos for r in out.collect()} == kept and out.count() == len(kept)


def test_large_caps_never_window_a_whole_group(spark, monkeypatch):
    monkeypatch.setattr(skew, "BLOCK_ROWS", 100)
    df = spark.range(0, 6000, 1, 4).select(
        F.col("id").alias("pos"), F.lit("f").alias("file"), F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("kind"))
    # the cap of 1 500 is above Spark's threshold for row numbers, that of 3 isn't
    for total, even in ((2500, 1500), (3, 1500), (2500, 3)):
        for block in (None, F.floor(F.col("pos") / 70)):
            out = caps.cap_records(df, total, {"even": even}, "file", "kind", "pos", block)
            assert out.columns == df.columns
            wanted = [i for i in range(6000) if i % 2 or i < 2 * even][:total]
            assert sorted(r.pos for r in out.collect()) == wanted
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            assert ("row_number()" in plan) == (min(total, even) <= 1000)


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(0, 4000, 1, 4).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = latest_per_key(df, "k", F.desc("v"))
    assert sorted(r.v for r in out.collect()) == [3997, 3998, 3999]
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle
