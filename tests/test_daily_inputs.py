"""A day's answers are fetched once and its joins do not pass players through the driver."""

import random
import uuid

from pyspark.sql import functions as F

from gamelake.plans import daily, q_cycle
from gamelake.session import scratch_path
from gamelake.sources import fixtures, raw, state_store

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def test_report_and_state_come_from_the_same_answers(spark):
    root = scratch_path(spark, "t-daily-inputs", uuid.uuid4().hex[:8])
    names = [f"p{i:02d}" for i in range(40)]
    day = spark.createDataFrame([("GM", "2024-03-05", names)], "title string, snapshot_date string, players array<string>")
    urls = spark.createDataFrame([(n, [f"https://g.example/player/{n}/games/2024/03"]) for n in names], "username string, archives array<string>")
    status = F.udf(lambda: random.choice([200, 500]), "int").asNondeterministic()  # another answer at each fetch
    seen = []

    def games(requests):
        seen.append(spark.conf.get(THRESHOLD))
        return requests.select("username", "month_key", status().alias("status_code"), F.lit("e").alias("etag"), F.lit(3).alias("game_count"))

    before = spark.conf.get(THRESHOLD)
    source = daily.Answers(lambda due: urls.join(due.select("username").distinct(), "username"), games,
                           spark.createDataFrame([], "username string, month_key string"))
    report = daily.run_day(spark, root, day, source, "2024-03-05", "2024-03-05 12:00:00").first()
    state = state_store.read(spark, root).players
    assert report.updated == state.filter("current_month_key = '2024-03'").count() and report.updated + report.error == 40
    assert set(seen) == {daily.BROADCAST} and spark.conf.get(THRESHOLD) == before
    assert not raw.exists(spark, f"{root}/state/reports/sync_responses/ds=2024-03-05")


def test_landed_inputs_hold_the_rows_of_the_views(spark, tmp_path):
    sf = str(tmp_path)
    spark.sql("select id as c_custkey, concat('Customer#', id) as c_name, id % 3 as c_nationkey from range(1, 60)").write.parquet(f"{sf}/customer.parquet")
    spark.sql("select id as o_orderkey, id % 40 as o_custkey, timestamp'1996-01-03' + make_interval(0, id % 7) as o_orderdate, 'F' as o_orderstatus "
              "from range(300)").write.parquet(f"{sf}/orders.parquet")
    files = q_cycle.landed(spark, sf, f"{sf}/root")
    flat = {"rosters": files["rosters"].select("day", "title", F.explode("players").alias("username")),
            "lists": files["lists"].select("day", "username", F.explode("archives").alias("archive_url")),
            "answers": files["answers"], "raw_months": files["raw_months"]}
    for name, view in (("rosters", "roster"), ("lists", "lists"), ("answers", "answers"), ("raw_months", "raw")):
        want = fixtures.view(spark, sf, f"fx_cycle_{view}")
        if name == "lists":  # a player without orders has an empty list
            want = want.filter("archive_url is not null")
        assert sorted(map(repr, map(tuple, flat[name].select(*want.columns).collect()))) == sorted(map(repr, map(tuple, want.collect())))
        assert f"{sf}/root/landed/{name}" in files[name].inputFiles()[0]
    assert files["lists"].filter("size(archives) = 0").count() > 0
