import os

import numpy as np

from corvid import jobs
from corvid.__main__ import main
from tests.test_sources import write_bmp


def test_weather_job(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "weather")
    os.makedirs(d)
    for year, temp in [(1985, 50), (1986, 36), (2016, 99)]:
        with open(os.path.join(d, f"{year}.csv"), "w") as f:
            f.write(f"1,,1,28,{temp}\n2,5,01,28,{temp + 10}\n2,5,1,27,0\n")
    stations = os.path.join(d, "stations.csv")
    with open(stations, "w") as f:
        f.write("1,,28.5,-80.6\n2,5,28.3,-80.5\n3,,,-80.5\n")
    out = jobs.weather(spark, os.path.join(d, "19*.csv"), stations).collect()
    assert [r.year for r in out] == [1985, 1986]
    assert all(r.n == 2 for r in out)
    assert out[1].est < out[0].est


def test_profile_job(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bank.csv")
    with open(p, "w") as f:
        f.write("age,job,balance\n30,admin,100.5\n40,,\n30,tech,-3\n")
    got = {r.col_name: r for r in jobs.column_profile(spark, p).collect()}
    assert got["age"].min == 30.0 and got["age"].n_distinct == 2
    assert got["job"].min is None and got["job"].non_empty == 2
    assert got["balance"].max == 100.5 and got["balance"].non_empty == 2


def test_feed_job(spark, tmpdir_path):
    fol = os.path.join(tmpdir_path, "followers.csv")
    tw = os.path.join(tmpdir_path, "tweets.csv")
    with open(fol, "w") as f:
        f.write(",user_id,follows_id\n0,1234,7\n1,1234,8\n2,9,1234\n")
    with open(tw, "w") as f:
        f.write(",user_id,tweet_text\n0,7,hello\n1,8,hello\n2,8,bye\n3,1234,mine\n")
    out = jobs.feed_read(spark, fol, tw, 1234, out_dir=os.path.join(tmpdir_path, "store"))
    push = [r.tweet_text for r in out["push"].collect()]
    pull = [r.tweet_text for r in out["pull"].collect()]
    assert sorted(push) == ["bye", "hello"] and sorted(pull) == ["bye", "hello"]
    assert pull[-1] == "hello"  # summed score of two authors sorts last
    assert [r.follower_id for r in out["followers"].collect()] == [9]
    assert spark.read.parquet(os.path.join(tmpdir_path, "store", "timelines")).count() == 3
    unions = spark.read.parquet(os.path.join(tmpdir_path, "store", "unions"))
    assert unions.count() == 3 and dict(unions.dtypes)["score"] == "decimal(38,0)"


def test_images_job_and_cli(spark, tmpdir_path, capsys):
    d = os.path.join(tmpdir_path, "1k")
    os.makedirs(d)
    rng = np.random.default_rng(5)
    left = np.zeros((10, 12, 3))
    left[:, :6] = 200.0
    for i in range(12):  # dogs bright on the left, cats bright on the right
        write_bmp(os.path.join(d, f"dog.{i}.bmp"), np.clip(left + rng.normal(30, 10, left.shape), 0, 255))
        write_bmp(os.path.join(d, f"cat.{i}.bmp"), np.clip(left[:, ::-1] + rng.normal(30, 10, left.shape), 0, 255))
    out = jobs.classify_images(spark, d, "sobel", "nb", size=8)
    acc = out["accuracy"].first()
    assert acc.n == out["predictions"].count() and acc.n > 0
    raw = jobs.classify_images(spark, d, "raw", "nb", size=8)["accuracy"].first()
    assert raw.accuracy == 1.0
    assert main(["images", d, "--size", "6"]) == 0
    assert "accuracy" in capsys.readouterr().out


def test_weather_job_on_year_partitioned_parquet(spark, tmpdir_path):
    from corvid.plans.explain import final_plan
    from corvid.plans.standins import weather_observations, weather_stations
    from corvid.sources.sinks import write_partitioned
    sf = "/root/testdata/sf0.001"
    obs = weather_observations(spark, sf)
    path = os.path.join(tmpdir_path, "readings")
    write_partitioned(obs, path, ["year"], ["station", "wban"])
    assert any(name.startswith("year=") for name in os.listdir(path))
    st_path = os.path.join(tmpdir_path, "stations.csv")
    weather_stations(spark, sf).coalesce(1).write.csv(st_path)
    got = jobs.weather(spark, path, st_path, first_year=1996, last_year=1998, readings_format="parquet")
    plan = final_plan(got)
    assert "PartitionFilters: [isnotnull(year" in plan and "1996" in plan
    want = jobs.geo.idw_for_day(weather_stations(spark, sf), obs.filter("year between 1996 and 1998"))
    r = lambda rows: sorted((x.year, round(x.est, 9), x.n) for x in rows)  # summation order differs
    assert r(got.collect()) == r(want.collect())


def test_featurizers_on_bytes_equal_decoded(spark, tmpdir_path):
    from corvid.operators import ml
    from corvid.sources.images import read_images
    d = os.path.join(tmpdir_path, "imgs")
    os.makedirs(d)
    rng = np.random.default_rng(9)
    for i in range(4):
        write_bmp(os.path.join(d, f"dog.{i}.bmp"), rng.integers(0, 256, (9, 13, 3)))
    decoded = read_images(spark, d)
    raw = read_images(spark, d, decode=False)
    colour = read_images(spark, d, gray=False)
    for name, cls in ml.FEATURIZERS.items():
        pixels = colour if name == "sobel" else decoded  # Sobel keeps the planes
        a = {r.path: r.features.toArray().tolist() for r in cls(size=6).transform(pixels).collect()}
        b = {r.path: r.features.toArray().tolist()
             for r in cls(inputCol="data", size=6).transform(raw).collect()}
        assert a == b, name


def test_cli_weather_profile_feed(spark, tmpdir_path, capsys):
    d = os.path.join(tmpdir_path, "w")
    os.makedirs(d)
    with open(os.path.join(d, "1986.csv"), "w") as f:
        f.write("1,,1,28,30\n")
    with open(os.path.join(d, "stations.csv"), "w") as f:
        f.write("1,,28.5,-80.6\n")
    assert main(["weather", "--readings", os.path.join(d, "1986.csv"),
                 "--stations", os.path.join(d, "stations.csv")]) == 0
    out = capsys.readouterr().out
    assert "1986" in out and "30.0" in out
    assert main(["weather", "--readings", d, "--stations", os.path.join(d, "stations.csv"),
                 "--out", os.path.join(d, "result")]) == 0
    assert [r.year for r in spark.read.parquet(os.path.join(d, "result")).collect()] == [1986]
    p = os.path.join(tmpdir_path, "t.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    assert main(["profile", p]) == 0
    assert "Statistics for" in capsys.readouterr().out
    assert main(["profile", "--approx", p]) == 0
    assert "Statistics for" in capsys.readouterr().out
    fol, tw = os.path.join(tmpdir_path, "f.csv"), os.path.join(tmpdir_path, "tw.csv")
    with open(fol, "w") as f:
        f.write(",user_id,follows_id\n0,1,2\n")
    with open(tw, "w") as f:
        f.write(",user_id,tweet_text\n0,2,hi\n")
    assert main(["feed", "--followers", fol, "--tweets", tw, "--user", "1"]) == 0
    assert "hi" in capsys.readouterr().out


def test_weather_job_drop_null_readings(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "wn")
    os.makedirs(d)
    with open(os.path.join(d, "1990.csv"), "w") as f:
        f.write("1,,1,28,40\n2,,1,28,\n")  # station 2 has no temperature
    stations = os.path.join(d, "stations.csv")
    with open(stations, "w") as f:
        f.write("1,,28.5,-80.6\n2,,28.45,-80.6\n")
    keep = jobs.weather(spark, os.path.join(d, "1990.csv"), stations).first()
    drop = jobs.weather(spark, os.path.join(d, "1990.csv"), stations, drop_null_readings=True).first()
    assert drop.est == 40.0 and drop.n == 1
    assert keep.n == 2 and keep.est < 40.0  # the null reading's weight stays in the denominator
