from stationlake.operators.lookup import enrich_station, poll_outcome_counts, silent_stations
from stationlake.sources.catalog import lookup_catalog, read_station_catalog

CSV = """Name,FMISID,lat,lon,start,finish
Alpha Öja,1,60.1,24.9,1950,
Beta,2,61.0,25.0,1960,2019
Gamma,3,62.0,26.0,1970,2020
Delta,4,63.0,27.0,1980,x
Alpha copy,1,60.2,24.8,1990,
Epsilon,5,64.0,28.0,1995,
"""


def test_catalog_rules(spark, workdir):
    path = f"{workdir}/stations.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write(CSV)
    cat = lookup_catalog(read_station_catalog(spark, path))
    got = {r["station_id"]: r["station_name"] for r in cat.collect()}
    assert got == {1: "Alpha Öja", 3: "Gamma", 5: "Epsilon"}   # inactive dropped, first row wins

    obs = spark.createDataFrame([(1, "2024-01-01 10:00:00", "x"), (2, "2024-01-01 10:00:00", "y"),
                                 (1, "2024-01-02 10:00:00", "z")], "station_id long, timestamp string, location string")
    obs = obs.selectExpr("station_id", "cast(timestamp as timestamp_ntz) as timestamp", "location")
    named = {(r["station_id"], r["location"]) for r in enrich_station(obs, cat).collect()}
    assert named == {(1, "Alpha Öja"), (2, None)}
    assert sorted(r["station_id"] for r in silent_stations(cat, obs).collect()) == [3, 5]
    counts = sorted(tuple(r) for r in poll_outcome_counts(cat, obs).collect())
    assert [c[1:] for c in counts] == [(3, 1, 2), (3, 1, 2)]
