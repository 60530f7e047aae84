"""Typed new columns: a field that appears later, changes its type, or clashes with a column."""

import datetime as dt
import json

from stationlake.sources import fields, versions
from stationlake.sources.tables import compact_days, read_raw
from stationlake.streaming import landing


def land(spark, root, batch, extras, day="2024-01-01"):
    base = {"fmisid": 5, "ingestion_time": f"{day}T11:00:00", "temperature": 1.0}
    rows = [("5", json.dumps(base | {"timestamp": f"{day}T10:{batch:02}:{i:02}"} | e)) for i, e in enumerate(extras)]
    landing.land_batch(spark.createDataFrame(rows, "key string, value string"), batch, f"{root}/raw", f"{root}/q")


def test_new_fields_become_typed_columns_beside_older_rows(spark, workdir):
    raw = f"{workdir}/raw"
    land(spark, workdir, 0, [{}, {}])
    assert fields.promote_fields(spark, raw) == {}
    assert fields.read_typed(spark, raw).columns == read_raw(spark, raw).columns
    land(spark, workdir, 1, [{"snow": 3, "ok": True, "note": "5"}, {"snow": 2.5, "nothing": None, "at": {"x": 1}}])
    kinds = {"snow": "DOUBLE", "ok": "BOOLEAN", "note": "STRING", "at": "VARIANT"}
    assert fields.promote_fields(spark, raw) == kinds
    got = fields.read_typed(spark, raw).orderBy("timestamp")
    assert dict(got.dtypes)["snow"] == "double" and dict(got.dtypes)["ok"] == "boolean"
    assert [r.snow for r in got.collect()] == [None, None, 3.0, 2.5]
    assert [r.note for r in got.collect()] == [None, None, "5", None]
    assert got.selectExpr("sum(snow) AS s").first().s == 5.5
    assert got.selectExpr("try_variant_get(at, '$.x', 'int') AS x").where("x IS NOT NULL").collect()[0].x == 1
    # nothing new: no further version
    number = versions.current(spark, raw).number
    assert fields.promote_fields(spark, raw) == kinds and versions.current(spark, raw).number == number


def test_types_widen_and_survive_compaction(spark, workdir):
    raw = f"{workdir}/raw"
    land(spark, workdir, 0, [{"depth": 1, "code": 7}])
    assert fields.promote_fields(spark, raw) == {"depth": "BIGINT", "code": "BIGINT"}
    land(spark, workdir, 1, [{"depth": 1.5, "code": "A7", "temperature_2": 9, "Depth": 4, "station_id": "clash"}])
    assert fields.promote_fields(spark, raw, min_rows=1)["code"] == "STRING"
    compact_days(spark, raw, ["2024-01-01"], today=dt.date(2024, 2, 1))
    out = fields.read_typed(spark, raw)
    rows = out.orderBy("timestamp").collect()
    names = fields.column_names(versions.current(spark, raw).fields, read_raw(spark, raw).columns)
    assert names == {"Depth": "Depth", "code": "code", "depth": "depth_2", "station_id": "station_id_2", "temperature_2": "temperature_2"}
    assert [r.depth_2 for r in rows] == [1.0, 1.5] and [r.code for r in rows] == ["7", "A7"]
    assert [r.station_id_2 for r in rows] == [None, "clash"] and [r.station_id for r in rows] == [5, 5]
    assert fields.read_typed(spark, raw, ["2024-01-01"]).count() == 2


def test_widening_rule():
    assert fields.widen("BIGINT", "DOUBLE") == "DOUBLE" and fields.widen("VOID", "BOOLEAN") == "BOOLEAN"
    assert fields.widen("BOOLEAN", "BIGINT") == "STRING" and fields.widen("STRING", "VARIANT") == "VARIANT"
    assert [fields.column_type(t) for t in ("DECIMAL(21,1)", "OBJECT<d: BIGINT>", "ARRAY<BIGINT>", "INT", "VOID")] == [
        "DOUBLE", "VARIANT", "VARIANT", "BIGINT", "VOID"]
