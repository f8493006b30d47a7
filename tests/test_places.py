"""Boxes over tables clustered by place."""

from __future__ import annotations

import glob
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from roadpulse.operators import clustered_by_place, coordinates, key_ranges, place_key, within_bbox, within_bbox_clustered
from roadpulse.operators.spatial import KEY_BITS, WORLD
from roadpulse.session import settings


def key_of(lon, lat, extent=WORLD):
    size, cells = 1 << KEY_BITS, []
    for value, least, greatest in ((lon, extent[0], extent[2]), (lat, extent[1], extent[3])):
        cells.append(max(0, min(size - 1, int((value - least) / (greatest - least) * size // 1))))
    return sum(((cells[0] >> bit & 1) | (cells[1] >> bit & 1) << 1) << 2 * bit for bit in range(KEY_BITS))


def places(spark, number=4000):
    random.seed(4)
    rows = [(i, random.uniform(-200, 200), random.uniform(-95, 95)) for i in range(number)]
    rows += [(-1, None, 1.0), (-2, 1.0, None), (-3, float("nan"), 0.0), (-4, float("inf"), -1e9), (-5, -180.0, 90.0)]
    return rows, spark.createDataFrame(rows, "id long, lon double, lat double")


def test_keys_deal_the_bits_of_both_coordinates(spark):
    rows, table = places(spark, 300)
    found = {x.id: x.key for x in table.select("id", place_key("lon", "lat").alias("key")).collect()}
    assert all(found[i] == key_of(lon, lat) for i, lon, lat in rows if i >= 0 or i == -5)
    assert found[-1] is found[-2] is found[-3] is None


def test_ranges_hold_all_places_of_a_box():
    random.seed(5)
    for _ in range(60):
        lon, lat = random.uniform(-190, 190), random.uniform(-95, 95)
        box = (lon, lat, lon + random.choice([0, 0.001, 1, 30]), lat + random.choice([0, 0.002, 5, 50]))
        ranges = key_ranges(box)
        assert 1 <= len(ranges) <= 64 and ranges == sorted(ranges)
        for _ in range(50):
            key = key_of(random.uniform(box[0], box[2]), random.uniform(box[1], box[3]))
            assert any(first <= key <= last for first, last in ranges)
    whole = key_ranges(WORLD)
    assert whole == [(0, (1 << 2 * KEY_BITS) - 1)]
    small = key_ranges((-122.52, 37.70, -122.35, 37.83))
    assert sum(last - first + 1 for first, last in small) < 4000


def test_box_over_a_clustered_table_skips_row_groups(spark, tmp_path, plan):
    rows, table = places(spark, 40_000)
    days = table.withColumn("event_date", F.expr("date '2024-01-01' + cast(if(id % 20 = 0, id % 7, 0) as int)"))
    path = str(tmp_path / "places")
    written = clustered_by_place(days).repartition(1).sortWithinPartitions("event_date", "place_key")
    written.write.option("parquet.block.size", 32768).parquet(path)
    clustered = spark.read.parquet(path)
    for box in ((-10, -10, 10, 10), (-122.5, 37, -120, 39), (-180, -90, 180, 90), (170, 80, 500, 500)):
        want = sorted(x.id for x in within_bbox(table, box, columns=("lon", "lat")).select("id").collect())
        inside = within_bbox_clustered(clustered, box)
        assert sorted(x.id for x in inside.select("id").collect()) == want
    with settings(spark, {"spark.sql.maxMetadataStringLength": "100000"}):
        text = plan(within_bbox_clustered(spark.read.parquet(path), (-10, -10, 10, 10)))
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(place_key" in text
    # Of the row groups only some can hold keys of the box.
    (file,) = glob.glob(f"{path}/*.parquet")
    meta = pq.ParquetFile(file).metadata
    column = next(i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == "place_key")
    stats = [meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups)]
    ranges = key_ranges((-122.5, 37, -120, 39))
    met = [s for s in stats if s.min is None or any(s.min <= last and first <= s.max for first, last in ranges)]
    assert len(stats) > 5 and len(met) <= len(stats) / 2


def test_coordinates_of_text_maps(spark):
    table = spark.sql("select map('x', '1.5', 'y', 'north') as position union all select null")
    assert {(x.lon, x.lat) for x in coordinates(table).collect()} == {(1.5, None), (None, None)}
    assert within_bbox_clustered(clustered_by_place(coordinates(table).withColumn("event_date", F.current_date())), WORLD).count() == 0
