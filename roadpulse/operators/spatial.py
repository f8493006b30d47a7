"""Selection by place."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within_bbox(
    rows: DataFrame,
    bbox: tuple[float, float, float, float],
    position: str = "position",
    lon_key: str = "x",
    lat_key: str = "y",
    *,
    columns: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows inside ``(minLon, minLat, maxLon, maxLat)``, edges included.

    Positions are text maps; a missing or unreadable coordinate is outside. A table that has
    the coordinates as numeric ``columns`` (longitude, latitude) is better asked for these: the
    bounds then reach the scan, which skips row groups by their statistics.
    """
    min_lon, min_lat, max_lon, max_lat = bbox
    if columns is None:
        place = F.col(position)
        lon = place[lon_key].try_cast("double")
        lat = place[lat_key].try_cast("double")
    else:
        lon, lat = map(F.col, columns)
    return rows.where(lon.between(min_lon, max_lon) & lat.between(min_lat, max_lat))


#: Bits of each coordinate in a place key, and ranges of keys that stand for a box at most.
KEY_BITS, MOST_RANGES = 16, 64
#: (least longitude, least latitude, greatest longitude, greatest latitude)
WORLD = (-180.0, -90.0, 180.0, 90.0)

Extent = tuple[float, float, float, float]


def coordinates(rows: DataFrame, position: str = "position", lon_key: str = "x", lat_key: str = "y") -> DataFrame:
    """``rows`` with the coordinates of their text map as numbers ``lon`` and ``lat``, null if unreadable."""
    place = F.col(position)
    return rows.withColumns(
        {"lon": place[lon_key].try_cast("double"), "lat": place[lat_key].try_cast("double")}
    )


def place_key(lon: Column | str, lat: Column | str, extent: Extent = WORLD) -> Column:
    """Morton (Z-order) key: the bits of both coordinates, dealt in turn, so near places have near keys.

    Coordinates beyond the extent count as its edge; a null or NaN one makes a null key.
    """
    spans = ((extent[0], extent[2]), (extent[1], extent[3]))
    columns = (F.col(x) if isinstance(x, str) else x for x in (lon, lat))
    cells = [_cell(column, *span) for column, span in zip(columns, spans)]
    x, y = (_spread(F.when(~F.isnan(cell), cell).cast("bigint")) for cell in cells)
    return x.bitwiseOR(F.shiftleft(y, 1))


def _cell(value: Column, least: float, greatest: float) -> Column:
    """Number of the grid line at or below a coordinate; grows with it."""
    last = float((1 << KEY_BITS) - 1)
    share = (value - F.lit(least)) / F.lit(greatest - least)
    return F.greatest(F.least(F.floor(share * (last + 1)).cast("double"), F.lit(last)), F.lit(0.0)) + value * 0


def _spread(cell: Column) -> Column:
    """A zero after each bit."""
    for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        cell = cell.bitwiseOR(F.shiftleft(cell, step)).bitwiseAND(F.lit(mask).cast("bigint"))
    return cell


def key_ranges(bbox: Extent, extent: Extent = WORLD, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Ranges of place keys, ends included, that hold every place of a box, and little else.

    The grid is quartered as long as the quarters that the box touches are no more than ``most``;
    quarters next to each other in order of keys are one range.
    """
    size = 1 << KEY_BITS

    def cell(value: float, least: float, greatest: float) -> int:
        return max(0, min(size - 1, math.floor((value - least) / (greatest - least) * size)))

    low = (cell(bbox[0], extent[0], extent[2]), cell(bbox[1], extent[1], extent[3]))
    high = (cell(bbox[2], extent[0], extent[2]), cell(bbox[3], extent[1], extent[3]))

    def touched(square: tuple[int, int, int, int]) -> bool:
        x, y, side, _ = square
        return x <= high[0] and x + side > low[0] and y <= high[1] and y + side > low[1]

    def inside(square: tuple[int, int, int, int]) -> bool:
        x, y, side, _ = square
        return low[0] <= x and x + side - 1 <= high[0] and low[1] <= y and y + side - 1 <= high[1]

    squares = [(0, 0, size, 0)]
    while any(square[2] > 1 and not inside(square) for square in squares):
        finer = []
        for square in squares:
            x, y, side, first = square
            if side == 1 or inside(square):
                finer.append(square)
                continue
            half = side // 2
            quarters = [(x + half * (k & 1), y + half * (k >> 1), half, first + k * half * half) for k in range(4)]
            finer += filter(touched, quarters)
        if len(_joined(finer)) > most:
            break
        squares = finer
    return _joined(squares)


def _joined(squares: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    ranges: list[tuple[int, int]] = []
    for first, last in sorted((first, first + side * side - 1) for _, _, side, first in squares):
        if ranges and ranges[-1][1] + 1 == first:
            ranges[-1] = (ranges[-1][0], last)
        else:
            ranges.append((first, last))
    return ranges


def clustered_by_place(rows: DataFrame, extent: Extent = WORLD, day: str = "event_date") -> DataFrame:
    """``rows`` (with ``lon`` and ``lat``) and ``place_key``, dealt to tasks by day and key and sorted so.

    Written as they are, each file and row group holds a small part of a day's map; days that hold most
    rows are many tasks. Rows without a place come first.
    """
    keyed = rows.withColumn("place_key", place_key("lon", "lat", extent))
    return keyed.repartitionByRange(day, "place_key").sortWithinPartitions(day, "place_key")


def within_bbox_clustered(rows: DataFrame, bbox: Extent, extent: Extent = WORLD) -> DataFrame:
    """``within_bbox`` of a table written by ``clustered_by_place`` with the same extent.

    The ranges of keys that make up the box reach the scan, which leaves out row groups by their
    statistics; the coordinates decide what is inside.
    """
    near = F.lit(False)
    for first, last in key_ranges(bbox, extent):
        near = near | F.col("place_key").between(first, last)
    return within_bbox(rows.where(near), bbox, columns=("lon", "lat"))
