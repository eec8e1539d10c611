"""Great-circle distance."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def distance_km(lat: Column, lon: Column, centre_lat: float, centre_lon: float) -> Column:
    """Haversine distance of a point column from a fixed centre."""
    half_lat = F.radians(lat - F.lit(float(centre_lat))) / 2
    half_lon = F.radians(lon - F.lit(float(centre_lon))) / 2
    chord = (
        F.sin(half_lat) * F.sin(half_lat)
        + F.cos(F.radians(F.lit(float(centre_lat)))) * F.cos(F.radians(lat))
        * F.sin(half_lon) * F.sin(half_lon)
    )
    # least() would take a missing coordinate for the far side of the globe
    return F.asin(F.sqrt(F.when(chord > 1.0, 1.0).otherwise(chord))) * (2 * EARTH_RADIUS_KM)


def band(lat: Column, lon: Column, centre_lat: float, centre_lon: float, km: float) -> Column:
    """Bands of latitude and longitude that hold every point within ``km`` of a centre, as plain comparisons.

    They reach the scan, so that row groups far away are not read. Near a pole
    there is no band of longitude, over the date line there are two. Coordinates
    beyond the usual ranges, which the distance takes as well, are let through.
    """
    reach = math.degrees(km / EARTH_RADIUS_KM) + 1e-6
    centre_lon = (centre_lon + 180.0) % 360.0 - 180.0
    found = lat.between(centre_lat - reach, centre_lat + reach) | (lat < -90.0) | (lat > 90.0)
    if abs(centre_lat) + reach >= 90.0:
        return found if abs(centre_lat) <= 90.0 else lat.isNotNull()
    width = math.degrees(math.asin(min(1.0, math.sin(math.radians(reach)) / math.cos(math.radians(centre_lat))))) + 1e-6
    west, east = centre_lon - width, centre_lon + width
    if west < -180.0 or east > 180.0:
        near = (lon >= (west + 360.0 if west < -180.0 else west)) | (lon <= (east - 360.0 if east > 180.0 else east))
    else:
        near = lon.between(west, east)
    # a latitude beyond a pole is a point on the other side of the globe
    return found & (near | (lon < -180.0) | (lon > 180.0) | (lat < -90.0) | (lat > 90.0))
