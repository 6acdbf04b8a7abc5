"""City fallback by coordinates for hotels missing from the hotel dimension.

Reference points are the centroids of each known city's distinct hotels (one row
per city, derived from silver; means of unit vectors). Unknown hotels (one row per hotel) look for the
nearest centroid within ``radius_km``: both sides are keyed by 1-degree grid
cells and joined on the cell, each hotel probing only the cells its radius
can reach (more longitude cells towards the poles, wrapping at the
antimeridian). Candidates per hotel are bounded by the cities in those cells;
no hotel-by-city cross product is formed. The join side sizes are counts of
hotels and cities, so AQE may broadcast them after measuring them at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from staylens.functions.geo import haversine_km

KM_PER_DEGREE = 111.32
DEFAULT_RADIUS_KM = 100.0


def _mean_point(points: DataFrame, key: str, lat: str, lon: str, out_lat: str, out_lon: str) -> DataFrame:
    """Per key the direction of the mean unit vector: longitudes on both sides of 180 degrees average rightly."""
    la, lo = F.radians(lat), F.radians(lon)
    v = points.groupBy(key).agg(F.avg(F.cos(la) * F.cos(lo)).alias("_x"), F.avg(F.cos(la) * F.sin(lo)).alias("_y"),
                                F.avg(F.sin(la)).alias("_z"))
    return v.select(key, F.degrees(F.atan2("_z", F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y")))).alias(out_lat),
                    F.degrees(F.atan2("_y", "_x")).alias(out_lon))


def _placed(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("hotel_id").isNotNull() & F.col("hotel_latitude").between(-90, 90)
                         & F.col("hotel_longitude").between(-180, 180))


def city_centroids(silver: DataFrame) -> DataFrame:
    """One point a city: the mean of its hotels, each hotel counted once however often it was searched."""
    known = _placed(silver).filter(F.col("city").isNotNull())
    hotels = _mean_point(known.withColumn("_hotel", F.struct("city", "hotel_id")), "_hotel", "hotel_latitude", "hotel_longitude", "lat", "lon")
    return _mean_point(hotels.select(F.col("_hotel.city").alias("city"), "lat", "lon"), "city", "lat", "lon", "c_lat", "c_lon")


def unknown_hotels(silver: DataFrame) -> DataFrame:
    return _mean_point(_placed(silver).filter(F.col("city").isNull()), "hotel_id", "hotel_latitude", "hotel_longitude", "lat", "lon")


def nearest_city(points: DataFrame, centroids: DataFrame, radius_km: float = DEFAULT_RADIUS_KM) -> DataFrame:
    """Nearest centroid within the radius per point (NULL city when none)."""
    lat_span = int(radius_km // KM_PER_DEGREE) + 1
    lon_span = F.least(F.lit(180), F.ceil(F.lit(radius_km) / (
        KM_PER_DEGREE * F.cos(F.radians(F.least(F.lit(89.0), F.abs("lat") + lat_span)))))).cast("int")
    probes = (points
              .withColumn("_dlat", F.explode(F.sequence(F.lit(-lat_span), F.lit(lat_span))))
              .withColumn("_dlon", F.explode(F.sequence(-lon_span, lon_span)))
              .withColumn("_cell_lat", F.floor("lat").cast("int") + F.col("_dlat"))
              .withColumn("_cell_lon", (F.pmod(F.floor("lon").cast("int") + F.col("_dlon") + 180, 360) - 180)))
    cells = centroids.select("city", "c_lat", "c_lon", F.floor("c_lat").cast("int").alias("_cell_lat"),
                             F.floor("c_lon").cast("int").alias("_cell_lon"))
    cand = (probes.join(cells, ["_cell_lat", "_cell_lon"])
            .withColumn("distance_km", haversine_km(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon")))
            .filter(F.col("distance_km") <= radius_km))
    w = Window.partitionBy("hotel_id").orderBy("distance_km", "city")
    best = (cand.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select("hotel_id", F.col("city").alias("fallback_city"), "distance_km"))
    return (points.join(best, "hotel_id", "left")
            .select("hotel_id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"),
                    "fallback_city", F.round("distance_km", 3).alias("distance_km")))
