"""Similarity of artists and venues as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def genre_similarity(a: Column, b: Column) -> Column:
    """Jaccard of the lower-cased genre sets; 0 if either is empty."""
    left, right = (F.transform(x, lambda g: F.lower(g)) for x in (a, b))
    union = F.size(F.array_union(left, right))
    jaccard = F.size(F.array_intersect(left, right)) / F.nullif(union, F.lit(0))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), jaccard).otherwise(0.0)


def popularity_similarity(a: Column, b: Column) -> Column:
    return 1.0 - F.abs(a - b) / 100.0


def artist_similarity(genre_a: Column, genre_b: Column, score_a: Column, score_b: Column) -> Column:
    return genre_similarity(genre_a, genre_b) * 0.6 + popularity_similarity(score_a, score_b) * 0.4


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if a coordinate is null."""
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(half_lat) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) ** 2
    # ``least`` would skip a null
    return F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h))) * (2 * EARTH_RADIUS_KM)


def capacity_similarity(a: Column, b: Column) -> Column:
    """Closeness on a logarithmic scale of three decades."""
    gap = F.abs(F.log10(F.greatest(a, F.lit(1))) - F.log10(F.greatest(b, F.lit(1))))
    return F.greatest(1.0 - gap / 3.0, F.lit(0.0))


def place_similarity(distance: Column, same_place: Column, reach_km: float = 100.0) -> Column:
    """Falls to 0 at ``reach_km``; without coordinates, whether city and state agree."""
    near = F.greatest(1.0 - distance / reach_km, F.lit(0.0))
    return F.when(distance.isNotNull(), near).otherwise(F.when(same_place, 1.0).otherwise(0.0))


def venue_similarity(place: Column, capacity: Column, same_type: Column) -> Column:
    return place * 0.4 + capacity * 0.3 + F.when(same_type, 1.0).otherwise(0.0) * 0.3
