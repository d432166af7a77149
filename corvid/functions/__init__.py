"""Column-level functions: every one returns a native Spark ``Column``."""

from corvid.functions.geo import EARTH_RADIUS_KM, PI_TRUNCATED, haversine_km, to_radians
from corvid.functions.text import basename, label_from_text, parse_double, strip_scheme
from corvid.functions.time import epoch_micros

__all__ = [
    "EARTH_RADIUS_KM", "PI_TRUNCATED", "haversine_km", "to_radians",
    "basename", "label_from_text", "parse_double", "strip_scheme", "epoch_micros",
]
