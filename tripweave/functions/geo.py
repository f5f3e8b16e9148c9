"""Planar to geographic coordinates, and positions along a trip."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.schema import STATE_PLANE

# The latitude iteration gains about three digits a step.
LATITUDE_STEPS = 5


def lcc_inverse(x: Column, y: Column, plane: dict = STATE_PLANE) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of a Lambert conformal conic point.

    Formulas: J. P. Snyder, Map Projections, USGS Professional Paper 1395.
    """
    flattening = 1 / plane["inverse_flattening"]
    e = math.sqrt(2 * flattening - flattening**2)
    axis = plane["semi_major"]

    def scale(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def isometric(phi: float) -> float:
        squash = ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
        return math.tan(math.pi / 4 - phi / 2) / squash

    phi_1 = math.radians(plane["parallel_1"])
    phi_2 = math.radians(plane["parallel_2"])
    phi_0 = math.radians(plane["origin_latitude"])
    cone = math.log(scale(phi_1) / scale(phi_2)) / math.log(isometric(phi_1) / isometric(phi_2))
    factor = axis * scale(phi_1) / (cone * isometric(phi_1) ** cone)
    rho_0 = factor * isometric(phi_0) ** cone

    east = (x - plane["false_easting"]) * plane["unit_metres"]
    south = F.lit(rho_0) - (y - plane["false_northing"]) * plane["unit_metres"]
    rho = F.sqrt(east * east + south * south)
    longitude = F.degrees(F.atan2(east, south) / cone) + plane["central_meridian"]

    t = F.pow(rho / factor, F.lit(1 / cone))
    phi = F.lit(math.pi / 2) - F.atan(t) * 2
    # ((1 - es) / (1 + es)) ** (e / 2) written as exp(-e * atanh(es)): one use of
    # the previous step keeps the expression tree from doubling at every step.
    for _ in range(LATITUDE_STEPS):
        squash = F.exp(F.atanh(F.sin(phi) * e) * -e)
        phi = F.lit(math.pi / 2) - F.atan(t * squash) * 2
    return longitude, F.degrees(phi)


def interpolate(start: Column, end: Column, t0: Column, t1: Column, t: Column) -> Column:
    """The value between `start` at t0 and `end` at t1, held at both ends."""
    duration = (t1 - t0).cast("double")
    ratio = (t - t0).cast("double") / duration
    return (
        F.when(duration <= 0, start)
        .when(t <= t0, start)
        .when(t >= t1, end)
        .otherwise(start + (end - start) * ratio)
    )
