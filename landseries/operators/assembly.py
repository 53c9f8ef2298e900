"""Feature arrays of a sensor's series: bands, indices and user features in one order with their names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landseries.functions import spectral

INDICES = ("NDVI", "NDWI", "Brightness")


@dataclass(frozen=True)
class Sensor:
    """A sensor's bands and which of them, counted from 1, are red, near and short-wave infrared (none: no NDWI).

    reference: bands are given as indices against this one. duplicates: keep an index that
    those already hold. copies: give the bands themselves. user: index name to function of
    the array of bands.
    """

    name: str
    bands: Sequence[str]
    red: int
    nir: int
    swir: int | None = None
    reference: int | None = None
    duplicates: bool = True
    copies: bool = True
    factor: float = 1000.0
    user: dict[str, Callable[[Column], Column]] = field(default_factory=dict)

    def __post_init__(self):
        for what, n in (("red", self.red), ("nir", self.nir), ("swir", self.swir), ("reference", self.reference)):
            if n is not None and not 1 <= n <= len(self.bands):
                raise ValueError(f"{self.name}: {what} is band {n} of {len(self.bands)}")

    def indices(self) -> list[str]:
        """NDVI repeats the relative bands if red is the reference, NDWI if near infrared is."""
        gone = {"NDWI"} if self.swir is None else set()
        if self.reference and not self.duplicates:
            gone |= {n for n, b in (("NDVI", self.red), ("NDWI", self.nir)) if b == self.reference}
        return [n for n in INDICES if n not in gone]


def feature_names(sensor: Sensor, dates: Sequence[str]) -> list[str]:
    """sensor_feature_date: bands date by date, then each index over all dates, then user features."""
    copied = [f"{sensor.name}_{b}_{d}" for d in dates for b in sensor.bands] if sensor.copies else []
    return copied + [f"{sensor.name}_{n}_{d}" for n in (*sensor.indices(), *sensor.user) for d in dates]


def assembled(rows: DataFrame, sensor: Sensor) -> DataFrame:
    """(pixel, features) of rows (pixel, date_idx, bands), in the order of feature_names().

    A pixel's dates are gathered in order; a date with a no-data band has no-data indices. All
    pixels should have the same dates, as after gap filling; null dates are left out.
    """
    values = spectral.date_features(F.col("bands"), sensor.red, sensor.nir, sensor.swir, sensor.factor)
    own = F.col("bands") if sensor.reference is None else spectral.relative_reflectance(F.col("bands"), sensor.reference)
    of_index = {"NDVI": F.col("i.ndvi"), "NDWI": F.col("i.ndwi"), "Brightness": F.col("i.brightness")}
    gone = spectral.missing(F.col("bands"))
    user = [F.when(gone, F.lit(spectral.NO_DATA)).otherwise(f(F.col("bands"))) for f in sensor.user.values()]
    date = rows.where("date_idx is not null").withColumn("i", values)
    date = date.select("pixel", F.struct("date_idx", own.alias("own"), F.array(*(of_index[n] for n in sensor.indices()), *user).alias("more")).alias("d"))
    series = date.groupBy("pixel").agg(F.array_sort(F.collect_list("d")).alias("s"))
    parts = [F.flatten(F.transform("s", lambda d: d["own"]))] if sensor.copies else []
    many = len(sensor.indices()) + len(user)
    across = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda k: F.transform("s", lambda d: F.get(d["more"], k)))) if many else F.array().cast("array<double>")
    return series.select("pixel", F.concat(*parts, across).alias("features"))


def all_sensors(parts: dict[str, DataFrame], labels: dict[str, list[str]], standard: bool = False) -> tuple[DataFrame, list[str]]:
    """(pixel, features) of all sensors side by side, in the order given, and the names of the features.

    standard: names value_0, value_1, .. instead. A pixel that a sensor lacks is left out.
    """
    out, names = None, []
    for name, part in parts.items():
        own = part.select("pixel", F.col("features").alias(name))
        out = own if out is None else out.join(own, "pixel")
        names += labels[name]
    return out.select("pixel", F.concat(*parts).alias("features")), [f"value_{k}" for k in range(len(names))] if standard else names
