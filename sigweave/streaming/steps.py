"""Per-row steps of the keyed rules for streams (K1-K3).

A step sees the rows of one key in time order. It reads and changes the key's state, a
dict of its declared fields, and returns its labels. Rows of earlier micro-batches are
known only through the state, so a late row is judged against the current state.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.functions.geo import EARTH_RADIUS_KM
from sigweave.functions.thresholds import NO_LIMIT
from sigweave.operators.slices import SlicePlan
from sigweave.operators.stay import DEFAULT_TIMEOUT_MS, stay_state


class Step(Protocol):
    """One keyed rule. ``state`` and ``labels`` are (name, type) pairs."""

    state: Sequence[tuple[str, str]]
    labels: Sequence[tuple[str, str]]

    def apply(self, row: Mapping[str, Any], state: dict[str, Any]) -> tuple: ...

    def final(
        self, df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: SlicePlan | str
    ) -> tuple[DataFrame, list[Column]]:
        """Rows of a table, and aggregates by key over them that give the state after all."""
        ...


@dataclass(frozen=True)
class PreviousStep:
    column: str
    name: str = "last_imei"

    @property
    def state(self):
        return [(f"{self.name}_seen", "string")]

    @property
    def labels(self):
        return [(self.name, "string")]

    def apply(self, row, state):
        field = f"{self.name}_seen"
        before = state[field]
        state[field] = None if row[self.column] is None else str(row[self.column])
        return ("" if before is None else before,)

    def final(self, df, keys, order, slices):
        last = F.max_by(F.col(self.column).cast("string"), F.struct(*order))
        return df, [last.alias(f"{self.name}_seen")]


@dataclass(frozen=True)
class TrackStep:
    time: str
    latitude: str = "geo_latitude"
    longitude: str = "geo_longitude"
    site: Sequence[str] = ("lac", "ci")

    state = (
        ("track_latitude", "double"),
        ("track_longitude", "double"),
        ("track_time", "long"),
        ("track_site", "string"),
    )
    labels = (("distance", "double"), ("speed", "double"), ("last_lac_ci", "string"))

    def apply(self, row, state):
        lat, lon, t = row[self.latitude], row[self.longitude], row[self.time]
        parts = [row[c] for c in self.site]
        site = None if None in parts else "".join(parts)
        before = state["track_site"]
        if t is None:
            return None, None, "" if before is None else before
        distance = speed = None
        if state["track_time"] is not None:
            distance = _whole_km(lat, lon, state["track_latitude"], state["track_longitude"])
            elapsed = t - state["track_time"]
            if elapsed and distance is not None:
                speed = distance / elapsed
        state.update(
            track_latitude=lat, track_longitude=lon, track_time=t, track_site=site
        )
        return distance, speed, "" if before is None else before

    def final(self, df, keys, order, slices):
        place = F.when(F.col(self.time).isNotNull(), F.struct(*order))
        fields = [
            F.col(self.latitude).cast("double"),
            F.col(self.longitude).cast("double"),
            F.col(self.time).cast("long"),
            F.concat(*self.site),
        ]
        return df, [
            F.max_by(value, place).alias(name)
            for (name, _), value in zip(self.state, fields, strict=True)
        ]


def _whole_km(lat1, lon1, lat2, lon2) -> float | None:
    if None in (lat1, lon1, lat2, lon2):
        return None
    phi1, phi2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((phi1 - phi2) / 2) ** 2 + math.cos(phi1) * math.cos(phi2) * (
        math.sin((math.radians(lon1) - math.radians(lon2)) / 2) ** 2
    )
    km = math.asin(math.sqrt(min(h, 1.0))) * (2 * EARTH_RADIUS_KM)
    return float(math.floor(math.floor(km * 10000 + 0.5) / 10000))


@dataclass(frozen=True)
class StayStep:
    """Length of stay with the late-row rules.

    With M the latest time of any area in the key's state, a row more than the timeout
    after M forgets all areas, and one more than the timeout before M changes nothing.
    Within an area a row before the stay's start moves the start back, if it is near
    enough; a row inside the stay changes nothing.
    """

    time: str
    areas: Sequence[str]
    limits: Sequence[int]
    timeout_ms: int = DEFAULT_TIMEOUT_MS
    match_max: bool = True
    output_threshold: bool = True
    strict: bool = False

    @property
    def state(self):
        return [(f"stay_{end}_{a}", "long") for a in self.areas for end in ("first", "last")]

    @property
    def labels(self):
        return [(f"stay_{a}", "string") for a in self.areas]

    def _crossed(self, old: int, new: int) -> str:
        hits = [
            limit
            for limit in self.limits
            if (old < limit if self.strict else old <= limit) and limit <= new
        ]
        if not hits:
            return NO_LIMIT
        if not self.output_threshold:
            return str(new)
        return str(max(hits) if self.match_max else min(hits))

    def apply(self, row, state):
        label = dict.fromkeys(self.areas, NO_LIMIT)
        here = [a for a in self.areas if row[f"area_{a}"] == "true"]
        t = row[self.time]
        # A row without a time changes nothing.
        if here and t is not None:
            lasts = [state[f"stay_last_{a}"] for a in self.areas]
            latest = max((x for x in lasts if x is not None), default=0)
            if t - latest > self.timeout_ms:
                for a in self.areas:
                    state[f"stay_first_{a}"] = state[f"stay_last_{a}"] = None
            if latest - t <= self.timeout_ms:
                for a in here:
                    label[a] = self._visit(a, t, state)
        return tuple(label[a] for a in self.areas)

    def final(self, df, keys, order, slices):
        # A row without a time changes nothing.
        timed = df.filter(F.col(order[0]).isNotNull())
        return stay_state(
            timed, keys, order, self.areas, timeout_ms=self.timeout_ms, slices=slices
        )

    def _visit(self, area: str, t: int, state) -> str:
        first_key, last_key = f"stay_first_{area}", f"stay_last_{area}"
        first, last = state[first_key], state[last_key]
        if first is None or first > last or t - last > self.timeout_ms:
            state[first_key] = state[last_key] = t
            return NO_LIMIT
        if t < first:
            if first - t > self.timeout_ms:
                return NO_LIMIT
            state[first_key] = t
            return self._crossed(last - first, last - t)
        if t <= last:
            return NO_LIMIT
        state[last_key] = t
        return self._crossed(last - first, t - first)
