"""Job parameters: extent, period, outlet. A frozen dataclass of literals for column builders."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Extent:
    """Rectangle ``[west, south, east, north]`` in degrees (EPSG:4326)."""

    west: float
    south: float
    east: float
    north: float

    def buffer(self, b: float) -> "Extent":
        """Grow the rectangle by ``b`` degrees on every side."""
        return Extent(self.west - b, self.south - b, self.east + b, self.north + b)

    def as_list(self) -> list[float]:
        return [self.west, self.south, self.east, self.north]


def _iso_date(text: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


@dataclass(frozen=True)
class JobParams:
    extent: Extent
    start_date: dt.date
    end_date: dt.date
    outlet_lon: float
    outlet_lat: float
    # Climate extent buffer in degrees; the fetcher's default is 2.0 (Q23), 0 = unbuffered variant.
    climate_buffer: float = 2.0

    @staticmethod
    def of(extent, start: str, end: str, outlet=(0.0, 0.0), climate_buffer: float = 2.0):
        """Job parameters from user input: ``[west, south, east, north]``, ISO dates of the first
        and last day, outlet ``(lon, lat)``. All faults found are named in one message."""
        first, last = _iso_date(start), _iso_date(end)
        faults = [text for text, wrong in (
            ("extent needs west, south, east and north", len(extent) != 4),
            ("outlet needs lon and lat", len(outlet) != 2),
            (f"{start!r} is not a date like 2024-01-31", first is None),
            (f"{end!r} is not a date like 2024-01-31", last is None),
            ("the period ends before it starts", first is not None and last is not None and last < first)) if wrong]
        if faults:
            raise ValueError("; ".join(faults))
        lon, lat = map(float, outlet)
        return JobParams(Extent(*map(float, extent)), first, last, lon, lat, float(climate_buffer))

    def with_(self, **kw) -> "JobParams":
        return replace(self, **kw)


# Parameters suggested for the test tables (FIXTURES.md): a 2x2 degree extent, one week.
FIXTURE_JOB = JobParams.of([85, 26, 87, 28], "2024-01-05", "2024-01-11", outlet=(85.4, 26.6))

# No bound on coordinates: whatever the table's size, the registered queries run over all of
# it while still going through the extent filter. (The edge-cutting queries have their own.)
EVERYWHERE = Extent(-1e9, -1e9, 1e9, 1e9)
WHOLE_DOMAIN_JOB = JobParams(EVERYWHERE, dt.date(2024, 1, 1), dt.date(2024, 1, 31), 85.4, 26.6, climate_buffer=0.0)
