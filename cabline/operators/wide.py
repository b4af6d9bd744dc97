"""Wide (one-big-table) projection of the raw trip tables.

Per service a column spec maps raw columns to the 40 wide columns; both zone
lookups are left joins to one broadcast dimension (bounded size), so the whole
build is shuffle-free map work; services are appended with ``unionByName``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline import schemas
from cabline.functions import derived as X
from cabline.functions import labels as L


@dataclass(frozen=True)
class ServiceSpec:
    """How one service's raw table maps onto the wide schema."""

    name: str
    pickup: str
    dropoff: str
    missing: tuple[str, ...] = ()        # wide columns the service lacks (typed NULL)
    renames: Mapping[str, str] = field(default_factory=dict)


SERVICES = {
    "yellow": ServiceSpec("yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime", missing=("trip_type",)),
    "green": ServiceSpec("green", "lpep_pickup_datetime", "lpep_dropoff_datetime", missing=("airport_fee",)),
}

_WIDE_TYPES = {f.name: f.dataType for f in schemas.WIDE.fields}

# raw column -> wide column for the columns copied as they are
_COPY = {
    "source_month": "month", "source_year": "year",
    "PULocationID": "pu_location_id", "DOLocationID": "do_location_id",
    "VendorID": "vendor_id", "RatecodeID": "rate_code_id", "payment_type": "payment_type",
    "trip_type": "trip_type", "passenger_count": "passenger_count", "trip_distance": "trip_distance",
    "fare_amount": "fare_amount", "extra": "extra", "mta_tax": "mta_tax", "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount", "improvement_surcharge": "improvement_surcharge",
    "congestion_surcharge": "congestion_surcharge", "cbd_congestion_fee": "cbd_congestion_fee",
    "airport_fee": "airport_fee", "total_amount": "total_amount",
    "store_and_fwd_flag": "store_and_fwd_flag", "run_tag": "run_id",
}


def wide_projection(raw: DataFrame, spec: ServiceSpec, zones: DataFrame,
                    years: Iterable[int] | None = None, tip_as_percent: bool = False) -> DataFrame:
    """One service's raw trips -> the 40 wide columns (in declared order).

    The zone joins carry no hint: the planner broadcasts the dimension when its size in
    bytes allows and shuffles otherwise.
    """
    if years is not None:
        raw = raw.where(F.col("source_year").isin(list(years)))
    zdim = zones.select("locationid", "zone", "borough")
    zpu = zdim.select(F.col("locationid").alias("_pu_id"), F.col("zone").alias("pu_zone"),
                      F.col("borough").alias("pu_borough"))
    zdo = zdim.select(F.col("locationid").alias("_do_id"), F.col("zone").alias("do_zone"),
                      F.col("borough").alias("do_borough"))
    t = (raw.join(zpu, raw["PULocationID"] == zpu["_pu_id"], "left")
            .join(zdo, raw["DOLocationID"] == zdo["_do_id"], "left"))
    pu, do = F.col(spec.pickup), F.col(spec.dropoff)
    derived = {
        "pickup_datetime": pu,
        "dropoff_datetime": do,
        "pickup_hour": X.hour_of(pu),
        "pickup_dow": X.dow_sunday0(pu),
        "pu_zone": F.col("pu_zone"), "pu_borough": F.col("pu_borough"),
        "do_zone": F.col("do_zone"), "do_borough": F.col("do_borough"),
        "service_type": F.lit(spec.name),
        "vendor_name": L.label(F.col("VendorID"), L.VENDOR_NAMES),
        "rate_code_desc": L.label(F.col("RatecodeID"), L.RATE_CODE_DESCRIPTIONS),
        "payment_type_desc": L.label(F.col("payment_type"), L.PAYMENT_TYPE_DESCRIPTIONS),
        "trip_duration_min": X.trip_duration_min(pu, do),
        "avg_speed_mph": X.avg_speed_mph(F.col("trip_distance"), pu, do),
        "tip_pct": X.tip_pct(F.col("tip_amount"), F.col("total_amount"), tip_as_percent),
        "source_year": F.col("source_year"), "source_month": F.col("source_month"),
        "ingested_at_utc": F.col("ingested_at_utc"),
    }
    for raw_name, wide_name in _COPY.items():
        derived.setdefault(wide_name, F.col(raw_name))
    out = []
    for name in schemas.WIDE_COLUMNS:
        dtype = _WIDE_TYPES[name]
        c = F.lit(None) if name in spec.missing else derived[name]
        out.append(c.cast(dtype).alias(name))
    return t.select(*out)


def build_wide(raw_by_service: Mapping[str, DataFrame], zones: DataFrame,
               years: Iterable[int] | None = None, services: Iterable[str] | None = None,
               specs: Mapping[str, ServiceSpec] = SERVICES, clustered: bool = False) -> DataFrame:
    """UNION ALL of the per-service wide projections (duplicates kept).

    ``clustered``: for a write by (source_year, service_type). Each service's raw rows are
    brought together by year before they are widened, so that what is shuffled are the raw
    columns and not the labels, zone names and measures made of them; the sink need not
    shuffle again. (A zone dimension too large to broadcast deals the rows out anew.)
    """
    wanted = list(services) if services is not None else list(raw_by_service)
    unknown = [s for s in wanted if s not in specs]
    if unknown:
        raise ValueError(f"unknown services: {unknown}")
    zones = zones.select("locationid", "zone", "borough")
    raw_by_service = {s: raw_by_service[s] for s in wanted}
    if clustered:
        raw_by_service = {s: raw.hint("rebalance", F.col("source_year")) for s, raw in raw_by_service.items()}
    parts = [wide_projection(raw_by_service[s], specs[s], zones, years) for s in wanted]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
