"""Table contracts: expected columns by kind, unique key, required columns, bounds, maximum age."""

from __future__ import annotations

from dataclasses import dataclass, field

from walkgrid.constants import ADDRESS_COLUMNS, DIST_COLUMNS, SCORE_COLUMNS

KINDS = ("str", "numeric", "geometry")


@dataclass(frozen=True)
class Contract:
    schema: dict[str, str]
    unique: tuple[str, ...]
    complete: tuple[str, ...]
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    max_days: int | None = None

    def __post_init__(self) -> None:
        for column in (*self.unique, *self.complete, *self.bounds):
            if column not in self.schema:
                raise ValueError(f"column {column!r} is not declared in the schema")


@dataclass(frozen=True)
class TableMeta:
    layer: str
    name: str
    description: str
    segmentation: str = "snapshot"  # or the shard column

    @property
    def location(self) -> str:
        return f"{self.layer}/{self.name}"


_POINT = {"lng": "numeric", "lat": "numeric"}

# Names, kinds, keys, bounds and ages have to equal those that the tables' producers publish.
CONTRACTS: dict[str, Contract] = {
    "addresses": Contract(
        schema={**{name: "str" if kind == "string" else "numeric" for name, kind in ADDRESS_COLUMNS.items()}, **_POINT},
        unique=("ID_UEV",), complete=("ID_UEV", "lng", "lat"), max_days=360,
    ),
    "bike_paths": Contract(
        schema={"ID_CYCL": "numeric", "parts": "geometry"},
        unique=("ID_CYCL",), complete=("ID_CYCL", "parts"), max_days=360,
    ),
    "municipality_boundaries": Contract(
        schema={"NOM": "str", "TYPE": "str", "rings": "geometry"},
        unique=("rings",), complete=("NOM", "TYPE", "rings"), max_days=360,
    ),
    "parks": Contract(schema={"rings": "geometry"}, unique=("rings",), complete=("rings",), max_days=25),
    "pois": Contract(
        schema={"osm_type": "str", "osm_id": "numeric", "name": "str", "fclass": "str", **_POINT},
        unique=("osm_id",), complete=("fclass", "lng", "lat"), max_days=25,
    ),
    "transit_stops": Contract(
        schema={"stop_id": "str", **_POINT}, unique=("stop_id",), complete=("stop_id", "lng", "lat"), max_days=25,
    ),
    "cell_addresses": Contract(
        schema={"ID_UEV": "str", "cell_r10": "str", "cell_r6": "str", **_POINT},
        unique=("ID_UEV",), complete=("ID_UEV", "cell_r10", "cell_r6", "lng", "lat"),
    ),
    "cell_bike_paths": Contract(
        schema={"ID_CYCL": "numeric", "cell_r10": "str"},
        unique=("ID_CYCL", "cell_r10"), complete=("ID_CYCL", "cell_r10"),
    ),
    "cell_pois": Contract(
        schema={**_POINT, "cell_r10": "str", "name": "str", "category": "str"},
        unique=("lng", "lat", "category"), complete=("lng", "lat", "cell_r10", "category"),
    ),
    "cell_parks": Contract(
        schema={"rings": "geometry", "cell_r10": "str"}, unique=("rings",), complete=("rings", "cell_r10"),
    ),
    "cell_transit_stops": Contract(
        schema={"stop_id": "str", "cell_r10": "str", **_POINT},
        unique=("stop_id",), complete=("stop_id", "cell_r10", "lng", "lat"),
    ),
    "municipalities": Contract(
        schema={"municipality": "str", "type": "str", "rings": "geometry"},
        unique=("municipality",), complete=("municipality", "type", "rings"),
    ),
    "amenities": Contract(
        schema={"category": "str", "cell_r10": "str", "lat": "numeric", "lng": "numeric"},
        unique=("category", "lat", "lng"), complete=("category", "cell_r10", "lat", "lng"),
    ),
    "distances": Contract(
        schema={"ID_UEV": "str", "cell_r10": "str", "cell_r6": "str", **_POINT, **{d: "numeric" for d in DIST_COLUMNS}},
        unique=("ID_UEV",), complete=("ID_UEV", "cell_r10", "lng", "lat"),
    ),
    "livability_score": Contract(
        schema={
            "cell_r10": "str", "n_addresses": "numeric", **{s: "numeric" for s in SCORE_COLUMNS},
            "livability": "numeric", "municipality": "str",
        },
        unique=("cell_r10",),
        complete=("cell_r10", "n_addresses", "livability", "municipality", *SCORE_COLUMNS),
        bounds={"livability": (0.0, 100.0), **{s: (0.0, 100.0) for s in SCORE_COLUMNS}},
    ),
}
