"""They have to equal the ones the scoring method publishes, or results differ."""

# Scored categories, in report order.
CATEGORIES = ("grocery", "school", "health", "transit", "park", "bike")

# Default blend weights.
DEFAULT_WEIGHTS = {
    "grocery": 0.20,
    "transit": 0.20,
    "park": 0.20,
    "bike": 0.15,
    "school": 0.15,
    "health": 0.10,
}

# (metres, score) knots of the distance score: flat before the first, zero past the last.
SCORE_KNOTS = ((100.0, 100.0), (500.0, 50.0), (1000.0, 20.0))

# Point-of-interest tags accepted per category: category -> tag key -> values.
POI_TAGS = {
    "grocery": {"shop": ("supermarket", "convenience", "greengrocer", "bakery", "butcher")},
    "school": {"amenity": ("school", "college", "university", "kindergarten")},
    "health": {"amenity": ("clinic", "hospital", "pharmacy", "doctors", "dentist")},
}

# Source bounding box: min lng, min lat, max lng, max lat.
POI_BBOX = (-74.05, 45.35, -73.40, 45.75)

UNKNOWN_MUNICIPALITY = "Inconnu"

# Great-circle radius in metres.
EARTH_RADIUS_M = 6378137.0

# Published average hexagon edge lengths (metres) for resolutions 10 (analysis), 9 (map), 6 (shards).
EDGE_M = {10: 75.86, 9: 200.79, 6: 3724.53}

MAX_RING = 10

# Colour ramp: (score, red, green, blue).
COLOR_STOPS = (
    (0.0, 215, 25, 28),
    (25.0, 253, 174, 97),
    (50.0, 255, 255, 191),
    (75.0, 166, 217, 106),
    (100.0, 26, 150, 65),
)

# Report labels.
CATEGORY_LABELS = {
    "grocery": "Grocery stores", "school": "Schools", "health": "Health",
    "park": "Parks", "transit": "Transit", "bike": "Bike paths",
}

# Columns of the landed address table and their types.
ADDRESS_COLUMNS = {
    "ID_UEV": "string", "CIVIQUE_DEBUT": "string", "CIVIQUE_FIN": "string", "NOM_RUE": "string", "SUITE_DEBUT": "string",
    "ETAGE_HORS_SOL": "long", "NOMBRE_LOGEMENT": "long", "ANNEE_CONSTRUCTION": "long", "CODE_UTILISATION": "string",
    "LETTRE_DEBUT": "string", "LETTRE_FIN": "string", "LIBELLE_UTILISATION": "string", "CATEGORIE_UEF": "string",
    "MATRICULE83": "string", "SUPERFICIE_TERRAIN": "double", "SUPERFICIE_BATIMENT": "double", "NO_ARROND_ILE_CUM": "string",
    "MUNICIPALITE": "string",
}

# Snapshot stamp: fixed-width UTC, so text order is time order.
STAMP_FORMAT = "%Y%m%dT%H%M%S_%fZ"
STAMP_SPARK_FORMAT = "yyyyMMdd'T'HHmmss_SSSSSS'Z'"

SCORE_COLUMNS = tuple(f"score_{c}" for c in CATEGORIES)
DIST_COLUMNS = tuple(f"dist_{c}" for c in CATEGORIES)
