"""Names, thresholds and lookup tables that results depend on."""

# --- fixed values: calendar and experiment dates -------------------------------------------
START_DATE = "2009-01-01"
END_DATE = "2025-12-31"
VAL_START_DATE = "2024-01-01"
TEST_START_DATE = "2025-01-01"
TARGET_YEAR = 2025
REQUEST_MONTHS = 6

# --- fixed values: panel cleaning ----------------------------------------------------------
MIN_COVERAGE = 0.85
INTERPOLATION_LIMIT = 7
TRACE_RAIN_MM = 0.05
ID_FIELDS = ("fecha", "indicativo", "nombre", "provincia")
TEXT_FIELDS = ("altitud", "dir")
NUMBER_FIELDS = (
    "tmed", "prec", "tmin", "tmax", "velmedia", "racha", "sol", "presMax", "presMin", "hrMedia",
)
RECORD_FIELDS = (
    "fecha", "indicativo", "nombre", "provincia", "altitud", "tmed", "prec", "tmin", "tmax",
    "dir", "velmedia", "racha", "sol", "presMax", "presMin", "hrMedia",
)
REPLACED_FIELDS = ("presMin", "presMax", "sol")
REANALYSIS_FIELDS = ("sol", "presion", "nubes", "om_prec")
CONTINUOUS_FIELDS = (
    "tmed", "tmin", "tmax", "hrMedia", "velmedia", "racha", "presion", "nubes", "sol",
)
STATIC_FIELDS = ("nombre", "provincia", "altitud")
FILL_DEFAULTS = {"presion": 1013.0}
PHYSICAL_BOUNDS = {"hrMedia": (0.0, 100.0), "sol": (0.0, 24.0), "nubes": (0.0, 100.0)}
PREDICTION_BOUNDS = {"sol": (0.0, 16.0), "hrMedia": (0.0, 100.0)}
TRAINING_BOUNDS = {"sol": (0.0, 16.0), "hrMedia": (0.0, 100.0), "velmedia": (0.0, None)}

# --- fixed values: features ----------------------------------------------------------------
TARGETS = ("tmed", "tmin", "tmax", "sol", "hrMedia", "velmedia", "rain")
LAG_COLS = (
    "tmed", "tmin", "tmax", "presMin", "hrMedia", "presion", "nubes", "velmedia", "sol", "prec",
)
LAGS = (1, 2, 7)
ROLL_COLS = ("tmed", "hrMedia", "presion", "nubes")
WINDOWS = (3, 7, 14)
TREND_COLS = ("tmed", "tmin", "tmax")
PERSISTED_COLS = ("presion", "nubes", "presMin", "dir", "racha")
HISTORY_DAYS = 40
HORIZON_DAYS = 365

# --- fixed values: rain decisions ----------------------------------------------------------
RAIN_THRESHOLD = 0.25
RAIN_MM = 0.1
ROLLOUT_RAIN_THRESHOLD = 0.5
ROLLOUT_RAIN_MM = 10.0

# --- fixed values: boosting settings per target --------------------------------------------
BOOSTING = {
    "rain": {"num_leaves": 37, "max_depth": 4, "learning_rate": 0.032235621748698595,
             "min_child_samples": 44, "feature_fraction": 0.636330328808212},
    "tmed": {"num_leaves": 41, "max_depth": 5, "learning_rate": 0.06723617513088245,
             "min_child_samples": 65, "feature_fraction": 0.7563255346678099},
    "tmin": {"num_leaves": 43, "max_depth": 9, "learning_rate": 0.059195510550861974,
             "min_child_samples": 36, "feature_fraction": 0.6375208382158656},
    "tmax": {"num_leaves": 37, "max_depth": 12, "learning_rate": 0.011095544508496185,
             "min_child_samples": 99, "feature_fraction": 0.8114543219319856},
    "sol": {"num_leaves": 43, "max_depth": 6, "learning_rate": 0.04528920174130866,
            "min_child_samples": 40, "feature_fraction": 0.6927577892800432},
    "hrMedia": {"num_leaves": 41, "max_depth": 12, "learning_rate": 0.043679171445154236,
                "min_child_samples": 100, "feature_fraction": 0.9342236788131926},
    "velmedia": {"num_leaves": 55, "max_depth": 10, "learning_rate": 0.013339580668834696,
                 "min_child_samples": 38, "feature_fraction": 0.9354261406812598},
}

# --- fixed values: station dimension (code, name, lat, lon, map name) ----------------------
DEFAULT_LAT = 41.38
DEFAULT_LON = 2.17
STATIONS = (
    ("0252D", "Arenys De Mar", 41.581, 2.550, "Arenys de Mar"),
    ("0106X", "Balsareny", 41.863, 1.878, "Balsareny"),
    ("0201D", "Barcelona Port Olímpic", 41.380, 2.170, "Barcelona - Port Olímpic"),
    ("0076", "Barcelona Aeropuerto", 41.293, 2.070, "Barcelona - Aeropuerto"),
    ("0200E", "Barcelona, Fabra", 41.418, 2.124, "Barcelona - Fabra"),
    ("0201X", "Barcelona, Museo Marítimo", 41.376, 2.173, "Barcelona - Museo Marítimo"),
    ("0092X", "Berga", 42.100, 1.850, "Berga"),
    ("0222X", "Caldes De Montbui", 41.633, 2.167, "Caldes de Montbui"),
    ("0194D", "Corbera, Pic D'Agulles", 41.420, 1.920, "Corbera - Pic D'Agulles"),
    ("0260X", "Fogars De Montclús", 41.730, 2.440, "Fogars de Montclús"),
    ("0171X", "Igualada", 41.583, 1.617, "Igualada"),
    ("0149X", "Manresa", 41.720, 1.820, "Manresa"),
    ("0149D", "Manresa (La Culla)", 41.725, 1.826, "Manresa - La Culla"),
    ("0120X", "Moià", 41.810, 2.095, "Moià"),
    ("0158X", "Monistrol De Montserrat", 41.610, 1.840, "Monistrol de Montserrat"),
    ("0158O", "Montserrat", 41.590, 1.830, "Montserrat"),
    ("0061X", "Pontons", 41.415, 1.515, "Pontons"),
    ("0114X", "Prats De Lluçanès", 42.008, 2.030, "Prats de Lluçanès"),
    ("0229I", "Sabadell Aeropuerto", 41.520, 2.105, "Sabadell - Aeropuerto"),
    ("0349", "Sant Julià De Vilatorta", 41.923, 2.327, "Sant Julià de Vilatorta"),
    ("0255B", "Santa Susanna", 41.637, 2.710, "Santa Susanna"),
    ("0073X", "Sitges", 41.237, 1.807, "Sitges"),
    ("0341X", "Tona", 41.850, 2.227, "Tona"),
    ("0341", "Tona (Escola)", 41.852, 2.225, "Tona (Escola)"),
    ("0066X", "Vilafranca Del Penedès", 41.346, 1.698, "Vilafranca del Penedès"),
    ("0244X", "Vilassar De Dalt", 41.517, 2.360, "Vilassar de Dalt"),
)

# --- fixed values: variable labels and seasons ---------------------------------------------
VARIABLES = (
    ("tmed", "Mean Temperature", "°C"),
    ("tmin", "Minimum Temperature", "°C"),
    ("tmax", "Maximum Temperature", "°C"),
    ("sol", "Hours of Sunlight", "h"),
    ("hrMedia", "Relative Humidity", "%"),
    ("velmedia", "Wind Speed", "m/s"),
    ("rain", "Rain Probability", "%"),
)
SEASONS = (
    ("Winter (Jan-Mar)", (1, 2, 3)),
    ("Spring (Apr-Jun)", (4, 5, 6)),
    ("Summer (Jul-Sep)", (7, 8, 9)),
    ("Autumn (Oct-Dec)", (10, 11, 12)),
)
