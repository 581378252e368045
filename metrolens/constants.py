"""Fixed values that must equal the reference's for equal results.

Fixed values (map tile maths, heatmap threshold, ML settings, box limits):
"""

# Web-Mercator tile maths
TILE_SIZE = 256              # a world tile is 256 x 256 pixels at zoom 0
MAX_SIN_LAT = 1.0 - 1e-5     # sine of latitude is clipped to +/- this bound
MAX_SIZE = 640               # map side in pixels
SCALE = 2                    # pixel scale of the map image
DEFAULT_ZOOM = 10            # zoom when the extent is 0 or undefined

# Heatmap
BLANK_THRESH = 2 * 1e-3      # smoothed cells at or below this are blank
GAUSS_TRUNCATE = 4.0         # kernel radius in standard deviations

# Taxi box (open intervals) and regression window
NYC_LON_MIN, NYC_LON_MAX = -74.05, -73.75
NYC_LAT_MIN, NYC_LAT_MAX = 40.6, 40.9
FARE_MIN, FARE_MAX = 0.0, 60.0
DIST_MIN, DIST_MAX = 0.0, 0.21
PLOT_DIST_MAX, PLOT_FARE_MAX = 0.22, 60.0

# ML settings
PICKUP_CLUSTERS = 20
DROPOFF_CLUSTERS = 5
KMEANS_SEED = 1
KMEANS_ROUNDS = 10            # of the repeatable fit
COORDINATE_SCALE = 1_000_000.0  # parts of a degree in the repeatable fit
QUANTILE_BUCKETS = 100
SGD_ITERATIONS = 100
SGD_STEP = 0.2

# Histogram of pickups
HIST_BINS = 1024

# Bikes: time of day and seasons by month
MORNING_BEFORE_HOUR = 10     # start hour < 10
EVENING_AFTER_HOUR = 17      # start hour > 17
SEASON_MONTHS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "fall": (9, 10, 11),
}
