"""metrolens: city-mobility analytics as Spark DataFrame plans.

Parking tickets, taxi trips and bike rides: cleaning, time-of-day and
calendar counts, interval joins of house numbers to street segments,
proximity counts, geocoding, map-ready pixel data (Web-Mercator, zoom,
histograms, smoothed density grids, hulls, poly-lines) and Spark ML fits.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and
stays lazy; nothing is collected to the driver except bounded one-row
statistics (map bounds, model coefficients).
"""

__version__ = "0.1.0"
