"""Day-grain factor analytics on Spark.

Raw event tables are cleaned, reduced to one row per day and joined by date, so
that conditions (weather) can be related to outcomes (collisions, transit use).
Every public function takes and returns ``DataFrame``; nothing here sets a
session option or triggers a job, except model fits and sinks.
"""

__version__ = "0.1.0"
