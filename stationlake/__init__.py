"""stationlake: station-observation analytics on Spark.

Every public function takes and returns DataFrames; nothing is collected to
the driver. Modules:

* ``schemas``      -- column lists, struct types and the fixed rule tables
* ``functions``    -- column expressions (quality flags, scores, stable rounding, lenient parsing)
* ``sources``      -- catalogue, payload, message and table readers/writers
* ``operators``    -- cleanse, curate, summarise, history, views, reports, lookups
* ``streaming``    -- Structured Streaming landing, hourly-latest and de-duplication
* ``plans``        -- the daily job and the registered query catalogue
"""

from stationlake.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
