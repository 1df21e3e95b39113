"""Station weather analytics on Spark: ingest, clean, roll up, reconcile, trend and audit.

Every public function takes and returns a DataFrame (or a Column) and stays lazy: nothing here
collects rows to the driver.
"""

DEFAULT_BY = ("location_id",)
