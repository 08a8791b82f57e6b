"""rivernet: lake connectivity on river networks, as Spark DataFrame jobs.

Every operator takes and returns DataFrames and keeps the water-region id
``wrid`` as the first key, so all regions run in one job.
"""

__version__ = "0.1.0"
