"""teampulse: software-team activity analytics on Spark DataFrames.

Layers (each a set of DataFrame -> DataFrame functions):

* ``sources``   landed JSON payloads -> raw tables, raw table I/O, test fixtures
* ``operators`` reusable relational building blocks (keyed upsert, skew-safe
                top-n, rank via score histogram, union-all pivot)
* ``plans``     the models and reports: staging, marts, leaderboard, trends,
                team summary, pipeline runs, dashboard insights
* ``streaming`` the daily incremental load as an ``availableNow`` stream
* ``functions`` Column-level helpers shared by all of the above
"""

__version__ = "0.1.0"
