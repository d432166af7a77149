"""corvid: DataFrame-to-DataFrame analytics operators on PySpark.

Four workloads, each expressed as Spark jobs:

* geo      -- haversine radius filter and inverse-distance-weighted estimates
              (``corvid.operators.geo``)
* feed     -- follower sets, fan-out-on-write and merge-on-read timelines, ordered
              reads, upserts (``corvid.operators.feed``, ``corvid.streaming``)
* profile  -- min / max / avg / non-empty / distinct profile of any table
              (``corvid.operators.profile``)
* imaging  -- pixel, Sobel, Laplace and Canny features (``corvid.operators.imaging``)
              feeding Spark ML classifiers (``corvid.operators.ml``)

Column functions live in ``corvid.functions``, readers and writers in
``corvid.sources``, plan helpers (size-checked broadcast, skew-safe ranking,
final-plan reader) and the registered queries in ``corvid.plans``, and the
reference workflows over their own files in ``corvid.jobs`` (``python -m corvid``).
"""

__version__ = "0.1.0"
