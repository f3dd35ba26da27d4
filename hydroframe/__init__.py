"""hydroframe: Spark-native preparation and reading of gridded hydrological model data.

Every operator is a ``DataFrame -> DataFrame`` function (use with ``DataFrame.transform``)
built on Spark SQL expressions, so Catalyst plans, prunes and pushes down the work. The whole
job is ``build_model_inputs`` and the post-run extraction ``extract_discharge_at_outlet``
(both in ``hydroframe.plans.job``, also importable from here).
"""

from hydroframe.params import Extent, JobParams
from hydroframe.session import ensure_checkpoint_dir, get_spark

__all__ = ["Extent", "JobInputs", "JobParams", "build_model_inputs", "ensure_checkpoint_dir",
           "extract_discharge_at_outlet", "get_spark"]


def __getattr__(name):  # lazy: importing the package does not import every operator
    if name in ("JobInputs", "build_model_inputs", "extract_discharge_at_outlet"):
        from hydroframe.plans import job
        return getattr(job, name)
    raise AttributeError(name)
