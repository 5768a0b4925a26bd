"""Container-yard and dwell analytics as Spark DataFrame plans.

Every operator is a plain function from DataFrame(s) to DataFrame, so it can
be chained with ``df.transform`` and is planned by Catalyst as a whole.
"""

from quayside.params import AnalysisParams, TariffConfig, YardConfig

__all__ = ["AnalysisParams", "TariffConfig", "YardConfig"]
