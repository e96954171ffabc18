"""The registered query catalogue over the test tables.

Importing this package registers every plan; ``catalog.queries()`` and
``catalog.oracles()`` expose them to ``__spark_entry__``.
"""

from . import catalog  # noqa: F401
from . import profile_plans  # noqa: F401
from . import feature_plans  # noqa: F401
from . import text_plans  # noqa: F401
from . import recommend_plans  # noqa: F401
from . import model_plans  # noqa: F401
from . import cluster_plans  # noqa: F401
from . import ml_plans  # noqa: F401
from . import check_plans  # noqa: F401
from . import study_plans  # noqa: F401
from . import stream_plans  # noqa: F401
from . import solver_plans  # noqa: F401
from . import tree_plans  # noqa: F401
from . import fit_plans  # noqa: F401
from . import word_plans  # noqa: F401
