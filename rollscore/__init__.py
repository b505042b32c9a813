"""rollscore: Spark-native scoring, evaluation and training-data jobs for
reward-based fine-tuning on number puzzles.

Sub-packages:

* ``functions``  -- Column functions (answer parsing, equation value, rewards,
  prompts, token arrays, losses)
* ``operators``  -- DataFrame -> DataFrame operators (scoring, evaluation,
  advantages, token batches, losses, metrics, tasks)
* ``sources``    -- readers and sinks (JSONL/Parquet tasks, metric tables,
  manifests, dataset card)
* ``streaming``  -- Structured Streaming versions of scoring and metrics
* ``plans``      -- end-to-end jobs, derived fixtures and the query registry
"""

__version__ = "0.1.0"

# Functions that run in Python workers travel with the task, so that workers
# need no copy of this package on their path.
import sys as _sys  # noqa: E402

from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
