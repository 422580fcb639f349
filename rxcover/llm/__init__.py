"""Training-data operators: WARC archives, licence scans, tokenisation,
decontamination, language ID, deduplication, extraction and PII.

Nothing else in the library imports this subpackage. Its functions travel to
the executors with the jobs that use them, so workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
