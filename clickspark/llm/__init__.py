"""Operators for preparing training data: text, pages and conversations.

Nothing else in the package imports this subpackage. Functions that run in
tasks are sent with the task, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
