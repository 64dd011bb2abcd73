"""Training-data operators: language ID, toxicity, mixing, deduplication,
packing, language-model scoring, personal data, secrets, spelling variants and
conversation repair.

Every module holds one operator with a general interface; ``queries`` holds the
thin registered queries over the test tables and their SQL.
"""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package by value, so that executors need not
# have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
