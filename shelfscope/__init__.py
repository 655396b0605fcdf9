"""Spark jobs for product-catalogue observations (see README)."""

import sys

from pyspark import cloudpickle

from shelfscope.session import build_session, scratch_root

# Arrow functions travel to the workers by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "scratch_root"]
