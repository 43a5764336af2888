"""The package on the executors' Python path, once per Spark application."""

import os
import shutil
import tempfile

import rinkflow

_shipped = set()


def ship(spark):
    """Let Python workers import this package wherever they run.

    The driver serves the archive to the executors, lost ones' successors too.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(rinkflow.__file__)))
    name = os.path.join(os.path.realpath(tempfile.mkdtemp()), "rinkflow")
    context.addPyFile(shutil.make_archive(name, "zip", root, "rinkflow"))
    _shipped.add(context.applicationId)
