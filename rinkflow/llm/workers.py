"""The package on the executors' Python path, once per Spark application."""

import ctypes
import os
import shutil
import tempfile

import pyarrow as pa

import rinkflow

_shipped = set()
_kept = {}


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


def keep(key, make):
    """What ``make`` returns, kept for the worker's next tasks of the same operator."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release(kept=False):
    """Give the memory that a worker has freed back to the system: workers outlive their tasks.

    What the tasks of another operator ``keep`` is freed first, unless ``kept``.
    """
    if not kept:
        _kept.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
