"""Opening the same path from Python that Spark opens through Hadoop."""

from __future__ import annotations

import re


def locate(path: str):
    """(file system, path inside it) for a path or URI as Spark writes them."""
    from pyarrow import fs

    path = re.sub("^file:/+", "/", path)
    path = re.sub("^s3[an]://", "s3://", path)
    return fs.FileSystem.from_uri(path)


def ship_with_tasks(module) -> None:
    """Send the module's code with the plan, so that workers need no installed package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(module)
