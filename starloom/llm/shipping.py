"""Makes the package importable in Python workers that don't have it on their path."""

import atexit
import os
import shutil
import tempfile
import zipfile

import starloom

_shipped = set()


def ship(spark):
    """Adds the package's modules to the application, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(starloom.__file__))
    folder = tempfile.mkdtemp(prefix="starloom-modules-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "starloom_modules.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in sorted(os.walk(top)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(base, name)
                z.write(full, os.path.join("starloom", os.path.relpath(full, top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
