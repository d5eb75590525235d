"""A folder of tables that is replaced as a whole.

Each build writes a folder of its own below ``versions``. A small manifest names the one that
readers use; it is replaced last, by one rename, so readers see the former tables or the new
ones and never some of each. A build that stops midway leaves the former version as it was.
The version before the current one stays for readers that began on it; older ones go.
One build at a time may run on a folder: if the manifest has changed since a build began,
the build fails at its end and changes nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MANIFEST = "current.json"
VERSIONS = "versions"


def _path(spark: SparkSession, *parts: str):
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, root: str) -> dict:
    """What the manifest says: ``version`` and ``former``, or nothing where there is none."""
    path, files = _path(spark, root.rstrip("/"), MANIFEST)
    if not files.exists(path):
        return {}
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def folder_of(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{VERSIONS}/{version}"


def current(spark: SparkSession, root: str) -> str:
    """The folder whose tables are to be read: that of the current version, or ``root`` itself."""
    version = manifest(spark, root).get("version")
    return folder_of(root, version) if version else root.rstrip("/")


@contextmanager
def new_version(spark: SparkSession, root: str) -> Iterator[str]:
    """A fresh folder that becomes the current version if the block ends well, else goes away."""
    before = manifest(spark, root)
    version = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"
    try:
        yield folder_of(root, version)
        if manifest(spark, root) != before:
            raise RuntimeError(f"another build has replaced the tables under {root}")
        _switch(spark, root, {"version": version, "former": before.get("version")})
    except BaseException:
        delete(spark, folder_of(root, version))
        raise
    if before.get("former"):
        delete(spark, folder_of(root, before["former"]))


def _switch(spark: SparkSession, root: str, content: dict) -> None:
    """Put the manifest in place by one rename over the old one."""
    fresh, files = _path(spark, root.rstrip("/"), f".{MANIFEST}-{content['version']}")
    stream = files.create(fresh, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    final, _ = _path(spark, root.rstrip("/"), MANIFEST)
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext
    context.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(fresh, final, options)


def delete(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder inside an unfinished version; False if there is none."""
    old, files = _path(spark, source)
    new, _ = _path(spark, target)
    if not files.exists(old):
        return False
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"could not rename {source} to {target}")
    return True
