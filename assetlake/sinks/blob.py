"""Whole-object writes from executor tasks, on any file system pyarrow knows
(local paths, file://, s3://, gs://, hdfs://, ...).

Local files go through a temporary name and an atomic rename; object stores
get a single PUT, which is atomic per object. Either way a retried task
rewrites the same object and a reader never sees a partial one.
"""

from __future__ import annotations

import os
import re
import uuid

from pyarrow import fs as pafs


def _resolve(uri: str):
    if re.match("file:", uri):
        uri = re.sub("^file:/*", "/", uri)
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


def shared_root(spark, root: str) -> str:
    """``root`` as a path that every executor reaches.

    On a cluster a path without a scheme belongs to the default file system of the session; where
    that is the machine's own disk, only a folder under ``spark.checkpoint.dir`` is known to be shared.
    """
    if re.match(r"[a-z][a-z0-9+.-]+:", root) or re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return root
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if not default.startswith("file:"):
        return default.rstrip("/") + "/" + root.lstrip("/")
    shared = re.sub("^file:/*", "/", spark.conf.get("spark.checkpoint.dir", ""))
    if shared and os.path.abspath(root).startswith(shared.rstrip("/") + "/"):
        return root
    raise ValueError(f"{root}: name a store that all executors share")


def join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/")] + [p.strip("/") for p in parts])


def put(uri: str, data: bytes) -> None:
    fs, path = _resolve(uri)
    parent = path.rsplit("/", 1)[0]
    if isinstance(fs, pafs.LocalFileSystem):
        os.makedirs(parent, exist_ok=True)
        tmp = f"{parent}/.{path.rsplit('/', 1)[-1]}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "wb") as f:
            f.write(data)
        os.replace(tmp, path)
        return
    fs.create_dir(parent, recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)


def exists(uri: str) -> bool:
    fs, path = _resolve(uri)
    return fs.get_file_info(path).type != pafs.FileType.NotFound
