"""Where outputs are uploaded to."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import SparkSession

from .state import write_atomic

CONTENT_TYPE = "text/plain; charset=utf-8"


@dataclass(frozen=True)
class Object:
    bucket: str
    key: str
    body: bytes
    content_type: str = CONTENT_TYPE


class Publisher(Protocol):
    def put(self, obj: Object) -> str:
        """Upload, and return the URI."""


@dataclass
class Memory:
    """For tests. `failing`: URIs whose upload fails."""

    objects: dict[str, Object] = field(default_factory=dict)
    failing: set[str] = field(default_factory=set)
    puts: list[str] = field(default_factory=list)

    def put(self, obj: Object) -> str:
        uri = f"s3://{obj.bucket}/{obj.key}"
        self.puts.append(uri)
        if uri in self.failing:
            raise OSError(f"put {uri}: refused")
        self.objects[uri] = obj
        return uri


@dataclass
class Folder:
    """Objects as files below a folder, for runs without an object store."""

    root: str

    def put(self, obj: Object) -> str:
        write_atomic(os.path.join(self.root, obj.bucket, obj.key), obj.body)
        return f"s3://{obj.bucket}/{obj.key}"


@dataclass
class Hadoop:
    """Objects through Hadoop's s3a file system, with its credential chain; the connector's jar must be on Spark's class path.

    Hadoop's streams take no content type for one object, so it is set for the connector as a whole.
    """

    spark: SparkSession
    region: str = ""
    endpoint: str = ""
    path_style: bool = False
    scheme: str = "s3a"

    def put(self, obj: Object) -> str:
        jvm = self.spark._jvm
        conf = jvm.org.apache.hadoop.conf.Configuration(self.spark._jsc.hadoopConfiguration())
        conf.set("fs.s3a.object.content.type", obj.content_type)
        for key, value in (("fs.s3a.endpoint.region", self.region), ("fs.s3a.endpoint", self.endpoint)):
            if value:
                conf.set(key, value)
        conf.set("fs.s3a.path.style.access", str(self.path_style).lower())
        path = jvm.org.apache.hadoop.fs.Path(f"{self.scheme}://{obj.bucket}/{obj.key}")
        try:
            out = path.getFileSystem(conf).create(path, True)
            out.write(bytearray(obj.body))
            out.close()
        except Exception as e:
            raise OSError(f"put s3://{obj.bucket}/{obj.key}: {str(e).splitlines()[0][:300]}") from None
        return f"s3://{obj.bucket}/{obj.key}"
