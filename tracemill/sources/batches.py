"""Tables that grow batch by batch, where a batch is there as a whole or not at all.

A batch writes its parts (one folder each) to a staging place that nobody reads,
then one small manifest is renamed into the list of commits. Readers read the
folders that manifests name, so a run that dies between two parts leaves
nothing to see, and a batch that is committed again under its id changes
nothing. One writer at a time works on a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tracemill.sources.readers import path_exists


class BatchTable:
    """``root`` may be on any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _manifests(self) -> list[dict]:
        folder = f"{self.root}/commits"
        if not path_exists(self.spark, folder):
            return []
        return [json.loads(r["value"]) for r in self.spark.read.text(folder, wholetext=True).collect()]

    def committed(self) -> set[str]:
        """Ids of all batches so far and of what they hold, merged ones included."""
        return {i for m in self._manifests() for i in (m["batch"], *m["replaces"], *m["holds"])}

    def batches(self) -> list[str]:
        """Batches that readers see."""
        found = self._manifests()
        return sorted({m["batch"] for m in found} - {i for m in found for i in m["replaces"]})

    def folders(self, part: str) -> list[str]:
        """Where the rows of a part are; batches that a later one replaces don't count."""
        found = self._manifests()
        gone = {i for m in found for i in m["replaces"]}
        return sorted(self._place(part, m["stage"]) for m in found if m["batch"] not in gone and part in m["parts"])

    def _place(self, part: str, stage: str) -> str:
        return f"{self.root}/{part}/batch={stage}"

    def commit(self, batch: str, parts: dict[str, Callable[[dict[str, str]], None]], holds: tuple[str, ...] = (),
               replaces: tuple[str, ...] = ()) -> bool:
        """Write every part and make them visible together. A part is a function that
        gets the folders of all parts; those before it are written already.

        ``holds`` names what is in the batch, ``replaces`` the batches whose rows it stands for.
        Returns whether this call did so: a batch that is there already is left alone."""
        if batch in self.committed():
            return False
        stage = uuid.uuid4().hex
        places = {name: self._place(name, stage) for name in parts}
        for write in parts.values():
            write(places)
        manifest = {"batch": batch, "stage": stage, "parts": list(parts), "holds": sorted(holds), "replaces": sorted(replaces)}
        draft, fs = self._fs(f"{self.root}/drafts/{stage}.json")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        target, _ = self._fs(f"{self.root}/commits/{uuid.uuid5(uuid.NAMESPACE_URL, batch).hex}.json")
        fs.mkdirs(target.getParent())
        return not fs.exists(target) and fs.rename(draft, target)

    def read(self, part: str, schema: StructType, kind: str = "parquet") -> DataFrame:
        """Rows of a part over all batches; folders that the part itself is dealt to are columns."""
        folders = self.folders(part)
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).format(kind).option("basePath", f"{self.root}/{part}").load(folders)
        return rows.select(schema.fieldNames())
