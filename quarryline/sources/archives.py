"""Files inside archives and folders, and code graphs of any form, read part by part."""

from __future__ import annotations

import tarfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarryline.sources.readers import exists

ZIP = (b"PK\x03\x04", b"PK\x05\x06")
MEMBER = "archive string, name string, size long, text string"


@dataclass
class Members(InputPartition):
    """Some members of a file: all, or a zip's from first to last in its directory's order."""

    path: str
    name: str
    first: int = 0
    last: int | None = None

    def __post_init__(self) -> None:
        super().__init__(None)


class MemberReader(DataSourceReader):
    """A task reads a zip's run of members, a tar in one pass, or a plain file; it holds one member at a time.

    Paths are opened through Arrow's file systems, on any store that they know and the executors reach.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.most_bytes = int(options["mostbytes"]) if "mostbytes" in options else None
        self.split_bytes = int(options.get("splitbytes", 64 << 20))

    @staticmethod
    def _open(path: str):  # noqa: ANN205
        from pyarrow import fs

        return fs.FileSystem.from_uri(path)

    def partitions(self) -> list[Members]:
        from pyarrow import fs

        store, root = self._open(self.path)
        info = store.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        out = []
        for f in sorted((f for f in found if f.type == fs.FileType.File), key=lambda f: f.path):
            name = f.path[len(root) :].lstrip("/") or f.base_name
            runs = self._runs(store, f) if f.size > self.split_bytes else [(0, None)]
            out += [Members(f.path, name, *run) for run in runs]
        return out

    def _runs(self, store, info) -> list[tuple[int, int | None]]:  # noqa: ANN001
        """Runs of a large zip's members of about split_bytes; other files are one run."""
        with store.open_input_file(info.path) as file:
            if not file.read(4).startswith(ZIP):
                return [(0, None)]
            file.seek(0)
            try:
                sizes = [i.compress_size for i in zipfile.ZipFile(file).infolist()]
            except zipfile.BadZipFile:
                return [(0, None)]
        cuts, held = [0], 0
        for k, size in enumerate(sizes):
            if held and held + size > self.split_bytes:
                cuts.append(k)
                held = 0
            held += size
        return list(zip(cuts, [*cuts[1:], len(sizes)], strict=True))

    def _wanted(self, name: str, size: int) -> bool:
        return name.endswith(self.suffix) and (self.most_bytes is None or size <= self.most_bytes)

    def read(self, partition: Members | None) -> Iterator[tuple]:
        if partition is None:  # there are no files
            return
        text = lambda raw: raw.decode("utf-8", "replace")
        store, _ = self._open(self.path)
        with store.open_input_file(partition.path) as file:
            head = file.read(512)
            file.seek(0)
            if head.startswith(ZIP):
                try:
                    with zipfile.ZipFile(file) as z:
                        for i in z.infolist()[partition.first : partition.last]:
                            if not i.is_dir() and self._wanted(i.filename, i.file_size):
                                yield partition.name, i.filename, i.file_size, text(z.read(i))
                except zipfile.BadZipFile:
                    pass  # broken: what could be read stays
                return
        if head[257:262] == b"ustar" or partition.path.endswith((".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")):
            with store.open_input_stream(partition.path, compression=None) as file:
                try:
                    with tarfile.open(fileobj=file, mode="r|*") as t:
                        for m in t:
                            if m.isfile() and self._wanted(m.name, m.size):
                                yield partition.name, m.name, m.size, text(t.extractfile(m).read())
                except tarfile.TarError:
                    pass  # no tar, or broken off
            return
        with store.open_input_file(partition.path) as file:
            if self._wanted(partition.name, file.size()):
                yield None, partition.name, file.size(), text(file.read())


class ArchiveSource(DataSource):
    """``spark.read.format("members")``: the files of a path, which may be an archive, a folder of archives, or of plain files.

    Options: path; suffix, that names end in; mostBytes, of a member; splitBytes, from which on a zip is read by several tasks.
    """

    @classmethod
    def name(cls) -> str:
        return "members"

    def schema(self) -> str:
        return MEMBER

    def reader(self, schema) -> MemberReader:  # noqa: ANN001
        return MemberReader({k.lower(): v for k, v in self.options.items()})


def members(spark: SparkSession, path: str, suffix: str = ".py", most_bytes: int | None = None, split_bytes: int = 64 << 20) -> DataFrame:
    """(archive, name, size, text) of the files of path that end in suffix; archive is null for plain files of a folder."""
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format("members").option("path", path).option("suffix", suffix).option("splitBytes", split_bytes)
    return (reader if most_bytes is None else reader.option("mostBytes", most_bytes)).load()


def without_common_folders(files: DataFrame) -> DataFrame:
    """files (archive, name, ...) without the folders that all names of an archive begin with, where it has several names.

    Of all names the smallest and the largest share exactly what all share, so two values an archive tell.
    """
    ends = files.groupBy("archive").agg(F.min("name").alias("low"), F.max("name").alias("high"))
    low, high = F.split("low", "/"), F.split("high", "/")
    same = F.size(F.filter(F.sequence(F.lit(1), F.least(F.size(low), F.size(high))), lambda k: F.slice(low, F.lit(1), k) == F.slice(high, F.lit(1), k)))
    shared = F.when(F.col("low") == F.col("high"), F.lit(0)).otherwise(F.least(same, F.size(low) - 1, F.size(high) - 1))
    cut = ends.select(F.col("archive").alias("_archive"), shared.alias("_shared"))
    parts = F.split("name", "/")
    rows = files.join(F.broadcast(cut) if files.select("archive").distinct().limit(10_001).count() <= 10_000 else cut, F.col("archive").eqNullSafe(F.col("_archive")))
    return rows.withColumn("name", F.array_join(F.slice(parts, F.col("_shared") + 1, F.size(parts)), "/")).drop("_archive", "_shared")


def code_files(spark: SparkSession, path: str, suffix: str = ".py", most_bytes: int = 1 << 20, most_files: int | None = None) -> DataFrame:
    """(archive, name, size, text): files of archives and folders without their common folders; if most_files is given, of each archive the first by name."""
    rows = without_common_folders(members(spark, path, suffix, most_bytes))
    if most_files is None:
        return rows
    place = F.row_number().over(Window.partitionBy("archive").orderBy("name"))
    return rows.withColumn("_place", place).where(F.col("_place") <= most_files).drop("_place")


def graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of GraphML files: (graph_id, id, attributes) and (graph_id, source, target, attributes), attributes by their names.

    Elements are rows of Spark's XML source, so a large file is read by several tasks.
    """
    graph = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("graph_id")
    data = "data array<struct<_key:string,_VALUE:string>>"
    rows = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    keys = rows("key", "_id string, `_attr.name` string").select(graph, F.struct("_id", F.coalesce(F.col("`_attr.name`"), F.col("_id"))).alias("k"))
    names = keys.groupBy("graph_id").agg(F.map_from_entries(F.collect_set("k")).alias("names"))  # the few kinds of attributes
    named = lambda d: F.struct(F.coalesce(F.try_element_at("names", d["_key"]), d["_key"]), d["_VALUE"])
    attributes = F.map_from_entries(F.transform(F.coalesce("data", F.array().cast("array<struct<_key:string,_VALUE:string>>")), named)).alias("attributes")
    whole = lambda df: df.join(names, "graph_id", "left").withColumn("names", F.coalesce("names", F.create_map().cast("map<string,string>")))
    nodes = whole(rows("node", f"_id string, {data}").select(graph, F.col("_id").alias("id"), "data"))
    edges = whole(rows("edge", f"_source string, _target string, {data}").select(graph, F.col("_source").alias("source"), F.col("_target").alias("target"), "data"))
    return nodes.select("graph_id", "id", attributes), edges.select("graph_id", "source", "target", attributes)


def any_graphs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, others) of JSON graphs by file name: (graph_id, id, node), (graph_id, source, target, type, key), (graph_id, raw).

    Edges or links may be objects under any of the usual names, pairs, or an object by source of targets: a list, an object of
    targets with their attributes, or one name. Files that are no graph stay as they are in others, as a variant, null if they are
    no JSON; a path that isn't there has nothing.
    """
    if not exists(spark, path):
        none = lambda schema: spark.createDataFrame([], schema)
        return none("graph_id string, id string, node string"), none("graph_id string, source string, target string, type string, key string"), none("graph_id string, raw string").select("graph_id", F.try_parse_json("raw").alias("raw"))
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("graph_id"), F.try_parse_json("value").alias("v"))
    part = lambda p, kind="variant": F.try_variant_get("v", p, kind)
    files = files.select("graph_id", "v", part("$.nodes").alias("nodes"), F.coalesce(part("$.edges"), part("$.links")).alias("edges"))
    # null and objects do not begin with a bracket
    good = F.startswith(F.coalesce(F.to_json("nodes"), F.lit("")), F.lit("[")) & F.col("edges").isNotNull()
    rows = files.withColumn("good", F.coalesce(good, F.lit(False)))
    get = lambda column, names: F.coalesce(*(F.try_variant_get(column, f"$.{n}", "string") for n in names))
    listed = rows.where("good").select("graph_id", "nodes", "edges")
    listed.createOrReplaceTempView("_graphs")
    nodes = spark.sql("SELECT graph_id, x.value AS n FROM _graphs, LATERAL variant_explode(nodes) x")
    nodes = nodes.select("graph_id", F.coalesce(get("n", ["id"]), F.try_variant_get("n", "$", "string")).alias("id"), F.to_json("n").alias("node"))
    one = spark.sql("SELECT graph_id, x.key AS k, x.value AS e FROM _graphs, LATERAL variant_explode(edges) x")
    own = one.where("k is null").select(
        "graph_id", F.coalesce(get("e", ["source", "src", "from", "caller", "u"]), F.try_variant_get("e", "$[0]", "string")).alias("source"), F.coalesce(get("e", ["target", "dst", "to", "callee", "v"]), F.try_variant_get("e", "$[1]", "string")).alias("target"),
        get("e", ["type", "kind", "relation", "label", "edge_type", "rel"]).alias("type"), get("e", ["key"]).alias("key"),
    )
    keyed = one.where("k is not null")
    keyed.createOrReplaceTempView("_keyed")
    two = spark.sql("SELECT graph_id, k, x.key AS target, x.value AS e FROM _keyed, LATERAL variant_explode_outer(e) x")
    two = two.select("graph_id", F.col("k").alias("source"), F.coalesce("target", F.try_variant_get("e", "$", "string")).alias("target"), F.when(F.col("target").isNotNull(), get("e", ["type", "kind", "relation", "label", "edge_type", "rel"])).alias("type"), F.lit(None).cast("string").alias("key"))
    scalar = keyed.where(F.try_variant_get("e", "$[0]", "variant").isNull()).select("graph_id", F.col("k").alias("source"), F.try_variant_get("e", "$", "string").alias("target"), F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("key"))
    scalar = scalar.where(~F.col("target").rlike(r"^[\[{]"))
    edges = own.unionByName(two).unionByName(scalar).where("source is not null and target is not null")
    return nodes, edges, rows.where("not good").select("graph_id", F.col("v").alias("raw"))
