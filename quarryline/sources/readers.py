"""Sources: tasks, graphs, vectors, notebooks, test reports, archives, inventories, texts, registries, configuration."""

from __future__ import annotations

import functools
import io
import json
import os
import tarfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a task.
TASK_FIELDS = ["instance_id", "repo", "base_commit", "problem_statement", "hints_text", "patch", "test_patch", "created_at"]
#: A task, a graph and a vector to try things on; the task's diff removes a surplus one.
MOCK_TASK = {
    "instance_id": "mock_utils_001", "repo": "mock/utils-lib", "base_commit": "0" * 40,
    "problem_statement": "The add_numbers function has an off-by-one error. add_numbers(2, 3) returns 6 instead of 5.", "hints_text": "Check the return statement.",
    "patch": "diff --git a/utils.py b/utils.py\n--- a/utils.py\n+++ b/utils.py\n@@ -6,1 +6,1 @@\n-    return a + b + 1  # Bug: off-by-one error\n+    return a + b\n",
    "test_patch": "diff --git a/test_utils.py b/test_utils.py\n--- /dev/null\n+++ b/test_utils.py\n@@ -0,0 +1,2 @@\n+def test_add():\n+    assert add_numbers(2, 3) == 5\n",
    "created_at": "2026-01-01T00:00:00Z",
}
REGISTRY = "notebook_name string, author string, kaggle_url string, lb_score double, capture_date string, local_path string, analysis_status string, prompt_strategy string, agent_architecture string, adapter_details string, key_techniques array<string>, cv_score double, cv_lb_gap double, leak_detected boolean"

TASK = ", ".join(f"{f} string" for f in TASK_FIELDS)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any that its pattern names, is there, on any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(p) or len(store.globStatus(p) or []) > 0


def first_path(spark: SparkSession, *paths: str) -> str:
    """The first path that exists, else the first."""
    return next((p for p in paths if exists(spark, p)), paths[0])


def tasks(spark: SparkSession, path: str) -> DataFrame:
    """One task a line; unknown keys are dropped, missing and null ones are empty; a missing file has no tasks; bad JSON fails."""
    if not exists(spark, path):
        return spark.createDataFrame([], TASK)
    rows = spark.read.schema(TASK).option("mode", "FAILFAST").json(path)
    return rows.select(*(F.coalesce(f, F.lit("")).alias(f) for f in TASK_FIELDS))


def graphs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of node-link JSON files, by file name; edges under edges or links, with alias keys."""
    schema = "nodes array<struct<id:string,name:string,text:string>>, {0} array<struct<source:string,target:string,src:string,dst:string,type:string,key:string>>"
    both = schema.format("edges") + ", " + schema.format("links").split("text:string>>, ")[1]
    rows = spark.read.schema(both).option("multiLine", True).json(path).withColumn("graph_id", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1))
    nodes = rows.select("graph_id", F.explode("nodes").alias("n")).select("graph_id", "n.*")
    edges = rows.select("graph_id", F.explode(F.coalesce("edges", "links")).alias("e"))
    return nodes, edges.select("graph_id", F.coalesce("e.source", "e.src").alias("source"), F.coalesce("e.target", "e.dst").alias("target"), "e.type", "e.key")


def vectors(spark: SparkSession, path: str) -> DataFrame:
    """(graph_id, node_id, vec) of NPZ files; files that can't be read have none, and a path that isn't there has no files."""
    if not exists(spark, path):
        return spark.createDataFrame([], "graph_id string, node_id string, vec array<float>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch.path, batch.content, strict=True):
                try:
                    with np.load(io.BytesIO(content), allow_pickle=False) as data:
                        rows = [(os.path.basename(name).rpartition(".")[0], k, data[k].astype(np.float32).ravel()) for k in data.files]
                except (ValueError, OSError, zipfile.BadZipFile):
                    rows = []
                yield pd.DataFrame(rows, columns=["graph_id", "node_id", "vec"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "graph_id string, node_id string, vec array<float>")


def notebook_cells(spark: SparkSession, path: str) -> DataFrame:
    """(path, index, cell_type, source) of notebooks; a source may be a string or a list of strings."""
    rows = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    cells = F.from_json(F.get_json_object("value", "$.cells"), "array<string>")
    rows = rows.select("path", F.posexplode(cells).alias("index", "cell"))
    source = F.get_json_object("cell", "$.source")
    listed = F.from_json(source, "array<string>")
    return rows.select("path", "index", F.get_json_object("cell", "$.cell_type").alias("cell_type"), F.when(F.startswith(source, F.lit("[")), F.array_join(listed, "")).otherwise(F.coalesce(source, F.lit(""))).alias("source"))


def junit_counts(xml: DataFrame, column: str) -> DataFrame:
    """xml with tests, failures, errors, skipped and passed; text that is no report counts nothing."""
    safe = F.when(F.col(column).rlike(r"(?s)^\s*<.*<testsuite\b.*>\s*$|^\s*<testsuite\b.*>\s*$"), F.col(column)).otherwise("<a/>")
    names = ("tests", "failures", "errors", "skipped")
    told = F.xpath_string(safe, F.lit("concat(" + ", ' ', ".join(f"sum(//testsuite/@{k})" for k in names) + ")"))
    whole = lambda k: F.nanvl(F.get(F.split("_told", " "), F.lit(k)).cast("double"), F.lit(0.0))
    rows = xml.select("*", F.inline(F.array(F.struct(told.alias("_told")))))  # each report is read once
    out = rows.withColumns({n: F.least(F.greatest(whole(k), F.lit(-2147483648.0)), F.lit(2147483647.0)).cast("int") for k, n in enumerate(names)}).drop("_told")
    return out.withColumn("passed", F.greatest(F.lit(0), F.col("tests") - F.col("failures") - F.col("errors") - F.col("skipped")))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, ext, length) of all files below a folder; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.select("path", F.regexp_extract("path", r"(\.[^./]+)$", 1).alias("ext"), "length")


def archive_texts(spark: SparkSession, path: str, suffix: str = ".py", most_bytes: int | None = None) -> DataFrame:
    """(archive, name, text) of members of zip and tar files that end in suffix; if most_bytes is given, of those no larger."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch.path, batch.content, strict=True):
                out = []
                if zipfile.is_zipfile(io.BytesIO(content)):
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        out = [(name, i.filename, z.read(i).decode("utf-8", "replace")) for i in z.infolist() if i.filename.endswith(suffix) and (most_bytes is None or i.file_size <= most_bytes)]
                else:
                    try:
                        with tarfile.open(fileobj=io.BytesIO(content)) as t:
                            out = [(name, m.name, t.extractfile(m).read().decode("utf-8", "replace")) for m in t if m.isfile() and m.name.endswith(suffix) and (most_bytes is None or m.size <= most_bytes)]
                    except tarfile.TarError:
                        out = []
                yield pd.DataFrame(out, columns=["archive", "name", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, name string, text string")


def parsed(value: str) -> bool | int | float | str:
    """A setting's text as boolean, integer, number or itself."""
    if value.lower() in ("true", "false"):
        return value.lower() == "true"
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            pass
    return value


def loaded(text: str, tags: dict[str, type] | None = None) -> object:
    """The value of a YAML text (JSON is YAML). Tags that are not known stand for their value's text; if tags are given, only they do, made by
    their types, and others make the text unreadable. The library's C parser reads first where it is built; what it can't read is the
    Python parser's to judge."""
    try:
        import yaml
    except ImportError:  # without the library only JSON is read
        return json.loads(text or "null")
    quick, careful = yaml_readers(None if tags is None else tuple(tags.items()))
    if quick:
        try:
            return yaml.load(text, quick)  # noqa: S506  a safe loader
        except Exception:  # noqa: S110  judged below
            pass
    return yaml.load(text, careful)  # noqa: S506  a safe loader


@functools.cache
def yaml_readers(tags: tuple[tuple[str, type], ...] | None) -> list[type | None]:
    """The C and the Python loader for some tags, made once; no C loader where the library has none."""
    import yaml

    def plain(loader: yaml.Loader, _: str, node: yaml.Node) -> object:
        return loader.construct_scalar(node) if isinstance(node, yaml.ScalarNode) else loader.construct_sequence(node) if isinstance(node, yaml.SequenceNode) else loader.construct_mapping(node)

    out = []
    for base in (getattr(yaml, "CSafeLoader", None), yaml.SafeLoader):
        reader = base and type("Reader", (base,), {})
        if reader and tags is None:
            reader.add_multi_constructor("!", plain)
        for tag, kind in (tags or ()) if reader else ():
            reader.add_constructor(tag, lambda loader, node, kind=kind: kind(loader.construct_scalar(node) if isinstance(node, yaml.ScalarNode) else node.value))
        out.append(reader)
    return out


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, from any store that Spark reads; a missing file raises."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.text(path, wholetext=True).first()[0]


def json_object(spark: SparkSession, path: str) -> dict:
    """A JSON file's object; empty if the file is missing, broken or holds something else."""
    try:
        value = json.loads(read_text(spark, path))
    except (FileNotFoundError, ValueError):
        return {}
    return value if isinstance(value, dict) else {}


def walked(value: object, at: str = "") -> Iterator[tuple[str, str, object]]:
    """(path, key, leaf) of all leaves of nested mappings and lists."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from walked(v, f"{at}/{k}")
    elif isinstance(value, list):
        for k, v in enumerate(value):
            yield from walked(v, f"{at}/{k}")
    else:
        yield at, at.rpartition("/")[2], value


def yaml_leaves(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, path, name, value, error) of YAML texts, a row a leaf; a text that can't be read gives one row with its error."""
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, t in zip(batch.key, batch.text, strict=True):
                try:
                    out += [(k, p, n, None if v is None else str(v), None) for p, n, v in walked(loaded(t or ""))]
                except Exception as e:  # whatever the parser raises is the text's fault
                    out.append((k, None, None, None, type(e).__name__))
            yield pd.DataFrame(out, columns=["key", "path", "name", "value", "error"], dtype=object)

    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).repartition("key", "text")  # a small file is one task's, its texts are many tasks' work
    return rows.mapInPandas(run, f"key {kind}, path string, name string, value string, error string").withColumnRenamed("key", key)


def flattened(config: dict, sections: tuple[str, ...] = ("cv", "tracking")) -> dict:
    """A configuration with the keys of some sections at its top."""
    out = dict(config)
    for name in sections:
        if isinstance(out.get(name), dict):
            out.update(out[name])
    return out


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Peer solutions of a YAML registry; older names of fields are read too, a missing file or another shape has none."""
    value = loaded(read_text(spark, path)) if exists(spark, path) else None
    entries = value.get("solutions", []) if isinstance(value, dict) else []
    rows = []
    for e in entries if isinstance(entries, list) else []:
        if not isinstance(e, dict):
            continue
        text = lambda *names, empty="", e=e: next((str(e[n]) for n in names if e.get(n)), empty)
        number = lambda n, empty=None, e=e: empty if e.get(n) is None else float(e[n])
        techniques = e.get("key_techniques")
        rows.append(
            (
                text("notebook_name", "name"), text("author"), text("kaggle_url"), number("lb_score", 0.0), text("capture_date"), text("local_path"), text("analysis_status", "status", empty="pending"),
                text("prompt_strategy", empty=None), text("agent_architecture", empty=None), text("adapter_details", empty=None), [str(t) for t in techniques] if isinstance(techniques, list) else [],
                number("cv_score"), number("cv_lb_gap"), None if e.get("leak_detected") is None else bool(e["leak_detected"]),
            )
        )
    return spark.createDataFrame(rows, REGISTRY)


def mock_tasks(spark: SparkSession, count: int = 1) -> DataFrame:
    """The mock task, and more of the same under other names and repositories."""
    rows = [MOCK_TASK | ({"instance_id": f"mock_task_{k:03d}", "repo": f"mock/repo_{k}"} if k else {}) for k in range(count)]
    return spark.createDataFrame([tuple(r[f] for f in TASK_FIELDS) for r in rows], TASK)


def mock_graph(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, vectors) of the mock task: one node, no edge, a vector of 256 zeros."""
    nodes = spark.createDataFrame([("mock_utils_001", "utils.add_numbers", "add_numbers", "utils.py")], "graph_id string, id string, name string, filepath string")
    edges = spark.createDataFrame([], "graph_id string, source string, target string, type string, key string")
    return nodes, edges, nodes.select("graph_id", F.col("id").alias("node_id"), F.array_repeat(F.lit(0.0).cast("float"), 256).alias("vec"))


def described_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Tasks of any JSON lines: missing fields empty, the repository from the id where it is missing, created_ts where the time can be read."""
    rows = tasks(spark, path)
    own = F.regexp_replace("instance_id", "_[^_]*$", "")  # what stands before the last underscore
    return rows.withColumns({"repo": F.when(F.col("repo") == "", own).otherwise(F.col("repo")), "created_ts": F.try_to_timestamp("created_at")})


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(name, size) of a CSV inventory with a header."""
    return spark.read.schema("name string, size long").option("header", True).csv(path)


def by_extension(files: DataFrame, root: str, depth: int) -> DataFrame:
    """(ext, n, bytes) of the four commonest extensions among files (path, ext, length) at most depth folders below root."""
    below = F.size(F.split(F.replace("path", F.lit(root.rstrip("/") + "/"), F.lit("")), "/")) - 1
    counts = files.where(F.contains("path", F.lit(root.rstrip("/") + "/")) & (below <= depth)).groupBy("ext").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))
    return counts.orderBy(F.desc("n"), "ext").limit(4)


def texts(spark: SparkSession, path: str, extensions: list[str], most_bytes: int | None = None) -> DataFrame:
    """(path, text) of all files below a folder with some extensions; if most_bytes is given, of those no larger."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    rows = rows.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(extensions))
    rows = rows if most_bytes is None else rows.where(F.col("length") <= most_bytes)
    return rows.select("path", F.decode("content", "UTF-8").alias("text"))


def any_table(spark: SparkSession, path: str) -> DataFrame:
    """JSON, JSON lines (compressed too), CSV, Parquet, NPY or NPZ by the path's ending. Pickle files are not read, for they run code."""
    name = path.lower().removesuffix(".gz")
    if name.endswith((".npz", ".npy")):
        return vectors(spark, path) if name.endswith(".npz") else arrays(spark, path)
    if name.endswith(".parquet"):
        return spark.read.parquet(path)
    if name.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    if name.endswith((".jsonl", ".json")):
        return spark.read.option("multiLine", name.endswith(".json")).json(path)
    raise ValueError(f"no reader for {path}")


def arrays(spark: SparkSession, path: str) -> DataFrame:
    """(path, row, vec) of NPY files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch.path, batch.content, strict=True):
                data = np.load(io.BytesIO(content), allow_pickle=False)
                data = data.reshape(len(data), -1).astype(np.float32) if data.ndim else data.reshape(1, 1)
                yield pd.DataFrame({"path": name, "row": range(len(data)), "vec": list(data)})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, row long, vec array<float>")


def facts(texts: DataFrame, key: str, text: str, patterns: dict[str, str], most: int = 3) -> DataFrame:
    """(key, fact, line_no, line): the first lines, at most so many, that match each pattern, in any case."""
    lines = texts.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).where(F.trim("line") != "")
    named = F.array_compact(F.array(*(F.when(F.col("line").rlike("(?i)" + p), F.lit(n)) for n, p in patterns.items())))
    rows = lines.select(key, F.explode(named).alias("fact"), F.struct("line_no", F.trim("line").alias("line")).alias("x"))
    first = rows.groupBy(key, "fact").agg(F.slice(F.sort_array(F.collect_list("x")), 1, most).alias("x"))
    return first.select(key, "fact", F.explode("x").alias("x")).select(key, "fact", "x.*")


def included(text: Column, files: dict[str, str]) -> Column:
    """Each !include directive replaced by its file's text, from a small set of files; a path that climbs or is not there stays, for a check to see."""
    for name, content in files.items():
        if ".." not in name.split("/"):
            text = F.regexp_replace(text, rf"!include\s+\Q{name}\E(?=\s|$)", F.lit(content.replace("\\", "\\\\").replace("$", "\\$")))
    return text


def settings(text: str, environment: dict[str, str], prefix: str) -> dict:
    """A configuration (YAML or JSON text) with variables of a prefix laid over it; two underscores go one level down."""
    out = loaded(text or "{}")
    out = out if isinstance(out, dict) else {}
    for name, value in sorted(environment.items()):
        if name.startswith(prefix):
            *path, last = name[len(prefix) :].lower().split("__")
            at = out
            for part in path:
                if not isinstance(at.get(part), dict):
                    at[part] = {}
                at = at[part]
            at[last] = parsed(value)
    return out


def section(config: dict, name: str) -> dict:
    """A section, or the whole where there is none."""
    own = config.get(name)
    return own if isinstance(own, dict) else config
