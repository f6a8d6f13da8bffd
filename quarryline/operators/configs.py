"""YAML configurations of bundles: what they state, whether they can be read, and findings by severity."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructType

from quarryline.functions.text import token_estimate
from quarryline.session import stored
from quarryline.sources.readers import loaded

# Keys and tags that are read, limits, endings and names of files.
INCLUDE, REFERENCE, MODEL, TOOLS = "!include", "config_path", "model", "tools"
GENERATE, OUTPUT, THINKING, BUDGET = "generate_content_config", "max_output_tokens", "thinking_config", "thinking_budget"
MOST_OUTPUT, MOST_THINKING, MOST_BYTES, PROMPT_SHARE = 32768, 16384, 3 * 1024**3, 0.15
ROOT_NAMES = ["agent.yaml", "agent.yml"]
ALLOWED = [".yaml", ".yml", ".md", ".txt", ".py", ".json", ".safetensors"]

LIST = ArrayType(StringType())
FACTS = StructType().add("readable", BooleanType()).add("error", StringType()).add("model", StringType()).add("limits_ok", BooleanType()).add("models", LIST).add("tools", LIST).add("references", LIST)


class Reference(str):
    """The text of an include tag."""


def parts(value: object, key: str = "") -> Iterator[tuple[str, object]]:
    """Each value inside nested mappings and lists with the key that it stands under, the whole value first."""
    yield key, value
    if isinstance(value, dict):
        for k, v in value.items():
            yield from parts(v, str(k))
    elif isinstance(value, list):
        for v in value:
            yield from parts(v, key)


def limits_hold(value: object) -> bool:
    """Whether the token limits of a configuration are in range; a generation section must be a mapping."""
    if not isinstance(value, dict) or GENERATE not in value:
        return True
    section = value[GENERATE]
    if not isinstance(section, dict):
        return False
    thinking = section.get(THINKING)
    budget = thinking.get(BUDGET) if isinstance(thinking, dict) else None
    output = section.get(OUTPUT)
    return not (isinstance(output, int) and not 0 < output <= MOST_OUTPUT) and not (isinstance(budget, int) and not 0 <= budget <= MOST_THINKING)


def stated(text: str) -> tuple:
    """The facts of one YAML text."""
    try:
        value = loaded(text, {INCLUDE: Reference})
    except Exception as error:  # whatever the parser raises is the text's fault
        return False, f"{type(error).__name__}: {error}"[:120], None, False, [], [], []
    inside = list(parts(value))
    models = sorted({str(v) for k, v in inside if k == MODEL and isinstance(v, str)})
    tools = sorted({t for k, v in inside if k == TOOLS and isinstance(v, list) for t in v if isinstance(t, str)})
    references = sorted({str(v) for k, v in inside if isinstance(v, Reference) or k == REFERENCE and isinstance(v, str)})
    own = str(value[MODEL]) if isinstance(value, dict) and MODEL in value else None
    return True, None, own, limits_hold(value), models, tools, references


@F.pandas_udf(FACTS)
def yaml_facts(texts: pd.Series) -> pd.DataFrame:
    """What each YAML text states; all null for null texts."""
    rows = [(None,) * 7 if t is None else stated(t) for t in texts]
    return pd.DataFrame(rows, columns=["readable", "error", "model", "limits_ok", "models", "tools", "references"], dtype=object)


def extension(path: Column) -> Column:
    """The ending of a file's name with its dot, in lower case; empty for names that only begin with one."""
    return F.regexp_extract(F.lower(F.substring_index(path, "/", -1)), r"[^.](\.[^.]*)$", 1)


@F.pandas_udf(StringType())
def resolved_path(paths: pd.Series, references: pd.Series) -> pd.Series:
    """Where a reference of a file leads, inside the bundle's root."""
    return pd.Series([posixpath.normpath(posixpath.join(posixpath.dirname(p), r)) for p, r in zip(paths, references, strict=True)], dtype=object)


def bundle_findings(files: DataFrame, tools: list[str] | None = None, context_tokens: int = 32768, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(bundle, severity, check, detail) of what is wrong with each bundle's files; nothing for a bundle in order.

    files: (bundle, path, length, content), content needed of YAML and Markdown files. Errors: not just one root configuration,
    YAML that can't be read (each file) or isn't there, references that lead to no file of the bundle, not just one model,
    forbidden endings, too many bytes. Warnings: tools outside the known ones, hidden or cache files, weights without a
    configuration beside them, prompts (Markdown) of PROMPT_SHARE of the context or more.
    """
    ext = extension(F.col("path"))
    yaml = ext.isin(".yaml", ".yml")
    files = files.select("bundle", "path", "length", "content").repartition("bundle")
    rows = files.select("bundle", "path", "length", ext.alias("ext"), F.when(ext == ".md", token_estimate(F.coalesce("content", F.lit("")))).otherwise(0).alias("tokens"), yaml_facts(F.when(yaml, F.coalesce("content", F.lit("")))).alias("y"))
    rows = stored(rows, "bundle_files")  # each check below reads them; texts are parsed once
    folder = F.regexp_extract("path", "^(.*/)?[^/]*$", 1)
    found = lambda df, severity, check, detail: df.select("bundle", F.lit(severity).alias("severity"), F.lit(check).alias("check"), detail.alias("detail"))
    path = F.col("path")
    hidden = F.exists(F.split("path", "/"), lambda p: F.startswith(p, F.lit(".")) | (p == "__pycache__"))
    each = [
        found(rows.where("not y.readable"), "error", "YAML parses", F.concat(path, F.lit(": "), F.col("y.error"))),
        found(rows.where(~F.col("ext").isin(ALLOWED)), "error", "allowed file types", path),
        found(rows.where(hidden), "warning", "no hidden / cache files", path),
    ]
    sums = rows.groupBy("bundle").agg(
        F.count_if(path.isin(ROOT_NAMES)).alias("roots"), F.count_if("y.readable").alias("readable"), F.sum("length").alias("bytes"), F.sum("tokens").alias("tokens")
    )
    models = rows.select("bundle", F.explode("y.models").alias("model")).groupBy("bundle").agg(F.count_distinct("model").alias("models"))
    sums = sums.join(models, "bundle", "left").withColumn("models", F.coalesce("models", F.lit(0)))
    number = lambda c: F.col(c).cast("string")
    each += [
        found(sums.where("roots <> 1"), "error", "exactly one root config", number("roots")),
        found(sums.where("readable = 0"), "error", "YAML files parse", number("readable")),
        found(sums.where("models <> 1"), "error", "single base model", number("models")),
        found(sums.where(F.col("bytes") > most_bytes), "error", "size limit", number("bytes")),
        found(sums.where(F.col("tokens") >= PROMPT_SHARE * context_tokens), "warning", "prompt size vs context", number("tokens")),
    ]
    references = rows.select("bundle", "path", F.explode("y.references").alias("reference")).withColumn("target", resolved_path("path", "reference"))
    there = rows.select("bundle", F.col("path").alias("target"))
    each.append(found(references.join(there, ["bundle", "target"], "left_anti"), "error", "references resolve inside the bundle", F.concat(path, F.lit(" → "), F.col("reference"))))
    if tools is not None:
        used = rows.select("bundle", F.explode("y.tools").alias("tool")).distinct()
        each.append(found(used.where(~F.col("tool").isin(tools)), "warning", "only verified tools referenced", F.col("tool")))
    beside = rows.where(path.rlike(r"(^|/)adapter_config\.json$")).select("bundle", folder.alias("folder")).distinct()
    each.append(found(rows.where("ext = '.safetensors'").withColumn("folder", folder).join(beside, ["bundle", "folder"], "left_anti"), "warning", "adapter config next to weights", path))
    return reduce(DataFrame.unionByName, each)
