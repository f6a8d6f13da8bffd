"""Text columns: lines, token estimates, path predicates, keywords, JSON of known shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line ends of splitlines, markers of paths, stop words of keywords, tools that cost nothing.
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
OTHER_ENDS = "[\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
TEST_MARKERS = ["test_", "_test.py", "tests/", "test/", "conftest.py", "pytest.ini", "pyproject.toml"]
SCRATCH_MARKERS = ["repro", "scratch", "temp", "tmp_"]
PROTECTED_NAMES = ["conftest.py", "pytest.ini", "setup.cfg", "tox.ini"]
STOP_WORDS = ["the", "and", "that", "this", "with", "from", "for", "have", "were"]


def splitlines(text: Column) -> Column:
    """Lines at every line boundary that Python's splitlines knows; none for the empty text, no empty last line."""
    trimmed = F.regexp_replace(text, f"({LINE_ENDS})\\z", "")
    plain = F.split(F.when(F.endswith(text, F.lit("\n")), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text), "\n")  # most texts have line feeds only
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).when(text.rlike(OTHER_ENDS), F.split(trimmed, LINE_ENDS)).otherwise(plain)


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, rounded up; at least 1 unless empty."""
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.ceil(F.length(text) / 4))).cast("long")


def any_marker(path: Column, markers: list[str]) -> Column:
    found = F.lit(False)
    for m in markers:
        found = found | F.contains(path, F.lit(m))
    return found


def is_test_path(path: Column) -> Column:
    """By markers anywhere in the lower-cased path."""
    return any_marker(F.lower(path), TEST_MARKERS)


def is_scratch_path(path: Column) -> Column:
    return any_marker(F.lower(path), SCRATCH_MARKERS) & ~F.startswith(path, F.lit("/tmp/"))


def is_protected_path(path: Column) -> Column:
    """By the file's name or a folder named tests."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    return F.startswith(name, F.lit("test_")) | F.endswith(name, F.lit("_test.py")) | name.isin(PROTECTED_NAMES) | F.array_contains(parts, "tests")


def keywords(text: Column, count: int = 3) -> Column:
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b([a-z_]{4,})\b"), F.lit(1)), lambda w: ~w.isin(STOP_WORDS))
    return F.when(F.size(words) == 0, F.lit("issue")).otherwise(F.array_join(F.slice(words, 1, count), ", "))


def sub_tokens(name: Column) -> Column:
    """Parts of identifiers in camel or snake case, lower-cased."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"([A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+)"), F.lit(1)), F.lower)


def json_string(text: Column) -> Column:
    """A JSON string in ASCII: all else is escaped, by UTF-16 units."""
    plain = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for a, b in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        plain = F.replace(plain, F.lit(a), F.lit(b))
    units = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(....)", r"\\u$1")
    other = F.array_join(F.transform(F.split(plain, ""), lambda c: F.when(c.rlike("[^ -~]"), units(c)).otherwise(c)), "")
    return F.concat(F.lit('"'), F.when(~text.rlike(r'[^ !#-\[\]-~]'), text).when(text.rlike(r"[^\x00-\x7e]|[\x00-\x07\x0b\x0e-\x1f]"), other).otherwise(plain), F.lit('"'))


def stripped(text: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(text, r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+\z", "")


def is_test_file(path: Column) -> Column:
    """By folders and names, in lower case; the stricter of the three readings."""
    low = F.lower(path)
    return low.rlike(r"(^|/)(tests?|testing)/|(^|/)test_[^/]*\.py\z") | F.endswith(low, F.lit("_test.py")) | F.endswith(low, F.lit("conftest.py"))


def mentioned(text: Column, needles: Column) -> Column:
    """Whether any needle of three or more characters stands in the text as a word, in any case."""
    quoted = lambda n: F.concat(F.lit(r"(?i)(?<![\w/])\Q"), n, F.lit(r"\E(?![\w])"))
    return F.exists(F.filter(needles, lambda n: F.length(n) >= 3), lambda n: F.regexp_like(text, quoted(n)))


def substituted(template: Column, variables: dict[str, Column | str]) -> Column:
    """{key} replaced by its value, key after key in the order given; a value may bring in a later key."""
    for key, value in variables.items():
        template = F.replace(template, F.lit("{" + key + "}"), value if isinstance(value, Column) else F.lit(value))
    return template


def safe_int(value: Column, default: int = 0) -> Column:
    """A whole number from text or number, the default where there is none; fractions of numbers are cut, of texts are not read."""
    return F.coalesce(F.when(value.rlike(r"^\s*[+-]?\d+\s*$"), F.try_to_number(F.trim(value), F.lit("S999999999999999999")).cast("long")), F.lit(default))


def version_parts(version: Column) -> Column:
    """struct(major, minor, patch) of a version with or without v; null if it isn't three numbers."""
    clean = F.trim(F.regexp_replace(version, "^v+", ""))
    part = lambda k: F.try_element_at(F.split(clean, r"\."), F.lit(k)).cast("int")
    return F.when(clean.rlike(r"^\d+\.\d+\.\d+$"), F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")))


def bumped(version: Column, what: str) -> Column:
    """The next major, minor or patch version."""
    v = version_parts(version)
    major, minor, patch = v["major"], v["minor"], v["patch"]
    zero = F.lit(0)
    new = {"major": (major + 1, zero, zero), "minor": (major, minor + 1, zero), "patch": (major, minor, patch + 1)}[what]
    return F.concat(new[0].cast("string"), F.lit("."), new[1].cast("string"), F.lit("."), new[2].cast("string"))
