"""One query text for two engines: what they spell differently."""

from __future__ import annotations


class Spark:
    lists = "size"

    def agg(self, x: str, sep: str, order: str) -> str:
        return f"string_agg({x}, {sep}) WITHIN GROUP (ORDER BY {order})"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_like({x}, '{pattern}')"

    def gathered(self, source: str, key: str) -> str:
        """source with the rows of a key in one partition: groups by the key and more, and then by the key, need no other exchange."""
        return f"(SELECT /*+ REPARTITION({key}) */ * FROM {source}) g"

    def exploded(self, source: str, array: str, name: str = "line") -> str:
        return f"(SELECT * FROM {source} LATERAL VIEW posexplode({array}) l AS pos, {name})"

    def split(self, x: str, sep: str) -> str:
        return f"split({x}, {sep})"

    def all_matches(self, x: str, pattern: str) -> str:
        return f"regexp_extract_all({x}, '({pattern})', 1)"

    def quantile(self, x: str, p: float) -> str:
        return f"percentile({x}, {p})"

    def month(self, x: str) -> str:
        return f"date_format({x}, 'yyyy-MM')"

    def day(self, x: str) -> str:
        return f"date_format({x}, 'yyyy-MM-dd')"

    def json_int(self, x: str, key: str) -> str:
        return f"CAST(get_json_object({x}, '$.{key}') AS BIGINT)"

    def get(self, array: str, k: str) -> str:
        """Element by position from 1; null beyond the ends."""
        return f"try_element_at({array}, CAST({k} AS INT))"

    def where(self, array: str, condition: str) -> str:
        return f"filter({array}, x -> {condition})"

    def each(self, array: str, value: str) -> str:
        return f"transform({array}, x -> {value})"

    def fold(self, array: str, start: str, value: str) -> str:
        """Sum-like reduction of value of x into acc."""
        return f"aggregate({array}, {start}, (acc, x) -> {value})"

    def dot(self, a: str, b: str) -> str:
        return f"aggregate(zip_with({a}, {b}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE)), CAST(0 AS DOUBLE), (acc, x) -> acc + x)"

    def join_list(self, array: str, sep: str) -> str:
        return f"array_join({array}, {sep})"

    def numbers(self, a: str, b: str) -> str:
        return f"sequence({a}, {b})"

    def sha(self, x: str) -> str:
        return f"sha2({x}, 256)"


class Duck(Spark):
    lists = "len"

    def gathered(self, source: str, key: str) -> str:
        return source

    def agg(self, x: str, sep: str, order: str) -> str:
        return f"string_agg({x}, {sep} ORDER BY {order})"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, '{pattern}')"

    def exploded(self, source: str, array: str, name: str = "line") -> str:
        return f"(SELECT *, unnest({array}) AS {name}, generate_subscripts({array}, 1) - 1 AS pos FROM {source})"

    def split(self, x: str, sep: str) -> str:
        return f"string_split({x}, {sep})"

    def quantile(self, x: str, p: float) -> str:
        return f"quantile_cont({x}, {p})"

    def month(self, x: str) -> str:
        return f"strftime({x}, '%Y-%m')"

    def day(self, x: str) -> str:
        return f"strftime({x}, '%Y-%m-%d')"

    def json_int(self, x: str, key: str) -> str:
        return f"CAST(json_extract_string({x}, '$.{key}') AS BIGINT)"

    def get(self, array: str, k: str) -> str:
        return f"({array})[{k}]"

    def where(self, array: str, condition: str) -> str:
        return f"list_filter({array}, lambda x: {condition})"

    def each(self, array: str, value: str) -> str:
        return f"list_transform({array}, lambda x: {value})"

    def fold(self, array: str, start: str, value: str) -> str:
        return f"list_reduce(list_prepend({start}, {array}), lambda acc, x: {value})"

    def dot(self, a: str, b: str) -> str:
        return f"list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"

    def join_list(self, array: str, sep: str) -> str:
        return f"array_to_string({array}, {sep})"

    def numbers(self, a: str, b: str) -> str:
        return f"generate_series({a}, {b})"

    def sha(self, x: str) -> str:
        return f"sha256({x})"


SPARK, DUCK = Spark(), Duck()
