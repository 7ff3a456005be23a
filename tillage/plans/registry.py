"""The registry of queries and the SQL forms that their oracles share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Characters that public questions, and signatures, are compared without.
PUBLIC = "\"'“”‘’.,;:!?()[]{}"
SIGNATURE = "“”\"'`.,;:!?()[]{}"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_collapse(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '\s+', ' ', 'g'), '^ | $', '', 'g')"


def sql_normalize(x: str) -> str:
    return sql_collapse(f"replace(replace(lower({x}), 'ß', 'ss'), 'ς', 'σ')")


def _sql_translate(x: str, chars: str) -> str:
    return f"translate({x}, '{chars.replace(chr(39), chr(39) * 2)}', '{' ' * len(chars)}')"


def sql_public(x: str) -> str:
    return sql_normalize(_sql_translate(x, PUBLIC))


def sql_signature(x: str) -> str:
    return sql_collapse(_sql_translate(sql_normalize(x), SIGNATURE))


def sql_id(prefix: str, x: str) -> str:
    return f"'{prefix}' || upper(substr(sha256({x}), 1, 12))"


def sql_unescape(x: str) -> str:
    """The entities that the pages have; the ampersand last."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&eacute;", "é"), ("&uuml;", "ü"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x
