"""The public suffix list as a small lookup table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Where Spark's own HTTP client jar keeps the list, and the line
# at which the list's private (non-registry) section starts.
BUNDLED_RESOURCE = "mozilla/public-suffix-list.txt"
PRIVATE_SECTION = "===BEGIN PRIVATE DOMAINS==="


def _bundled_list(spark: SparkSession) -> str:
    jvm = spark.sparkContext._jvm
    stream = jvm.java.lang.Thread.currentThread().getContextClassLoader().getResourceAsStream(BUNDLED_RESOURCE)
    if stream is None:
        raise FileNotFoundError(f"{BUNDLED_RESOURCE} is not on Spark's class path; pass the list as text")
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _ascii_form(suffix: str) -> str:
    return ".".join(
        label if label.isascii() else "xn--" + label.encode("punycode").decode("ascii") for label in suffix.split(".")
    )


def suffix_rules(spark: SparkSession, text: str | None = None) -> DataFrame:
    """One row per suffix: ``suffix, is_rule, is_wildcard, is_exception``.

    ``text`` is the content of a list in the usual public format; by default the
    snapshot that ships inside Spark's HTTP client jar is used, so nothing is
    downloaded and every run sees the same rules. Private rules are left out.
    ``*.ck`` is the wildcard of ``ck`` and ``!www.ck`` the exception ``www.ck``;
    non-ASCII suffixes are listed in their ASCII form as well.

    The rows enter the plan as Arrow data whose size Spark knows, so its own
    broadcast threshold decides how they are joined.
    """
    lines = (text if text is not None else _bundled_list(spark)).split(PRIVATE_SECTION)[0].splitlines()
    rules = [line.split()[0].lower() for line in lines if line.strip() and not line.startswith("//")]
    kinds: dict[str, set[str]] = {}
    for rule in rules:
        kind = {"*": "wildcard", "!": "exception"}.get(rule[0], "rule")
        suffix = rule.removeprefix("*.").removeprefix("!")
        for form in {suffix, _ascii_form(suffix)}:
            kinds.setdefault(form, set()).add(kind)
    columns = {"suffix": list(kinds)}
    for kind in ("rule", "wildcard", "exception"):
        columns[f"is_{kind}"] = [kind in found for found in kinds.values()]
    return spark.createDataFrame(pa.table(columns))


def suffix_depth(rules: DataFrame) -> int:
    """Most labels any listed suffix has."""
    return rules.agg(F.max(F.size(F.split("suffix", r"\.")))).first()[0] or 0
