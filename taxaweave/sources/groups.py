"""Family-group configuration (B16): a small YAML tree of named groups, each
listing families directly or under named subgroups, flattened into a
(group, subgroup, family) table and joined onto taxa (one-to-many: a family
may sit in several groups).

Example file::

    orchids:
      description: one family
      families: [Orchidaceae]
    algae:
      groups:
        brown: [Fucaceae, Laminariaceae]
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def flatten_groups(tree: Mapping) -> list[tuple[str, str | None, str]]:
    """(group, subgroup, family) rows; entries without families are metadata."""
    rows: list[tuple[str, str | None, str]] = []
    for group, body in tree.items():
        if not isinstance(body, Mapping):
            continue
        for fam in body.get("families") or []:
            rows.append((str(group), None, str(fam)))
        subgroups = body.get("groups") or {}
        if isinstance(subgroups, Mapping):
            for sub, fams in subgroups.items():
                for fam in fams or []:
                    rows.append((str(group), str(sub), str(fam)))
    return rows


def load_family_groups(spark: SparkSession, path_or_text: str) -> DataFrame:
    """Read a group file (one small configuration file) from any store Spark
    reads; text with a line break is taken as the configuration itself."""
    import yaml

    text = path_or_text
    if "\n" not in path_or_text:
        text = spark.read.text(path_or_text, wholetext=True).first()["value"]
    rows = flatten_groups(yaml.safe_load(text) or {})
    return spark.createDataFrame(rows, "group string, subgroup string, family string")


def tag_family_group(df: DataFrame, groups: DataFrame, family_col: str = "family") -> DataFrame:
    """Left join of the group table on the family column: one output row per
    (row, matching group); rows of unlisted families get NULL groups."""
    g = groups.select(F.col("family").alias("__family"), "group", "subgroup")
    return df.join(g, df[family_col] == g["__family"], "left").drop("__family")
