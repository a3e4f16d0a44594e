"""Reading lists (category → ordered (title, url) entries) as rows (SRC-08).

Two input forms: *nested* (``category``, ``papers ARRAY<STRUCT<title,
url>>``), exploded with its list position; *flat* (``category``, ``pos``,
``title``, ``url``), where the position is already data. Neither form needs
a window over a category, so a category with a third of all entries is no
hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T

CATALOGUE_SCHEMA = "category STRING, papers ARRAY<STRUCT<title: STRING, url: STRING>>"


def flatten(nested: DataFrame, category_col: str = "category", papers_col: str = "papers") -> DataFrame:
    """Nested form → (category, pos, title, url); ``pos`` from 1 in list
    order (WIN-01); entries without a URL keep their number."""
    e = nested.select(F.col(category_col).alias("category"),
                      F.posexplode(papers_col).alias("__i", "__p"))
    return e.select("category", (F.col("__i") + 1).cast("int").alias("pos"),
                    F.col("__p.title").alias("title"), F.col("__p.url").alias("url"))


def target_paths(flat: DataFrame) -> DataFrame:
    """Numbered, cleaned target path ``<category>/<nn>. <title>.pdf``
    (PRJ-07, STR-09..11): the first three characters of a title are its old
    number and are dropped; forbidden characters are removed from both the
    folder and the file name."""
    folder = T.sanitize_filename(F.col("category"))
    name = F.concat(T.two_digit(F.col("pos")), F.lit(". "),
                    T.sanitize_filename(T.drop_leading_number(F.col("title"))), F.lit(".pdf"))
    return flat.select("category", "pos", "title", "url", folder.alias("folder"),
                       name.alias("filename"), F.concat_ws("/", folder, name).alias("target_path"))
