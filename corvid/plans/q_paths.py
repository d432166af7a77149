"""Registered path/text queries on ``pages`` URLs and ``part`` types."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.text import label_from_text, strip_scheme
from corvid.plans.registry import register
from corvid.plans.standins import table


@register("strip_scheme", sql="SELECT page_id, replace(url, 'https:', '') AS path FROM pages")
def strip_scheme_q(spark, sf_dir):
    """remove a scheme prefix from every URL (here ``https:``)."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", strip_scheme(F.col("url"), "https:").alias("path"))


@register("label_from_path", sql="""SELECT p_partkey, p_type,
    CAST(CASE WHEN substring(p_type, 1, 3) = 'ECO' THEN 1 ELSE 0 END AS INTEGER) AS label FROM part""")
def label_from_path(spark, sf_dir):
    """label 1 when a fixed slice of the text equals a word (``p_type`` starts ``ECO``)."""
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_type", label_from_text(F.col("p_type"), 1, 3, "ECO").alias("label"))


@register("label_from_url", sql="""SELECT page_id,
    CAST(CASE WHEN substring(url, 47, 3) = 'ref' THEN 1 ELSE 0 END AS INTEGER) AS label FROM pages""")
def label_from_url(spark, sf_dir):
    """Slice past the end of short URLs yields '' and label 0, never an error."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", label_from_text(F.col("url"), 47, 3, "ref").alias("label"))
