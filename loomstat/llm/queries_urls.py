"""The query of the URL filter."""

from __future__ import annotations

from loomstat.llm import url_filter
from loomstat.llm.registry import query

#: The contract's rules.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op11_url_filter")
def op11(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge(pages, rules, url_filter.fit(url_filter.labelled_urls(spark)))
