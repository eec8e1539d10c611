"""Nested documents, nested lists, path trees and user functions over batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldspan.jobs.base import Tables, job
from goldspan.operators import nested as n
from goldspan.sources.lake import map_batches, map_file_pages


@job("fn_find_keys", """
WITH e AS (SELECT event_id, user_id, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, CAST(0 AS BIGINT) AS position, '{"k":' || user_id || ',"b":[{"k":"' || event_id || '"},{"c":[[{"k":[1,2]}]]}]}' AS value FROM e
UNION ALL SELECT event_id, 1, CAST(user_id AS VARCHAR) FROM e
UNION ALL SELECT event_id, 2, '"' || event_id || '"' FROM e
UNION ALL SELECT event_id, 3, '[1,2]' FROM e
UNION ALL SELECT event_id, 4, k FROM e""")
def _(t: Tables):
    """A key that holds an object with the same key inside, in lists of lists, and beside it."""
    inner = F.format_string('{"k": %d, "b": [{"k": "%d"}, {"c": [[{"k": [1, 2]}]]}]}', "user_id", "event_id")
    documents = t.events.select("event_id", F.concat(
        F.lit('{"x": null, "k": '), inner, F.lit(', "more": '), "props", F.lit("}")).alias("document"))
    return n.find_keys(documents, "document", "k", ["event_id"])


@job("fn_unroll_list", r"""
WITH w AS (SELECT doc_id, flatten(list_transform(string_split(text, chr(10)), lambda l: string_split(l, ' '))) AS words FROM documents)
SELECT doc_id, count(*) AS n_values, max(p) AS last_position, CAST(sum(length(v)) AS BIGINT) AS n_chars
FROM (SELECT doc_id, unnest(words) AS v, generate_subscripts(words, 1) - 1 AS p FROM w) GROUP BY doc_id""")
def _(t: Tables):
    """Documents as lists of lines of words, unrolled to words."""
    listed = t.documents.select("doc_id", F.transform(F.split("text", "\n"), lambda x: F.split(x, " ")).alias("words"))
    unrolled = n.unroll_list(listed, "words", ["doc_id"])
    return unrolled.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_values"), F.max("position").cast("long").alias("last_position"),
        F.sum(F.length("value")).alias("n_chars"))


@job("fn_path_tree", """
WITH p AS (SELECT string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS parts FROM pages)
SELECT folder, count(*) AS n_files, CAST(len(string_split(folder, '/')) AS INTEGER) AS depth
FROM (SELECT array_to_string(parts[1:i], '/') AS folder FROM (SELECT parts, unnest(range(1, len(parts))) AS i FROM p)) GROUP BY folder""")
def _(t: Tables):
    paths = t.pages.select(F.regexp_replace("url", "^[a-z]+://", "").alias("path"))
    return n.path_tree(paths, "path")


@job("udf_page_callback", "SELECT event_id, value * 2 AS value, upper(event_type) AS event_type FROM events")
def _(t: Tables):
    """A user's function on every page (Arrow batch) of a result."""
    def page(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(value=frame["value"] * 2, event_type=frame["event_type"].str.upper())

    pages = t.events.select("event_id", "value", "event_type")
    return map_batches(pages, page, "event_id long, value double, event_type string")


@job("udf_file_callback", """SELECT o_orderkey, o_orderstatus || '/' || o_orderpriority AS label, place FROM
     (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE o_totalprice > 250000""")
def _(t: Tables):
    """A user's function on all rows of a file, in pages of the order it needs: it ranks them, which takes all of them."""
    def ranked(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = 0
        for page in pages:
            place = pd.Series(range(before + 1, before + len(page) + 1), dtype="int64")
            before += len(page)
            kept = page["o_totalprice"] > 250000
            yield pd.DataFrame({"o_orderkey": page["o_orderkey"], "label": page["o_orderstatus"] + "/" + page["o_orderpriority"], "place": place})[kept]

    columns = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return map_file_pages(columns, ranked, "o_orderkey long, label string, place long", [F.desc("o_totalprice"), "o_orderkey"])


@job("udf_step", """SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer
     WHERE c_acctbal >= 1000 GROUP BY c_mktsegment""")
def _(t: Tables):
    """A step: a user's function of its inputs and parameters."""
    def step(customers: DataFrame, minimum: float, by: str) -> DataFrame:
        return customers.where(F.col("c_acctbal") >= minimum).groupBy(by).agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))

    return t.customer.transform(step, minimum=1000.0, by="c_mktsegment")
