"""Counters of related links against a plain reading of the page."""

import random
import time

import pytest
from pyspark.sql import functions as F

from pagetables.functions.shred import shred_html
from pagetables.operators import lists as L
from pagetables.spec import job_board
from tests.pages import HOST, SITE

SPEC = job_board(HOST)


def links_of(spark, html):
    df = spark.createDataFrame([(f"{SITE}/praca/zoznam-lokalit/", html)], "effective_url string, html string")
    pages = df.withColumns({"nodes": shred_html(F.col("html")), "route": F.lit("jobRelatedList"), "page": F.struct(F.lit(1).alias("page_id"))})
    return [tuple(r.e) for r in L.list_pages(pages.drop("html"), SPEC).select(F.explode("entries").alias("e")).select(
        F.struct("e.name", "e.count", "e.heading").alias("e")).collect()]


def card(items):
    """One flat card, and (name, count, heading) of its links. All share a parent, so a plain link has the first counter there that is
    not taken: one that no heading took, or one that a heading further down takes."""
    html, rows, counters, heading = "", [], [], None
    for k, kind in enumerate(items):
        if kind == "link":
            html += f'<a href="/praca/l{k}/">Link {k}</a>'
            rows.append((len(html), f"Link {k}", None, heading))
        elif kind == "count":
            html += f"<span>{k}</span>"
            counters.append((len(html), k, None))
        else:
            heading = f"Head {k}"
            html += f'<a href="/praca/h{k}/"><h2>{heading} <span>{k}</span></h2></a>'
            counters.append((len(html), k, len(html)))
            rows.append((len(html), heading, k, heading))
    want = []
    for at, name, count, under in rows:
        if count is None:
            count = next((k for _, k, taken in counters if taken is None or taken > at), 0)
        want.append((name, count, under))
    return f'<div><h1>t</h1><div class="card">{html}</div></div>', want


@pytest.mark.parametrize("seed", range(6))
def test_counters_of_a_flat_card(spark, seed):
    draw = random.Random(seed)
    html, want = card([draw.choice(["link", "link", "count", "heading"]) for _ in range(40)])
    assert links_of(spark, html) == want


def test_ten_thousand_links_in_one_card(spark):
    items = ["heading", *["link", "count"] * 40] * 250
    html, want = card(items)
    began = time.time()
    assert links_of(spark, html) == want and len(want) == 10_250
    assert time.time() - began < 30
