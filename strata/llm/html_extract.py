"""Main text of web pages by wrappers inferred for each host.

Every different page of a host is aligned: dealt by a hash of the html, some
``GROUP_PAGES`` to twice as many pages each make a union-free wrapper, which says
only where the article is; a host with fewer pages has one wrapper. The place that
most pages of the host have by their wrappers is the host's, counted over all
wrappers. Each page is then read at its host's place; a page without a host, or on
which the place is missing, is read by its own tree. A block's white space is one
blank, blocks are joined by a line break, in page order.

Which texts are the template's is counted over all pages: a text is, if it stands on
more than two thirds of those pages of the host that have its place (the elements
from the root down), headings and asides not counted. Pages of one subject (title,
headings, first text) count once, so that copies and near copies of a page don't
make its article a template. A place that not most pages of the host have, or that
holds several texts (paragraphs, say), must show the text on ``SUBJECTS`` subjects,
any other on two.

A page is parsed once for both; written and shuffled are its tree (elements, and
digests and lengths of its texts) and hashes of places and texts (about ten a page,
once for each task, place, text and subject). Counts are dealt by subject too before
they are added up, and trees by groups of pages, so a host with a third of all pages
costs no more than others. Places and templates (a few hundred bytes a host) are joined
to the pages, whose side Spark may split or leave in place.

Defined results: NULL or empty html has an empty text; a NULL or malformed url is
a page without a host; repeated pages are extracted row by row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise, no_cycle_collection, slices
from strata.llm.html_tree import parse
from strata.llm.wrappers import ROOT, Places, article, content_path, infer, packed, placed_texts, subject, unpacked

GROUP_PAGES = 32
SUBJECTS = 4
BATCH_BYTES = 8_000_000
PATHS = "host long, path string, pages long"
PLACED = "host long, place long, text long, subject long, several boolean, page long, tree string"
TEXTS = "page_id long, url string, text string, n_chars long"


def host_of(url: Column) -> Column:
    """Lower-case host of an address; empty where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.coalesce(host, F.lit(""))


@no_cycle_collection
def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places = Places()
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string())
    for batch in batches:
        for part in slices(batch, "data", BATCH_BYTES):
            rows = []
            for host, number, data in zip(*(part.column(c).to_pylist() for c in ("host", "page", "data"))):
                page = parse(data.decode("utf-8", "replace"))
                own = subject(page)
                at, texts = placed_texts(page, places)
                rows.append((host, None, None, None, None, number, json.dumps(packed(page), separators=(",", ":"))))
                rows += [(host, place, None, own, False, None, None) for place in at]
                rows += [(host, place, text, own, several, None, None) for text, (place, several) in texts.items()]
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["host", "place", "text", "subject", "several", "page", "tree"])


def parsed(pages: DataFrame) -> DataFrame:
    """pages (host, data) -> of each page of a host: a row with its number and tree, and its places and texts."""
    known = pages.filter((F.col("host") != "") & (F.length("data") > 0))
    known = known.select(F.xxhash64("host").alias("host"), F.xxhash64("data").alias("page"), "data")
    return materialise(known.mapInArrow(_placed, PLACED), "parsed")


def _infer(rows: pa.Table) -> pa.Table:
    pages = [unpacked(json.loads(t)) for t in rows.sort_by([("dealt", "ascending"), ("page", "ascending")])["tree"].to_pylist()]
    path = content_path(infer(pages))
    held = sum(article(p, path, frozenset()) is not None for p in pages)
    return pa.table({"host": rows["host"][:1], "path": pa.array([json.dumps(path, ensure_ascii=False)], pa.string()),
                     "pages": pa.array([held], pa.int64())})


def wrappers(placed: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """The pages' trees -> host (hashed), wrapper: the place that most of its different pages have."""
    trees = placed.filter(F.col("tree").isNotNull())
    of_host = trees.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("n"))
    # written first, as Spark then knows that it is small
    groups = materialise(of_host.select("host", F.greatest(F.lit(1), F.expr(f"n div {group_pages}")).alias("groups")), "groups")
    # ranges of a hash of the page; of copies of a page one goes on
    dealt = trees.groupBy("host", "page").agg(F.min("tree").alias("tree")).join(groups, "host").withColumn("dealt", F.xxhash64("page"))
    dealt = dealt.withColumn("part", F.shiftright(F.shiftrightunsigned("dealt", 33) * F.col("groups"), 31)).drop("groups")
    paths = dealt.groupBy("host", "part").applyInArrow(_infer, PATHS)
    votes = paths.groupBy("host", "path").agg(F.sum("pages").alias("pages"))
    return votes.groupBy("host").agg(F.max(F.struct("pages", "path"))["path"].alias("wrapper"))


def templates(placed: DataFrame) -> DataFrame:
    """The pages' places and texts -> host (hashed), template: digests of its template's texts."""
    subjects = placed.filter(F.col("tree").isNull()).groupBy("host", "place", "text", "subject").agg(F.max("several").alias("several"))
    counts = subjects.groupBy("host", "place", "text").agg(F.count("*").alias("n"), F.max("several").alias("several"))
    counts = materialise(counts.filter(F.col("text").isNull() | (F.col("n") > 1)), "texts")
    of_place = materialise(counts.filter(F.col("text").isNull() & (F.col("n") > 1)).select("host", "place", F.col("n").alias("of")), "places")
    of_host = of_place.filter(F.col("place") == ROOT).select("host", F.col("of").alias("pages"))
    # both are small, and written: Spark may broadcast them and leave the texts in place
    found = counts.filter(F.col("text").isNotNull()).join(of_place, ["host", "place"]).join(of_host, "host")
    usual = ~F.col("several") & (F.col("of") * 3 > F.col("pages") * 2)
    found = found.filter((F.col("n") * 3 > F.col("of") * 2) & (usual | (F.col("n") >= SUBJECTS)))
    return found.groupBy("host").agg(F.collect_list("text").alias("template"))


@no_cycle_collection
def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, tuple[list[str], frozenset[int]]] = {}
    places = Places()
    for batch in batches:
        for part in slices(batch, "data", BATCH_BYTES):
            texts = []
            wrapped, template_of = part.column("wrapper"), part.column("template")
            for i, (data, host) in enumerate(zip(part.column("data").to_pylist(), part.column("known_host").to_pylist())):
                page = parse(data.decode("utf-8", "replace"))
                if host is None:
                    path, template = content_path(infer([page])), frozenset()
                else:
                    if host not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[host] = json.loads(wrapped[i].as_py()), frozenset(template_of[i].as_py() or ())
                    path, template = known[host]
                blocks = article(page, path, template, places)
                if blocks is None:
                    blocks = article(page, content_path(infer([page])), template, places)
                if not blocks:
                    blocks = article(page, content_path(infer([page])), frozenset(), places)
                texts.append("\n".join(blocks))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"),
                        host_of(pages["url"]).alias("host"),
                        F.coalesce(pages["html"].cast("binary"), F.lit(b"")).alias("data"))
    placed = parsed(rows)
    # written first: Spark then knows the wrappers' size and leaves the pages in place if it may broadcast them
    known = wrappers(placed, group_pages).withColumnRenamed("host", "known_host")
    own = templates(placed).withColumnRenamed("host", "hashed")
    known = materialise(known.join(own, F.col("known_host") == F.col("hashed"), "left").drop("hashed"), "wrappers")
    # a page without a host has no key
    key = F.when(F.col("host") != "", F.xxhash64("host"))
    joined = rows.withColumn("key", key).join(known, F.col("key") == F.col("known_host"), "left")
    return joined.select("page_id", "url", "data", "known_host", "wrapper", "template").mapInArrow(_extract, TEXTS)
