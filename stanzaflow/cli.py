"""Command line: ingest, clean, merge, enrich, analyze, unidentified, validate, diff, tree-diff, explore.

A command that fails ends with code 1 and says why; a wrong command line ends with 2.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import context, graph, profile, records, views
from .plans import ingest as plan
from .sources import corpus, dumps


LOW_DISK = 1 << 30

#: What ``explore`` shows.
VIEWS = {
    "home": lambda r, a: views.home_counts(r),
    "authors": lambda r, a: views.author_sort_list(r, a.by, a.descending).where(views.matches(F.col("author"), a.query)).orderBy("place"),
    "collections": lambda r, a: views.search(views.collection_index(r), "title", a.query, a.descending),
    "poems": lambda r, a: views.search(r.select("page_id", "title"), "title", a.query, a.descending),
    "author": lambda r, a: views.author_detail(r, a.query),
    "panels": lambda r, a: views.panel_places(r.withColumn("ord", F.col("page_id"))).where(F.col("author") == a.query).orderBy("place"),
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stanzaflow")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("clean", "unidentified", "enrich"):
        c = sub.add_parser(name)
        c.add_argument("-i", "--input", required=True)
        c.add_argument("-o", "--output", required=True)
        if name == "enrich":
            c.add_argument("--page", help="page table: titles known there fill what the file does not know")
    for name in ("merge", "diff", "tree-diff"):
        c = sub.add_parser(name)
        c.add_argument("--file-a", required=True)
        c.add_argument("--file-b", required=True)
        c.add_argument("-o", "--output", required=True)
        if name == "merge":
            c.add_argument("--strategy", choices=records.STRATEGIES, default="keep_richest")
    sub.add_parser("analyze").add_argument("path", nargs="?")
    sub.add_parser("validate").add_argument("path")
    c = sub.add_parser("explore")
    c.add_argument("path")
    c.add_argument("--view", choices=VIEWS, default="home")
    c.add_argument("--query", default="")
    c.add_argument("--by", default="author")
    c.add_argument("--descending", action="store_true")
    c.add_argument("--rows", type=int, default=50)
    c = sub.add_parser("ingest")
    for name in ("page", "categorylinks", "linktarget", "html", "xml", "category", "output", "work"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--redirect")
    c.add_argument("--tree-log", action="store_true")
    c.add_argument("--lang", default="fr")
    c.add_argument("--limit", type=int)
    c.add_argument("--resume", action="store_true")
    return p


REPORTS = {
    "overview": profile.overview,
    "completeness": profile.completeness,
    "structure": profile.structure,
    "content": profile.content,
    "versions": profile.versions,
    "top authors": profile.top_authors,
    "top collections": profile.top_collections,
    "top unidentified titles": profile.top_unidentified,
    "top collections by sections": profile.top_sections,
    "top hubs": profile.top_hubs,
    "longest": lambda r: profile.by_length(r).drop("ord"),
    "shortest": lambda r: profile.by_length(r, longest=False).drop("ord"),
}


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    read = lambda path: corpus.read_jsonl(spark, path)
    if args.command == "clean":
        rows = read(args.input)
        corpus.write_jsonl(records.process(records.best_version(rows)).orderBy("first_ord"), args.output)
        records.clean_counters(rows).show(truncate=False)
    elif args.command == "unidentified":
        corpus.write_jsonl(records.unidentified(read(args.input)), args.output)
    elif args.command == "enrich":
        known = None
        if args.page:
            pages = context.title_ids(dumps.read_sql(spark, args.page, "page"))
            known = pages.select(F.col("title").alias("collection_title"), F.col("page_id").alias("known_id"))
        corpus.write_jsonl(records.enrich(read(args.input), known), args.output)
    elif args.command == "merge":
        a, b = read(args.file_a), read(args.file_b)
        corpus.write_jsonl(records.merge(a, b, args.strategy).orderBy("first_src", "first_ord"), args.output)
        records.merge_counters(a, b, args.strategy).show(truncate=False)
    elif args.command == "diff":
        found = records.diff(read(args.file_a), read(args.file_b))
        found.where("status != 'same'").write.mode("overwrite").json(args.output)
        records.diff_summary(found).show(truncate=False)
    elif args.command == "tree-diff":
        a, b = (corpus.read_tree(spark, path) for path in (args.file_a, args.file_b))
        flat = [graph.flatten(t.select("node", "type"), t.where("parent is not null").select("parent", F.col("node").alias("child"))) for t in (a, b)]
        graph.changes_in_order(graph.compare_trees(*flat)).orderBy("status", "place").write.mode("overwrite").json(args.output)
    elif args.command == "explore":
        VIEWS[args.view](read(args.path), args).limit(args.rows).show(args.rows, truncate=60)
    elif args.command == "analyze":
        path = args.path or corpus.newest(spark, "data/*.jsonl.gz")
        if path is None:
            print("no corpus found", file=sys.stderr)
            return 1
        for name, report in REPORTS.items():
            print(f"-- {name}")
            report(read(path)).show(truncate=False)
    elif args.command == "validate":
        counts = records.validation_counts(corpus.read_lines(spark, args.path)).first()
        print(f"total {counts['total']}, valid {counts['valid']}, errors {counts['errors']}")
        return int(counts["errors"] > 0)
    else:
        d = plan.Dumps(args.page, args.categorylinks, args.linktarget, args.html, args.xml, args.redirect)
        corpus.require(spark, [p for p in (d.page, d.categorylinks, d.linktarget, d.html, d.xml, d.redirect) if p])
        if corpus.free_bytes(spark, args.work.rpartition("/")[0] or "/") < LOW_DISK:
            print("warning: less than 1 GB of disk is left", file=sys.stderr)
        done = corpus.processed_ids(spark, args.output) if args.resume else None
        result = plan.ingest(spark, d, args.category, args.lang, args.work, done, args.limit)
        counts = plan.write(spark, result, args.output, args.resume, args.tree_log)
        counts |= {"broken lines": dumps.broken_ndjson(spark, d.html).count(), "broken files": dumps.broken_xml(spark, d.xml).count()}
        print(", ".join(f"{k} {v}" for k, v in counts.items()))
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    try:
        return run(SparkSession.builder.appName("stanzaflow").getOrCreate(), args)
    except Exception as e:
        print(f"{args.command}: {type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
