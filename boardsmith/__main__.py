"""Command line for the four stages (the reference runs each stage as a script).

  python -m boardsmith extract    --input pages/      --output posts/     [--format parquet|html] [--status column]
  python -m boardsmith refine     --input crawl.csv   --output refined/   [--mode text|json] [--hook pkg.mod:fn]
  python -m boardsmith categorize --input refined/    --output categorized/ [--n 10]
  python -m boardsmith search     --input refined/    --questions q.txt --output hits/ [--k 3]

Inputs are CSV (crawled posts) or Parquet (refined); outputs are Parquet folders plus, with ``--csv``, a
UTF-8-BOM CSV next to them.  The hook is ``fn(batch_id, prompt) -> reply``; the default is the echo hook.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import functions as F

from boardsmith import workflows as W
from boardsmith.operators.enrich import echo
from boardsmith.session import get_spark
from boardsmith.sources.csv import scan_any_posts_csv, sink_csv
from boardsmith.sources.pages import scan_pages


def _hook(spec: str | None):
    if not spec:
        return echo
    mod, _, name = spec.partition(":")
    module = importlib.import_module(mod)
    try:  # ship the hook's module by value, so workers need not import it from their own path
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(module)
    except Exception:  # noqa: BLE001 - fall back to import by reference (module on the workers' path)
        pass
    return getattr(module, name)


def _write(df, path: str, csv: bool) -> None:
    df.write.mode("overwrite").parquet(path)
    if csv:
        sink_csv(df, path.rstrip("/") + "_csv", bom=True)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="boardsmith")
    sub = ap.add_subparsers(dest="cmd", required=True)
    x = sub.add_parser("extract", help="landed detail pages -> posts with title, contents, date, views, comments")
    x.add_argument("--input", required=True, help="Parquet with page_id and html, or a folder of HTML files")
    x.add_argument("--output", required=True)
    x.add_argument("--format", choices=["parquet", "html"], default="parquet")
    x.add_argument("--status", help="column of HTTP statuses: only pages with 200 are read")
    r = sub.add_parser("refine", help="crawled-post CSV -> numbered batches -> hook replies -> refined rows")
    r.add_argument("--input", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--mode", choices=["text", "json"], default="text")
    r.add_argument("--hook")
    c = sub.add_parser("categorize", help="refined rows -> built categories -> primary/secondary category")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--n", type=int, default=10)
    s = sub.add_parser("search", help="refined rows + questions file -> top-k hits and grounding context")
    s.add_argument("--input", required=True)
    s.add_argument("--questions", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--k", type=int, default=3)
    for p in (x, r, c, s):
        p.add_argument("--csv", action="store_true", help="also write a UTF-8-BOM CSV")
        p.add_argument("--master")
    a = ap.parse_args(argv)
    spark = get_spark(a.master)

    if a.cmd == "extract":
        posts, rejects = W.extract_pages(scan_pages(spark, a.input, a.format), status=a.status)
        posts.write.mode("overwrite").parquet(a.output)
        rejects.write.mode("overwrite").parquet(a.output.rstrip("/") + "_rejects")
        if a.csv:
            sink_csv(W.posts_csv(spark.read.parquet(a.output)), a.output.rstrip("/") + "_csv", bom=True)
    elif a.cmd == "refine":
        out = W.refine_posts(scan_any_posts_csv(spark, a.input), _hook(a.hook), mode=a.mode)
        _write(out.refined, a.output, a.csv)
        out.rejects.write.mode("overwrite").parquet(a.output.rstrip("/") + "_rejects")
    elif a.cmd == "categorize":
        cats, assigned = W.categorize_posts(spark.read.parquet(a.input), a.n)
        _write(assigned, a.output, a.csv)
        cats.withColumn("related_keywords", F.to_json("related_keywords")).write.mode("overwrite").parquet(a.output.rstrip("/") + "_categories")
    else:
        questions = spark.read.text(a.questions).where(F.trim("value") != "").select(
            F.monotonically_increasing_id().alias("query_id"), F.col("value").alias("text"))
        hits, ctx = W.search_posts(spark.read.parquet(a.input), questions, k=a.k)
        _write(hits.join(questions, "query_id"), a.output, a.csv)
        ctx.write.mode("overwrite").parquet(a.output.rstrip("/") + "_context")


if __name__ == "__main__":
    main()
