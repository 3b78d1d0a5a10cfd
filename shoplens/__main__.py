"""Command line: run one application.

python -m shoplens {session,page,area} (--sf-dir DIR | --tables PREFIX) (--out DIR | --jdbc-url URL) [--params TASK] [--task-id ID]
python -m shoplens ads --root DIR (--brokers LIST --topics LIST | --feed DIR | --log DIR) [--zone ZONE] [--watermark DELAY] [--once]

``--tables`` reads the catalog tables PREFIXuser_visit_action, PREFIXuser_info and PREFIXproduct_info. ``--params`` is a task object, or
@FILE that holds one. ``--jdbc-user`` and the environment variable SHOPLENS_JDBC_PASSWORD go to the database.
"""

from __future__ import annotations

import argparse
import os

from shoplens.params import TaskParams
from shoplens.plans import jobs
from shoplens.plans.tables import Tables
from shoplens.runtime import build_session
from shoplens.sources.adlog import read_ad_log_kafka, read_ad_log_stream
from shoplens.sources.city_area import city_area
from shoplens.sources.logfeed import read_log_feed
from shoplens.sources.tables import read_actions, read_products, read_users


def _arguments(argv) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="shoplens")
    ap.add_argument("--master")
    kinds = ap.add_subparsers(dest="job", required=True)
    for name in ("session", "page", "area"):
        one = kinds.add_parser(name)
        source, sink = one.add_mutually_exclusive_group(required=True), one.add_mutually_exclusive_group(required=True)
        source.add_argument("--sf-dir")
        source.add_argument("--tables", help="prefix of the catalog tables, e.g. a database and a dot")
        sink.add_argument("--out")
        sink.add_argument("--jdbc-url")
        one.add_argument("--jdbc-user")
        one.add_argument("--params", help="task object, or @FILE")
        one.add_argument("--task-id", default="task")
        one.add_argument("--master", default=argparse.SUPPRESS)
    ads = kinds.add_parser("ads")
    ads.add_argument("--root", required=True)
    ads.add_argument("--brokers")
    ads.add_argument("--topics")
    ads.add_argument("--feed", help="folder that whole log files are put into, instead of brokers")
    ads.add_argument("--log", help="folder of log files that grow, instead of brokers")
    ads.add_argument("--starting", default="latest", help="for brokers and --log: latest or earliest")
    ads.add_argument("--zone", default="UTC")
    ads.add_argument("--watermark")
    ads.add_argument("--once", action="store_true", help="take what is there and stop")
    ads.add_argument("--master", default=argparse.SUPPRESS)
    args = ap.parse_args(argv)
    if args.job == "ads" and sum(map(bool, (args.feed, args.log, args.brokers and args.topics))) != 1:
        ap.error("ads needs --feed, --log, or --brokers and --topics")
    return args


def _params(text: str | None) -> TaskParams:
    if text and text.startswith("@"):
        with open(text[1:], encoding="utf-8") as f:
            text = f.read()
    return TaskParams.from_json(text) if text else TaskParams()


def main(argv=None) -> None:
    args = _arguments(argv)
    spark = build_session(args.master)
    if args.job == "ads":
        if args.feed:
            lines = read_ad_log_stream(spark, args.feed)
        elif args.log:
            lines = read_log_feed(spark, args.log, args.starting).select("value")
        else:
            lines = read_ad_log_kafka(spark, args.brokers, args.topics, starting=args.starting)
        trigger = {"availableNow": True} if args.once else None
        # with --once a query reads what those before it have written, so they run one after another
        _, queries = jobs.start_ad_stream_job(spark, lines, args.root, args.watermark, trigger, zone=args.zone, in_turn=args.once)
        for q in queries:
            q.awaitTermination()
        return
    params = _params(args.params)
    if args.sf_dir:
        t = Tables(spark, args.sf_dir)
        tables = jobs.ShopTables(t.actions, t.users, t.products, t.cities)
    else:
        tables = jobs.ShopTables(read_actions(spark, f"{args.tables}user_visit_action"), read_users(spark, f"{args.tables}user_info"),
                                 read_products(spark, f"{args.tables}product_info"), city_area(spark))
    login = {"user": args.jdbc_user, "password": os.environ.get("SHOPLENS_JDBC_PASSWORD", "")} if args.jdbc_user else {}
    out = args.out or jobs.to_jdbc(args.jdbc_url, args.task_id, login)
    run = {"session": jobs.run_session_job, "page": jobs.run_page_job, "area": jobs.run_area_job}[args.job]
    run(tables, params, out, args.task_id)


if __name__ == "__main__":
    main()
