"""Command line: the four batch steps of the forecasting workflow.

    python -m loadcast.cli features --sessions 'data/20[0-1][0-9]/*/*/*/request.csv' \
                                   --config ONE_MONTH --out /shared/features
    python -m loadcast.cli train   --features /shared/features --out /shared/run1
    python -m loadcast.cli train   --sessions '...' --config ONE_MONTH --out /shared/run1   (both)
    python -m loadcast.cli stats   --sessions '.../2016/06/*/*/request.csv' --out /shared/stats
    python -m loadcast.cli score   --stats /shared/stats --model /shared/run1/model \
                                   [--score-begin '2016-07-01 00:00:00'] \
                                   [--servers 10.0.0.1,10.0.0.2] --out /shared/predictions

Malformed lines are no sessions; ``--rejects`` keeps them with their file and the reason.

``stats`` adds the files that its store has not read yet, so it can be run again over a glob that
grows; files may split hours and come late.

Session files are headerless CSV in the 17-column layout. ``--servers`` restricts any step
to a list of servers (the debug mode). ``score`` takes its settings from the run info stored
with the model (any of them can be overridden) and writes ``<out>-coverage`` beside the
predictions: rows asked for, scored, and skipped for a level the model has not seen. Label cuts are
``--low`` and ``--high``, or with ``--label-quantiles 0.5,0.9`` percentiles of the train split. Outputs
are parquet (predictions and metrics as JSON lines with ``--json``). The master and cluster settings come from
spark-submit; scratch tables go below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from . import config as C
from .plans import features as FT
from .plans import scoring as SC
from .plans import statistics as ST
from .plans import training as TR
from .session import build_session
from .sources.records import write_records
from .sources.sessions import clean_sessions, filter_servers, read_sessions_checked

CONFIGS = {"ONE_MONTH": C.ONE_MONTH, "FULL": C.FULL}


def _fractions(text: str) -> tuple[float, float]:
    low, high = map(float, text.split(","))
    return low, high


_OVERRIDES = {"train_begin": str, "train_end": str, "test_split_start": str, "score_begin": str,
              "low": float, "high": float, "label_quantiles": _fractions, "lag_mode": str, "fit_on": str, "handle_invalid": str}


def _cfg(args) -> C.RunConfig:
    """A named duration mode, with any of its fields overridden from the command line."""
    kw = {k: getattr(args, k) for k in _OVERRIDES if getattr(args, k, None) is not None}
    return CONFIGS[args.config].with_(**kw)


def _add_session_args(p) -> None:
    p.add_argument("--sessions", required=True, action="append", help="path or glob; repeatable")
    p.add_argument("--timestamp-format", help="Spark datetime pattern, for times in an unusual form")
    p.add_argument("--servers", help="comma-separated server list (debug mode)")
    p.add_argument("--rejects", help="folder to add the malformed lines to, with file and reason")


def _add_config_args(p, named: bool = True) -> None:
    if named:
        p.add_argument("--config", choices=sorted(CONFIGS), default="ONE_MONTH")
    for k, typ in _OVERRIDES.items():
        p.add_argument("--" + k.replace("_", "-"), type=typ, dest=k)


def _cfg_from_info(info: dict, args) -> C.RunConfig:
    """The stored run config, with command-line overrides on top."""
    base = TR.config_from_info(info)
    kw = {k: getattr(args, k) for k in _OVERRIDES if getattr(args, k, None) is not None}
    return base.with_(**kw)


def _sessions(spark, args, paths=None):
    s, rejects = read_sessions_checked(spark, paths or args.sessions, args.timestamp_format)
    if args.rejects:
        rejects.write.mode("append").parquet(args.rejects)
    s = clean_sessions(s)
    return filter_servers(s, args.servers.split(",")) if args.servers else s


def _write(df, path: str, as_json: bool) -> None:
    (write_records(df, path) if as_json else df.write.mode("overwrite").parquet(path))


def main(argv=None, spark=None) -> None:
    """Run one step. With ``spark`` given (tests, notebooks) that session is used and left open."""
    p = argparse.ArgumentParser(prog="loadcast")
    sub = p.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("features", help="feature table and fitted encoders")
    _add_session_args(f)
    _add_config_args(f)
    f.add_argument("--out", required=True)
    t = sub.add_parser("train", help="forest, metrics, saved model (from --features or --sessions)")
    src = t.add_mutually_exclusive_group(required=True)
    src.add_argument("--sessions", action="append", help="path or glob; repeatable")
    src.add_argument("--features", help="output folder of the features command")
    t.add_argument("--timestamp-format")
    t.add_argument("--rejects")
    _add_config_args(t)
    t.add_argument("--servers")
    t.add_argument("--out", required=True)
    t.add_argument("--json", action="store_true")
    s = sub.add_parser("stats", help="hourly and daily statistics for scoring, from files not read before")
    _add_session_args(s)
    s.add_argument("--compact", action="store_true", help="add up the batches of each month afterwards")
    s.add_argument("--out", required=True)
    c = sub.add_parser("score", help="48-hour predictions")
    c.add_argument("--stats", required=True)
    c.add_argument("--model", required=True)
    _add_config_args(c, named=False)
    c.add_argument("--servers")
    c.add_argument("--out", required=True)
    c.add_argument("--json", action="store_true")
    args = p.parse_args(argv)

    own = spark is None
    spark = spark or build_session(app=f"loadcast-{args.cmd}")
    if args.cmd == "features":
        cfg = _cfg(args)
        fm, _ = FT.build_feature_table(spark, _sessions(spark, args), cfg, f"{args.out}/table")
        TR.save_features(spark, fm, cfg, f"{args.out}/encoders", ",".join(args.sessions))
    elif args.cmd == "train" and args.features:
        fm, info = TR.load_features(spark, f"{args.features}/encoders")
        cfg = _cfg_from_info(info, args)
        table = spark.read.parquet(f"{args.features}/table")
        _write(TR.train_from_table(spark, table, fm, cfg, f"{args.out}/model", info.get("dataFile")),
               f"{args.out}/metrics", args.json)
    elif args.cmd == "train":
        metrics = TR.run_training(spark, _sessions(spark, args), _cfg(args), f"{args.out}/features",
                                  f"{args.out}/model", ",".join(args.sessions))
        _write(metrics, f"{args.out}/metrics", args.json)
    elif args.cmd == "stats":
        read = lambda spark, paths: _sessions(spark, args, paths)
        n = ST.take_in(spark, args.out, args.sessions, read)
        print(f"{n} new files")
        if args.compact:
            ST.compact(spark, args.out)
    else:
        model, info = TR.load_model(spark, args.model)
        servers = args.servers.split(",") if args.servers else None
        pred, coverage = SC.run_scoring(spark, model, _cfg_from_info(info, args), f"{args.stats}/hourly",
                                        f"{args.stats}/daily", servers)
        _write(pred, args.out, args.json)
        _write(coverage, f"{args.out}-coverage", args.json)
    if own:
        spark.stop()


if __name__ == "__main__":
    main()
