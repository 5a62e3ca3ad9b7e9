"""Command line: python -m clademill.cli COMMAND ..., on any cluster that spark-submit is set up for."""

from __future__ import annotations

import argparse
import inspect
import json

from pyspark.sql import SparkSession

from .plans import commands

COMMANDS = {
    "collect-reports": commands.collect_reports,
    "collect-classifications": commands.collect_classifications,
    "collect-kmers": commands.collect_kmers,
    "collect-chunks": commands.collect_chunks,
    "table": commands.make_table,
    "features": commands.make_features,
    "annotate": commands.annotate,
    "extract-reads": commands.extract_reads,
    "show": commands.show,
}


def parser() -> argparse.ArgumentParser:
    """A command's parameters are its function's: those without a default by place, the others as options."""
    top = argparse.ArgumentParser(prog="clademill")
    each = top.add_subparsers(dest="command", required=True)
    for name, f in COMMANDS.items():
        sub = each.add_parser(name, help=(inspect.getdoc(f) or name).split("\n")[0])
        for p in list(inspect.signature(f).parameters.values())[1:]:
            kind, flag = str(p.annotation), "--" + p.name.replace("_", "-")
            if kind == "bool":
                sub.add_argument(flag, action=argparse.BooleanOptionalAction, default=p.default)
            elif kind.startswith(("list", "tuple")):
                sub.add_argument(flag, nargs="*", type=int if "int" in kind else str, default=[], required=p.default is p.empty)
            elif p.default is p.empty:
                sub.add_argument(p.name)
            else:
                sub.add_argument(flag, type=int if "int" in kind else str, default=p.default)
    return top


def main(argv: list[str] | None = None) -> None:
    args = vars(parser().parse_args(argv))
    f = COMMANDS[args.pop("command")]
    spark = SparkSession.builder.appName("clademill").getOrCreate()
    print(json.dumps(f(spark, **args), indent=2, default=str))


if __name__ == "__main__":
    main()
