"""The jobs as programs: ``python -m edgeloom JOB …``.

    followers   INPUT OUTPUT            followers of each node
    path2       INPUT                   number of 2-paths
    path2-pairs INPUT OUTPUT            end points of the 2-paths
    triangles   INPUT                   number of directed triangles
    walks       INPUT                   number of closed walks of length 3
    pagerank    INPUT OUTPUT            ranks of an edge list
    chain       OUTPUT                  ranks of the chain graph

Malformed lines of INPUT are left out and counted by the job that reads the others; the counts go to
standard error. ``--rejects FOLDER`` writes the lines; INPUT is still parsed once.
``--run FOLDER`` names the folder of a pagerank run: started again with it, the job goes on from the
last whole round.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import edgeloom as el
from edgeloom.operators.paths import STRATEGIES as PATHS
from edgeloom.operators.triangles import MODES, STRATEGIES
from edgeloom.storage import keep


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="edgeloom", description=__doc__)
    parser.formatter_class = argparse.RawDescriptionHelpFormatter
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, reads: bool = True, writes: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        if reads:
            sub.add_argument("input", help="edge list, one 'follower,followed' per line")
            sub.add_argument("--sep", default=",")
            sub.add_argument("--max-id", type=int, help="keep edges with both ids up to this")
            sub.add_argument("--rejects", help="folder to write malformed lines to")
        if writes:
            sub.add_argument("output", help="folder to write")
            sub.add_argument("--out-sep", default=",")
        return sub

    job("followers", writes=True)
    job("path2")
    pairs = job("path2-pairs", writes=True)
    pairs.add_argument("--keep-returns", action="store_true")
    pairs.add_argument("--strategy", choices=PATHS, default="shuffle")
    pairs.add_argument("--block", type=int, help="list in blocks of about so many pairs")
    pairs.add_argument("--run", help="folder of the blocks, to go on from")
    triangles = job("triangles")
    triangles.add_argument("--strategy", choices=STRATEGIES, default="shuffle")
    job("walks").add_argument("--mode", choices=MODES, default="all")
    for ranked in (job("pagerank", writes=True), job("chain", reads=False, writes=True)):
        ranked.add_argument("--iterations", type=int, default=10)
        ranked.add_argument("--damping", type=float, default=0.85)
        ranked.add_argument("--run", help="folder of the run's tables, to go on from")
        ranked.add_argument("--max-node", type=int, help="write ranks of nodes up to this")
        ranked.add_argument(
            "--every-round", action="store_true", help="write OUTPUT-0, OUTPUT-1, ..."
        )
    jobs.choices["chain"].add_argument("-k", type=int, default=100)
    return parser


def read(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, Observation]:
    """The edges, and the counts that come with the first job over them."""
    lines = spark.read.text(args.input).select(F.col("value").alias("line"))
    parsed, seen = el.counted_lines(el.parse_lines(lines, args.sep), args.max_id)
    if args.rejects:
        # Lines are only held where they are rejects.
        line = F.when(F.col("reason").isNotNull(), F.col("line")).alias("line")
        parsed = keep(parsed.select("src", "dst", "reason", line), "parsed")
        rejects = parsed.where("reason IS NOT NULL").select("reason", "line")
        el.write_delimited(rejects, args.rejects, "\t")
    edges = parsed.where("reason IS NULL").select("src", "dst")
    return el.max_filter(edges, args.max_id), seen


def report(seen: Observation) -> None:
    n = seen.get
    print(
        f"lines: {n['lines']}, rejected: {n['field_count'] + n['not_a_number']} (field_count "
        f"{n['field_count']}, not_a_number {n['not_a_number']}), above the greatest id: {n['above_max']}, "
        f"edges: {n['edges']}",
        file=sys.stderr,
    )


def write_ranks(edges: DataFrame, args: argparse.Namespace) -> None:
    rounds = el.rank_rounds(
        edges, args.iterations, args.damping, folder=args.run, every_round=args.every_round
    )
    last = args.iterations
    for i, table in rounds:
        if args.every_round or i == last:
            ranks = table.select("node", "rank")
            if args.max_node is not None:
                ranks = ranks.where(F.col("node") <= args.max_node)
            path = f"{args.output}-{i}" if args.every_round else args.output
            el.write_delimited(ranks, path, args.out_sep)


def run(spark: SparkSession, argv: list[str]) -> None:
    args = arguments().parse_args(argv)
    if args.job == "chain":
        write_ranks(el.chain_graph(spark, args.k, sentinel=False), args)
        return
    edges, seen = read(spark, args)
    if args.job == "followers":
        counts = el.follower_count(edges)
        el.write_delimited(counts, args.output, args.out_sep)
    elif args.job == "path2":
        print("2-paths:", el.path2_cardinality(edges).first().path2_count)
    elif args.job == "path2-pairs":
        if args.block:
            how = {"keep_returns": args.keep_returns, "folder": args.run}
            pairs = el.path2_blocks(edges, args.block, **how).drop("block")
        else:
            pairs = el.path2_pairs(edges, args.keep_returns, args.strategy)
        el.write_delimited(pairs, args.output, args.out_sep)
    elif args.job == "triangles":
        found = el.triangle_count(edges, strategy=args.strategy)
        print("triangles:", found.first().triangles)
    elif args.job == "walks":
        print("closed walks:", el.closed_walks(edges, args.mode).first().hits)
    else:
        write_ranks(edges, args)
    if getattr(args, "run", None):  # whose edges may be those of an earlier job
        return
    report(seen)


def main() -> None:
    argv = sys.argv[1:]
    arguments().parse_args(argv)  # help and mistakes end here, before Spark starts
    spark = SparkSession.builder.appName("edgeloom").getOrCreate()
    try:
        run(spark, argv)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
