"""``spark-submit``-able batch: ``python -m cotrend --folders a/ b/ --relation r.csv ...``."""

from __future__ import annotations

import argparse

from cotrend.plans.batch import run_batch, run_batches
from cotrend.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cotrend", description="Store monthly tool and pair counts")
    parser.add_argument("--folders", nargs="+", required=True, help="notebook folders of the batch")
    parser.add_argument("--relation", required=True, help="CSV with nb_id and repo_id")
    parser.add_argument("--metadata", required=True, help="folder of repo_<id>.json")
    parser.add_argument("--catalogue", required=True, help="CSV with Libraries and Category")
    parser.add_argument("--root", required=True, help="folder of the stored counts")
    parser.add_argument("--batch-id", help="a second run of a batch replaces it; without it, each folder is a batch")
    parser.add_argument("--single-line", action="store_true", help="no field of the relation holds a line break")
    args = parser.parse_args(argv)
    spark = build_session()
    paths = (args.folders, args.relation, args.metadata, args.catalogue, args.root)
    if args.batch_id is None:
        run_batches(spark, *paths, multiline=not args.single_line)
    else:
        run_batch(spark, *paths, args.batch_id, multiline=not args.single_line)


if __name__ == "__main__":
    main()
